"""Weighted rendezvous hashing of record keys to shards, and gapless places inside each shard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.session import stage

#: Hexadecimal digits of a digest that decide a draw: 52 bits, exact in a double.
_DIGITS = 13


def _draw(text: Column) -> Column:
    """A digest of ``text`` as a whole number below 2**52."""
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("long")


def _key(key: Column) -> Column:
    """A missing key is a key of its own, unlike any text."""
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("missing"))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 to len(weights) - 1) of ``key``.

    Every shard draws a number in (0, 1) from the key and its own index, and
    the largest ``-weight / ln(draw)`` wins, so a shard gets rows in proportion
    to its weight. A shard's draw does not depend on how many others there are:
    appending a shard moves only the rows that the new one wins, and removing
    the last moves only the rows it held. Ties go to the smaller index. A null
    key is hashed as a key of its own.
    """
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("every shard needs a positive weight")
    draws = []
    for index, weight in enumerate(weights):
        unit = (_draw(F.concat(_key(key), F.lit(f":{index}"))) + F.lit(0.5)) / F.lit(float(2**52))
        draws.append(F.struct((F.lit(-float(weight)) / F.log(unit)).alias("score"), F.lit(-index).alias("index")))
    return (-F.array_max(F.array(*draws))["index"]).cast("int")


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], into: str = "shard") -> DataFrame:
    """``df`` with its shard in the column ``into`` (replaced if it exists); no shuffle."""
    return df.withColumn(into, rendezvous(F.col(key), weights))


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str) -> None:
    """Write whole records to one folder per shard; tasks write their own rows, nothing is gathered.

    The folders are called ``_shard=<n>``, so a column of any other name is kept.
    """
    assign_shards(df, key, weights, "_shard").write.partitionBy("_shard").parquet(path)


def ranged(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``df`` cut into ranges of the order, with the number of its range in ``bucket``; to be staged before it is used twice."""
    split = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    return split.withColumn("bucket", F.spark_partition_id())


def placements(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    weights: Sequence[float] = (1.0,) * 8,
    added: float = 1.0,
    ranges: int | None = None,
) -> DataFrame:
    """Where every row goes: key, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 length of the text plus one (one for a missing text);
    ``grown_shard`` is the shard with one more of weight ``added``. Slots count
    from 0 without gaps, in the order of the key's digest, then of size and
    checksum of the text. Equal rows are combined into runs before the
    shuffle, one run per input partition. Runs are split into ``ranges`` of
    nearly equal length (the session's shuffle partitions if not given) by the
    whole order, not by the key, so a key that fills a third of the table is
    ordered by a third of the tasks, whether its texts are equal or not. Null
    keys share a shard; repeated rows get a slot each; an empty table gives no
    rows; other columns, whatever their names, are left out.
    """
    body = F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary"))
    rows = df.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, added]).alias("grown_shard"),
        _draw(_key(F.col(key))).alias("place"),
        F.spark_partition_id().alias("part"),
    )
    runs = stage(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), "shard-runs")
    order = ("place", "doc_id", "size", "text_crc32", "part")
    placed = stage(ranged(runs, ["shard", *order], ranges), "shard-places")
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        placed.groupBy("shard", "bucket")
        .agg(F.sum("n").alias("held"))
        .select("shard", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("shard", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(bases, ["shard", "bucket"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("base") + F.col("inside") + F.col("copy")).alias("slot"),
            "grown_shard",
        )
    )
