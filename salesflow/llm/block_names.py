"""Exact duplicates by naming: blocks become integers, pairs of integers become integers, until one is left."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.numbering import number
from salesflow.session import stage

#: Characters of a block. Longer blocks mean fewer levels of naming.
BLOCK = 4096
#: White space that does not count when texts are compared.
SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text without white space; a missing text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def blocks(text: Column, size: int) -> Column:
    """Consecutive pieces of ``size`` characters; an empty text is one empty piece."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(pieces)


def _digest(block: Column) -> Column:
    return F.xxhash64(block)


def _block_names(rows: DataFrame, size: int, digest) -> DataFrame:
    """(h, tied, block, name): every distinct block in sorted order gets an integer.

    Blocks are ordered by (digest, text), so whole texts meet in one shuffle
    only: the smallest and largest block of each digest, combined before the
    shuffle. Where those are equal the digest stands for one block alone and
    ``block`` is null; where they differ (``tied``), each text gets its own name.
    """
    each = rows.select(F.explode(blocks(F.col("body"), size)).alias("block")).withColumn("h", digest(F.col("block")))
    spans = stage(
        each.groupBy("h")
        .agg(F.min("block").alias("least"), F.max("block").alias("most"))
        .select("h", (F.col("least") != F.col("most")).alias("tied")),
        "block-digests",
    )
    single = spans.where(~F.col("tied")).select("h", "tied", F.lit(None).cast("string").alias("block"))
    several = each.join(spans.where("tied"), "h").select("h", "tied", "block").distinct()
    return stage(number(single.unionByName(several), ["h", "block"]), "block-names")


def identities(df: DataFrame, key: str, text: str, size: int = BLOCK, digest=_digest) -> DataFrame:
    """(doc_id, row, chars, text_sha256, n_blocks, name), one row per input row.

    Two rows have the same (n_blocks, name) exactly if their normalised texts
    are identical. ``row``, the 256-bit digest of the normalised text, tells rows
    of one key apart that hold different texts, also where a third of all keys is null.
    """
    body = df.select(
        F.col(key).alias("doc_id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("chars"),
        normalised(F.col(text)).alias("body"),
    )
    names = _block_names(body, size, digest)
    pieces = blocks(F.col("body"), size)
    rows = stage(
        body.select(
            "doc_id",
            "chars",
            F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"),
            F.size(pieces).alias("n_blocks"),
            F.transform(pieces, digest).alias("digests"),
        ).withColumn("row", F.unhex("text_sha256")),
        "block-rows",
    )
    placed = rows.select("doc_id", "row", "n_blocks", F.posexplode("digests").alias("pos", "h"))
    clear = placed.join(names.where(~F.col("tied")).select("h", "name"), "h").drop("h")
    tied = (
        body.withColumn("row", F.unhex(F.sha2(F.col("body").cast("binary"), 256)))
        .withColumn("n_blocks", F.size(pieces))
        .select("doc_id", "row", "n_blocks", F.posexplode(pieces).alias("pos", "block"))
        .withColumn("h", digest(F.col("block")))
        .join(names.where("tied").select("h", "block", "name"), ["h", "block"])
        .drop("h", "block")
    )
    level = stage(clear.unionByName(tied) if names.where("tied").take(1) else clear, "names-0")

    done = [level.where("n_blocks = 1").select("doc_id", "row", "name")]
    longest = rows.agg(F.max("n_blocks")).first()[0] or 1
    reach = 1
    while reach < longest:
        reach *= 2
        halves = level.where(F.col("n_blocks") > reach // 2).groupBy(
            "doc_id", "row", "n_blocks", F.floor(F.col("pos") / 2).cast("int").alias("pos")
        )
        pairs = halves.agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(0)).alias("right"),
        )
        pairs = stage(pairs, "pairs")
        named = stage(number(pairs.select("left", "right").distinct(), ["left", "right"]), "pair-names")
        level = stage(pairs.join(named, ["left", "right"]).drop("left", "right"), "names")
        done.append(level.where(F.col("n_blocks") <= reach).select("doc_id", "row", "name"))
    final = reduce(DataFrame.unionByName, done).distinct()
    same = rows["doc_id"].eqNullSafe(final["doc_id"]) & (rows["row"] == final["row"])
    return rows.join(final, same).select(
        rows["doc_id"], rows["row"], "chars", "text_sha256", "n_blocks", "name"
    )


def exact_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = BLOCK, digest=_digest) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and name for every row of ``df``.

    Texts are equal when identical without white space; null counts as empty.
    The row with the most characters stays, then the one with the smallest key
    (null last). Of rows that repeat key and text, one stays: the staged rows are
    numbered, and the smallest number of a group is found by the same
    aggregation, so no group is gathered. An empty table
    gives no rows; other columns are ignored, whatever their names. Texts of
    any length work: every level of naming halves the number of names.
    """
    rows = stage(identities(df, key, text, size, digest).withColumn("place", F.monotonically_increasing_id()), "identities")
    best = F.min(F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("none"), "doc_id", "place"))
    groups = stage(
        rows.groupBy("n_blocks", "name")
        .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .select("n_blocks", "name", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.place").alias("kept_place")),
        "groups",
    )
    return (
        rows.join(groups, ["n_blocks", "name"])
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("place") == F.col("kept_place")).alias("kept"),
            "text_sha256",
            "n_blocks",
            "name",
            "chars",
        )
    )
