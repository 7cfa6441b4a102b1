"""Batch and speed aggregates in one view: the batch layer up to a hand-over batch, the speed layer after it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesflow.functions.codecs import CORRUPT, REASON, decode_json
from salesflow.operators.ingest import tag_incomplete
from salesflow.plans.refresh import (
    COUNTS_SCHEMA,
    CUBE_SCHEMA,
    KEYS_SCHEMA,
    count_parts,
    cube_parts,
    invoice_keys,
    key_rows,
    merge_counts,
    merge_cubes,
    unseen,
    views_from_partials,
)
from salesflow.schema import SALES
from salesflow.session import remove
from salesflow.streaming.runners import complete_versions, put_version, start

_MASTER = T.StructType(
    [*SALES.fields, *(T.StructField(c, T.StringType()) for c in (CORRUPT, REASON, "part")), T.StructField("version", T.LongType())]
)


def _after(spark: SparkSession, path: str, schema: str, first: int, last: int) -> DataFrame:
    """Rows of the versions above ``first``, up to ``last``; only their folders are read."""
    found = [f"{path}/version={v}" for v in complete_versions(spark, path) if first < v <= last]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def _master(spark: SparkSession, root: str, first: int, last: int, part: str = "sales") -> DataFrame:
    rows = spark.read.schema(_MASTER).orc(f"{root}/master")
    return rows.where((F.col("version") > first) & (F.col("version") <= last) & (F.col("part") == part))


def store_batch(messages: DataFrame, batch_id: int, root: str, decode: Callable[[DataFrame], DataFrame] = decode_json) -> None:
    """Speed layer: store one micro-batch, its own sums and its own invoice keys; nothing older is looked at.

    Messages that cannot be stored are kept with their reason. Everything goes
    to folders named after the batch; the keys, written last, make it count,
    and a batch that counts is not written again.
    """
    spark = messages.sparkSession
    if batch_id <= handover(spark, root) or batch_id in stored_batches(spark, root):
        return
    tagged = tag_incomplete(decode(messages))
    parts = tagged.withColumn("part", F.when(F.col(REASON).isNull(), "sales").otherwise("rejected"))
    parts.write.mode("overwrite").partitionBy("part").orc(f"{root}/master/version={batch_id}")
    sales = _master(spark, root, batch_id - 1, batch_id)
    put_version(merge_cubes(cube_parts(sales)), f"{root}/speed_cubes", batch_id, keep=None)
    put_version(invoice_keys(sales), f"{root}/speed_keys", batch_id, keep=None)


def consolidate(spark: SparkSession, root: str, upto: int | None = None) -> int:
    """Batch layer: take over the stored sales up to batch ``upto`` (the newest if not given); returns the hand-over batch.

    Sums and keys are made anew from the stored sales after the last hand-over,
    and added to what that held, so sales are read once. The key set is one
    pass as large as the invoices are many: hand over seldom, the speed layer
    serves what comes between. Three hand-overs stay for readers that began
    before, and the speed layer's parts after the oldest of them. Before the
    first stored batch nothing is done, and -1 returned.
    """
    stored = stored_batches(spark, root)
    target = min(stored[-1], stored[-1] if upto is None else upto) if stored else -1
    last = handover(spark, root)
    if target <= last:
        return last
    sales = _master(spark, root, last, target)
    cubes, keys = cube_parts(sales), key_rows(sales)
    if last >= 0:
        cubes = cubes.unionByName(spark.read.schema(CUBE_SCHEMA).parquet(f"{root}/batch_cubes/version={last}"))
        keys = keys.unionByName(spark.read.schema(KEYS_SCHEMA).parquet(f"{root}/batch_keys/version={last}"))
    put_version(merge_cubes(cubes), f"{root}/batch_cubes", target)
    put_version(keys.distinct(), f"{root}/batch_keys", target)
    held = spark.read.schema(KEYS_SCHEMA).parquet(f"{root}/batch_keys/version={target}")
    put_version(merge_counts(count_parts(held)), f"{root}/batch_counts", target)
    oldest = complete_versions(spark, f"{root}/batch_counts")[0]
    for kind in ("speed_cubes", "speed_keys"):
        for version in complete_versions(spark, f"{root}/{kind}"):
            if version <= oldest and version < target:
                remove(spark, f"{root}/{kind}/version={version}")
    return target


def stored_batches(spark: SparkSession, root: str) -> list[int]:
    """The batches that the speed layer still holds, complete ones only."""
    return complete_versions(spark, f"{root}/speed_keys")


def handover(spark: SparkSession, root: str) -> int:
    """The last batch that the batch layer has taken over; -1 before the first."""
    return (complete_versions(spark, f"{root}/batch_counts") or [-1])[-1]


def combined_views(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The five views over everything stored: batch results up to the hand-over, speed results after it.

    Both layers hold the batches around the hand-over; its number decides
    which one answers, so nothing counts twice. Sums are added. Invoices are
    not: a key of the speed layer counts if the batch layer's key set lacks
    it, which reads that set but shuffles only what the recent keys meet.
    """
    last = handover(spark, root)
    newest = (stored_batches(spark, root) or [last])[-1]
    cubes = _after(spark, f"{root}/speed_cubes", CUBE_SCHEMA, last, newest)
    keys = _after(spark, f"{root}/speed_keys", KEYS_SCHEMA, last, newest).distinct()
    if last < 0:
        return views_from_partials(cubes, count_parts(keys))
    cubes = cubes.unionByName(spark.read.schema(CUBE_SCHEMA).parquet(f"{root}/batch_cubes/version={last}"))
    history = spark.read.schema(KEYS_SCHEMA).parquet(f"{root}/batch_keys/version={last}")
    counts = spark.read.schema(COUNTS_SCHEMA).parquet(f"{root}/batch_counts/version={last}")
    return views_from_partials(cubes, counts.unionByName(merge_counts(count_parts(unseen(keys, history)))))


def refused_messages(spark: SparkSession, root: str) -> DataFrame:
    """All messages that could not be stored, with the reason."""
    newest = (stored_batches(spark, root) or [-1])[-1]
    if newest < 0:
        return spark.createDataFrame([], _MASTER).drop("part", "version")
    return _master(spark, root, -1, newest, "rejected").drop("part", "version")


def run_layers(
    messages: DataFrame,
    root: str,
    batches: int,
    decode: Callable[[DataFrame], DataFrame] = decode_json,
    every: str | None = None,
) -> StreamingQuery:
    """Drain the stream through the speed layer; the batch layer takes over after every so many micro-batches.

    ``consolidate`` may be called by a job of its own instead (``batches`` 0).
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, root, decode)
        if batches and (batch_id + 1) % batches == 0:
            consolidate(batch.sparkSession, root, batch_id)

    return start(messages.writeStream.foreachBatch(one_batch), f"{root}/checkpoint", every)
