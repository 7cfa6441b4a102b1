"""Start streaming queries with durable output."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from salesflow.session import exists, folders, remove

#: Versions of a running result that stay on storage.
VERSIONS = 3


class Taken(NamedTuple):
    """A micro-batch, its rows, and when it began."""

    batch_id: int
    rows: int
    began: float


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Take everything present now and stop, or, given an interval, keep running at that pace.

    How much one micro-batch takes is the source's limit (files or offsets
    per trigger); restarting on the same checkpoint continues where it ended.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_paced(messages: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str, seconds: float) -> list[Taken]:
    """Take what is there in micro-batches that begin at least ``seconds`` apart; the source's limit says how much each takes.

    The trigger alone starts a batch at once when the one before overran, and
    the next at its regular time; so a batch also ends no sooner than
    ``seconds`` after it began. Returns what the query's progress says of its
    last batches with rows (Spark keeps 100 unless told otherwise).
    """

    def paced(batch: DataFrame, batch_id: int) -> None:
        began = time.monotonic()
        take(batch, batch_id)
        time.sleep(max(0.0, began + seconds - time.monotonic()))

    writer = messages.writeStream.foreachBatch(paced).option("checkpointLocation", checkpoint)
    query = writer.trigger(processingTime=f"{seconds} seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return [
        Taken(p["batchId"], p["numInputRows"], datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")).timestamp())
        for p in query.recentProgress
        if p["numInputRows"]
    ]


def run_complete(view: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Complete mode: after every micro-batch the whole result is the new version under ``path``; see ``latest``."""

    def publish(result: DataFrame, batch_id: int) -> None:
        put_version(result, path, batch_id)

    return start(view.writeStream.outputMode("complete").foreachBatch(publish), checkpoint, every)


def put_version(result: DataFrame, path: str, version: int, keep: int | None = VERSIONS) -> None:
    """Write a version beside the older ones, of which the last few stay for readers that began before.

    A version counts once its success marker is there, so a write that fails
    leaves the old one current; one that is complete is not written again.
    With ``keep`` None all versions stay, and none of them is looked at.
    """
    spark = result.sparkSession
    if not is_complete(spark, path, version):
        result.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/version={version}")
    for old in complete_versions(spark, path)[:-keep] if keep else []:
        remove(spark, f"{path}/version={old}")


def latest(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The newest complete version under ``path``; empty before the first."""
    versions = complete_versions(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/version={versions[-1]}") if versions else spark.createDataFrame([], schema)


def is_complete(spark: SparkSession, path: str, version: int) -> bool:
    return exists(spark, f"{path}/version={version}/_SUCCESS")


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in folders(spark, path, "_SUCCESS") if name.startswith("version="))


def run_append(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = None) -> StreamingQuery:
    """Append mode for stateless queries; the file sink's log makes each row appear once.

    With ``fmt="csv"`` the files have no header, as prediction files do.
    """
    return start(rows.writeStream.outputMode("append").format(fmt).option("path", path), checkpoint, every)


def seconds_per_batch(query: StreamingQuery) -> dict[int, float]:
    """Measured duration of each recent micro-batch that took rows."""
    return {p["batchId"]: p["durationMs"]["triggerExecution"] / 1000 for p in query.recentProgress if p["numInputRows"]}


def watch(view: DataFrame, mode: str = "complete") -> StreamingQuery:
    """Print results on the driver's console, for demonstrations."""
    return view.writeStream.outputMode(mode).format("console").start()
