"""Scoring of a message stream by a saved model."""

from __future__ import annotations

import time

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from salesflow.functions.codecs import as_events, decode_json, rejected_events
from salesflow.operators import scoring
from salesflow.schema import FEATURES
from salesflow.session import exists, folders, held
from salesflow.sources.files import write_predictions
from salesflow.streaming.runners import complete_versions, is_complete, put_version, start

_SCORED = "`Invoice ID` string, total double, prediction double"
#: Seconds that a finished query waits for the reports of its last batches.
PATIENCE = 60


class BatchSeconds(StreamingQueryListener):
    """Writes how long each micro-batch of one query took, under ``path`` by batch, as Spark reports it."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path, self.run = spark, path, None

    def onQueryStarted(self, event) -> None:
        self.run = self.run or (str(event.runId) if event.name == self._path else None)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.runId) == self.run and "addBatch" in progress.durationMs:
            seconds = self._spark.createDataFrame([(progress.durationMs["triggerExecution"] / 1000,)], "seconds double").coalesce(1)
            put_version(seconds, self._path, progress.batchId, keep=None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def run_scoring(messages: DataFrame, model: PipelineModel, root: str, every: str | None = None) -> None:
    """Predictions to headerless CSV files in ``root/result``, in the layout of prediction files.

    Each micro-batch writes its predictions and, with a reason, its messages
    without an id or a model input (``root/rejected``) to folders of its own,
    which a replay replaces. ``temps`` is the measured duration of the batch:
    it is known when the batch is over, so files in ``root/result`` follow one
    batch later, or when the query has drained its source.
    """
    spark = messages.sparkSession
    needed = ("id", "invoice_id", "total", *FEATURES)
    waiting = set(untimed(spark, root))

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        with held(decode_json(batch, needed)) as decoded:  # read and parsed once for both writes
            put_version(scoring.score(as_events(decoded, FEATURES), model).drop("temps"), f"{root}/scored", batch_id, keep=None)
            rejected_events(decoded, FEATURES).write.mode("overwrite").parquet(f"{root}/rejected/batch_id={batch_id}")
        if not exists(spark, f"{root}/result/batch={batch_id}/_SUCCESS"):
            waiting.add(batch_id)
        publish_timed(spark, root, waiting)

    seconds = BatchSeconds(spark, f"{root}/seconds")
    spark.streams.addListener(seconds)
    query = start(messages.writeStream.queryName(f"{root}/seconds").foreachBatch(one_batch), f"{root}/checkpoint", every)
    if not every:
        until = time.monotonic() + PATIENCE
        while publish_timed(spark, root, waiting) and time.monotonic() < until:
            time.sleep(0.2)
        spark.streams.removeListener(seconds)
        if late := publish_timed(spark, root, waiting):
            raise TimeoutError(f"no duration was reported for batches {late} of query {query.id}")


def untimed(spark: SparkSession, root: str) -> list[int]:
    """The scored batches whose predictions are not out yet; looks at every batch there is, so ask once, not once a batch."""
    done = {int(name.split("=")[1]) for name in folders(spark, f"{root}/result", "_SUCCESS")}
    return [b for b in complete_versions(spark, f"{root}/scored") if b not in done]


def publish_timed(spark: SparkSession, root: str, waiting: set[int] | None = None) -> list[int]:
    """Bring out the predictions of batches whose duration is known; returns the batches that still wait for theirs.

    ``waiting``, if the caller keeps count of them, loses the ones that are out; else every batch is looked at.
    """
    waiting = set(untimed(spark, root)) if waiting is None else waiting
    for batch in sorted(waiting):
        if is_complete(spark, f"{root}/seconds", batch):
            seconds = spark.read.schema("seconds double").parquet(f"{root}/seconds/version={batch}").first()["seconds"]
            rows = spark.read.schema(_SCORED).parquet(f"{root}/scored/version={batch}").withColumn("temps", F.lit(seconds))
            write_predictions(rows, f"{root}/result/batch={batch}")
            waiting.discard(batch)
    return sorted(waiting)
