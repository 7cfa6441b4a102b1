"""Linear regression on the invoice total: split, fit, save, load, score, evaluate."""

from __future__ import annotations

import hashlib
import time
import uuid
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.functions.codecs import REASON
from salesflow.schema import FEATURES
from salesflow.session import exists, publish_folder, stage
from salesflow.sources.files import write_predictions

SEED = 42


def random_split(df: DataFrame, train_share: float = 0.8, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Seeded random split. The draw depends on how rows lie in partitions; see ``hash_split``."""
    train, test = df.randomSplit([train_share, 1 - train_share], seed=seed)
    return train, test


def split_share(columns: list[str]) -> Column:
    """A number from 0 to 99 taken from a digest of the row: the same in every run and layout."""
    digest = F.md5(F.concat_ws("|", *[F.col(c) for c in columns]))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(100))


def hash_split(df: DataFrame, columns: list[str], train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Repeatable split on row content; equal rows fall on the same side."""
    share = split_share(columns)
    return df.where(share < train_percent), df.where(share >= train_percent)


def regression(label: str = "total", features: tuple[str, ...] = FEATURES) -> Pipeline:
    """Feature vector plus linear regression as one artefact, so scoring cannot disagree on the inputs."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    return Pipeline(stages=[assembler, LinearRegression(featuresCol="features", labelCol=label)])


def train(df: DataFrame, label: str = "total", features: tuple[str, ...] = FEATURES, staged: bool = False) -> PipelineModel:
    """Fit on the rows of ``df``; ``staged`` says that it is a written table of label and features already.

    The solver tree-aggregates the rows once, and the model's summary reads
    them again. What they read is a written table of label and features, so
    the joins behind ``df`` run once.
    """
    return regression(label, features).fit(df if staged else _staged_inputs(df, label, features))


def _staged_inputs(df: DataFrame, label: str, features: tuple[str, ...]) -> DataFrame:
    return stage(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in (label, *features)]), "training")


def rows_digest(df: DataFrame, *settings: str) -> str:
    """A digest of the rows, whatever their order and layout, and of the settings: two sums of 64-bit digests and the count."""
    own = [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.lit(seed)).cast("decimal(38,0)") for seed in (1, 2)]
    found = df.select(*[c.alias(f"d{i}") for i, c in enumerate(own)]).agg(F.count("*"), F.sum("d0"), F.sum("d1")).first()
    return hashlib.sha256(repr(([str(v) for v in found], df.dtypes, settings)).encode()).hexdigest()


def registered_model(df: DataFrame, registry: str, label: str = "total", features: tuple[str, ...] = FEATURES) -> str:
    """The path of the model fitted on the rows of ``df``: fitted and published if the registry has none of these rows.

    The folder gets its name, the digest of the rows, in one step, so a
    reader finds a whole model or none; of two jobs that fit the same rows
    the first one's stays. The joins behind ``df`` run once, for the digest and the fit together.
    """
    spark = df.sparkSession
    inputs = _staged_inputs(df, label, features)
    path = f"{registry}/{rows_digest(inputs, label, *features)}"
    if not exists(spark, path):
        written = f"{registry}/_{uuid.uuid4().hex}"
        save_model(train(inputs, label, features, True), written)
        publish_folder(spark, written, path)
    return path


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def without_features(df: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Rows that scoring leaves out because a model input is missing, with the reason."""
    given = [F.col(f).cast("double") for f in features]
    faults = [F.when(c.isNull() | F.isnan(c), f"{f} missing") for f, c in zip(features, given)]
    reason = F.nullif(F.concat_ws("; ", *faults), F.lit(""))
    return df.withColumn(REASON, reason).where(F.col(REASON).isNotNull())


def score_table(df: DataFrame, model: PipelineModel, root: str) -> float:
    """Score a stored table into ``root/result``, prediction files, and ``root/rejected``, rows it cannot score with the reason.

    Every row goes to one of the two. The predictions are written once, then
    brought out with the measured seconds that took, which are returned.
    """
    began = time.monotonic()
    scored = stage(score(df, model).drop("temps"), "scored")
    seconds = time.monotonic() - began
    write_predictions(scored.withColumn("temps", F.lit(seconds)), f"{root}/result")
    without_features(df).write.mode("overwrite").parquet(f"{root}/rejected")
    return seconds


def score(df: DataFrame, model: PipelineModel, seconds: float | None = None) -> DataFrame:
    """Predictions in the layout the prediction files use; works on streams too.

    ``temps`` is whatever duration the caller measured, the same on every row.
    """
    inputs = df.select("invoice_id", F.col("total").cast("double").alias("total"), *[c for c in FEATURES])
    scored = model.transform(inputs).withColumn("temps", F.lit(seconds).cast("double"))
    return scored.select(F.col("invoice_id").alias("Invoice ID"), "total", "prediction", "temps")


def rmse(predictions: DataFrame, label: str = "total") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse").evaluate(predictions)
