"""Registered queries: training, saved models, batch and stream scoring, splits."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions.codecs import REASON, encode_json
from salesflow.operators import scoring
from salesflow.operators.comparison import compare_layers, prediction_difference
from salesflow.plans.batch_queries import SALES_SQL
from salesflow.plans.landing import FILES_PER_LIGHT_TRIGGER, MESSAGES_PER_FILE, files_for, sales_messages
from salesflow.schema import FEATURES
from salesflow.session import application_dir, scratch_dir, stage, streaming_session
from salesflow.sources import files, topic
from salesflow.sources.tables import sales
from salesflow.streaming.score_layer import run_scoring

SPLIT_KEYS = ["invoice_id", "product_line", "quantity", "total"]
TOLERANCE = 0.05


def _training_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir, "invoice_id", "product_line", "total", *FEATURES)


def _saved_model(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> str:
    """The model of the training share of all sales, or of ``rows`` if these are at hand, fitted once for all queries of the application."""
    train, _ = scoring.hash_split(_training_sales(spark, sf_dir) if rows is None else rows, SPLIT_KEYS)
    return scoring.registered_model(train, application_dir(spark, "models"))


def model_fit_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per product line, how many of all sales are predicted to within a few cents."""
    model = scoring.load_model(_saved_model(spark, sf_dir))
    rows = _training_sales(spark, sf_dir).withColumn("total", F.col("total").cast("double"))
    close = F.abs(F.col("prediction") - F.col("total")) < TOLERANCE
    return model.transform(rows).groupBy("product_line").agg(
        F.count("*").alias("records"), F.count_if(close).alias("close_records")
    )


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _saved_model(spark, sf_dir)
    started = time.time()
    model = scoring.load_model(path)
    return scoring.score(_training_sales(spark, sf_dir), model, time.time() - started)


def _quality(predictions: DataFrame, total: str, prediction: str) -> DataFrame:
    close = F.abs(F.col(prediction) - F.col(total)) < TOLERANCE
    return predictions.groupBy(F.col("Invoice ID").alias("invoice_id")).agg(
        F.count("*").alias("records"), F.count_if(close).alias("close_records")
    )


def score_batch_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per invoice, how many sales were scored in batch, and scored to within a few cents."""
    return _quality(score_batch(spark, sf_dir), "total", "prediction")


def model_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root mean squared error on the share of the sales that training did not see."""
    _, test = scoring.hash_split(_training_sales(spark, sf_dir), SPLIT_KEYS)
    scored = scoring.score(test, scoring.load_model(_saved_model(spark, sf_dir)))
    return scored.agg(F.count("*").alias("records"), F.lit(scoring.rmse(scored) < TOLERANCE).alias("error_holds"))


def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic scored by a saved model into headerless CSV files, read back by position."""
    model = scoring.load_model(_saved_model(spark, sf_dir))
    root = scratch_dir(spark, "scored")
    run_scoring(sales_messages(spark, sf_dir, streaming_session(spark)), model, root)
    return files.scan_predictions(spark, f"{root}/result")


def score_stream_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per invoice, how many streamed sales were scored, and scored to within a few cents."""
    return _quality(score_stream(spark, sf_dir), "Total", "Prediction")


def score_stream_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every streamed prediction carries a measured duration, and batches have their own."""
    model = scoring.load_model(_saved_model(spark, sf_dir))
    root = scratch_dir(spark, "timed")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    size = max(min(MESSAGES_PER_FILE, lines // 2), 1)
    messages = sales_messages(spark, sf_dir, streaming_session(spark), files_per_trigger=files_for(lines, 5, size), messages_per_file=size)
    run_scoring(messages, model, root)
    temps = files.scan_predictions(spark, f"{root}/result").select(F.col("Prediction Time (s)").alias("t"))
    measured = F.min("t") > 0
    return temps.agg(F.count("*").alias("records"), measured.alias("measured"), (F.countDistinct("t") > 1).alias("differ"))


def score_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of sales with some inputs missing, how many were scored and how many set aside, by reason."""
    model = scoring.load_model(_saved_model(spark, sf_dir))
    root = scratch_dir(spark, "score-rejects")
    kind = F.col("invoice_id").cast("bigint") % 10
    holes = _training_sales(spark, sf_dir).withColumns(
        {"id": F.col("invoice_id"), "rating": F.when(kind != 0, F.col("rating")), "quantity": F.when(kind > 1, F.col("quantity"))}
    )
    topic.publish(encode_json(holes, key="id"), f"{root}/topic", MESSAGES_PER_FILE)
    run_scoring(topic.subscribe(streaming_session(spark), f"{root}/topic", FILES_PER_LIGHT_TRIGGER), model, root)
    scored = files.scan_predictions(spark, f"{root}/result")
    aside = spark.read.schema(f"{REASON} string").parquet(f"{root}/rejected")
    return scored.agg(F.lit("scored").alias("outcome"), F.count("*").alias("messages")).unionAll(
        aside.groupBy(F.col(REASON)).agg(F.count("*").alias("messages"))
    )


def score_stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ORC sales, some with inputs missing, scored in batch: what was scored closely, in measured time, and what was set aside."""
    model = scoring.load_model(_saved_model(spark, sf_dir))
    root = scratch_dir(spark, "score-stored")
    name = f"stored_sales_{root.rsplit('-', 1)[1]}"
    kind = F.col("invoice_id").cast("bigint") % 10
    files.create_sales_table(spark, name, f"{root}/sales")
    holes = {"rating": F.when(kind != 0, F.col("rating")), "quantity": F.when(kind > 1, F.col("quantity"))}
    sales(spark, sf_dir).withColumns(holes).write.insertInto(name, overwrite=True)
    scoring.score_table(spark.table(name), model, root)
    scored = files.scan_predictions(spark, f"{root}/result")
    right = (F.abs(F.col("Prediction") - F.col("Total")) < TOLERANCE) & (F.col("Prediction Time (s)") > 0)
    aside = spark.read.parquet(f"{root}/rejected")
    return scored.groupBy(F.when(right, "scored").otherwise("missed").alias("outcome")).agg(F.count("*").alias("records")).unionAll(
        aside.groupBy(REASON).agg(F.count("*").alias("records"))
    )


def serve_scored_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per invoice, the pairs of scored files of both layers, and of these the ones both scored to within a few cents."""
    rows = stage(_training_sales(spark, sf_dir), "to-score")  # fitted, scored and checked for holes from one join
    model = scoring.load_model(_saved_model(spark, sf_dir, rows))
    root = scratch_dir(spark, "scored-layers")
    scoring.score_table(rows, model, f"{root}/batch")
    run_scoring(sales_messages(spark, sf_dir, streaming_session(spark)), model, f"{root}/stream")
    stream, batch = (files.scan_predictions(spark, f"{root}/{layer}/result") for layer in ("stream", "batch"))
    compared = prediction_difference(compare_layers(stream, batch))
    gap = F.col("Prediction_Difference") - (F.col("Total_stream") - F.col("Total_batch"))
    close = (F.abs(gap) < TOLERANCE) & (F.abs(F.col("Prediction_stream") - F.col("Total_stream")) < TOLERANCE)
    return compared.groupBy(F.col("Invoice ID").alias("invoice_id")).agg(
        F.count("*").alias("pairs"), F.count_if(close).alias("close_pairs")
    )


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = scoring.hash_split(sales(spark, sf_dir, *SPLIT_KEYS), SPLIT_KEYS)
    both = train.select(F.lit("train").alias("part"), "total").unionAll(test.select(F.lit("test").alias("part"), "total"))
    return both.groupBy("part").agg(F.count("*").alias("records"), F.sum("total").cast("double").alias("total_sales"))


def random_split_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeded random split loses and repeats no sale, and is close to 80/20."""
    train, test = scoring.random_split(sales(spark, sf_dir, "invoice_id", "total"))
    both = train.select("total", F.lit(1).alias("is_train")).unionAll(test.select("total", F.lit(0).alias("is_train")))
    return both.agg(
        F.count("*").alias("records"),
        F.sum("total").cast("double").alias("total_sales"),
        F.avg("is_train").between(0.78, 0.82).alias("share_holds"),
    )


QUERIES = {
    "model_fit_quality": model_fit_quality,
    "score_batch": score_batch,
    "score_batch_quality": score_batch_quality,
    "model_held_out": model_held_out,
    "score_stream": score_stream,
    "score_stream_quality": score_stream_quality,
    "score_stream_seconds": score_stream_seconds,
    "score_rejects": score_rejects,
    "score_stored_table": score_stored_table,
    "serve_scored_join": serve_scored_join,
    "train_test_split": train_test_split,
    "random_split_cover": random_split_cover,
}

_ALL_CLOSE = SALES_SQL + """
SELECT invoice_id, COUNT(*) AS records, COUNT(*) AS close_records FROM sales GROUP BY invoice_id"""

# score_batch and score_stream have no SQL counterpart: their predictions come from a fitted model.
ORACLES = {
    "model_fit_quality": SALES_SQL + """
SELECT product_line, COUNT(*) AS records, COUNT(*) AS close_records FROM sales GROUP BY product_line""",
    "score_stream_quality": _ALL_CLOSE,
    "score_batch_quality": _ALL_CLOSE,
    "score_stream_seconds": "SELECT COUNT(*) AS records, TRUE AS measured, TRUE AS differ FROM lineitem",
    "model_held_out": SALES_SQL + """
SELECT COUNT(*) AS records, TRUE AS error_holds FROM sales
WHERE CAST('0x' || substr(md5(concat_ws('|', invoice_id, product_line, quantity, total)), 1, 8) AS BIGINT) % 100 >= 80""",
    "score_stored_table": """
SELECT CASE l_orderkey % 10 WHEN 0 THEN 'quantity missing; rating missing' WHEN 1 THEN 'quantity missing'
            ELSE 'scored' END AS outcome, COUNT(*) AS records
FROM lineitem GROUP BY outcome""",
    "serve_scored_join": SALES_SQL + """
SELECT invoice_id, COUNT(*) * COUNT(*) AS pairs, COUNT(*) * COUNT(*) AS close_pairs FROM sales GROUP BY invoice_id""",
    "score_rejects": """
SELECT CASE l_orderkey % 10 WHEN 0 THEN 'quantity missing; rating missing' WHEN 1 THEN 'quantity missing'
            ELSE 'scored' END AS outcome, COUNT(*) AS messages
FROM lineitem GROUP BY outcome""",
    "train_test_split": SALES_SQL + """
SELECT CASE WHEN CAST('0x' || substr(md5(concat_ws('|', invoice_id, product_line, quantity, total)), 1, 8) AS BIGINT)
                 % 100 < 80 THEN 'train' ELSE 'test' END AS part,
       COUNT(*) AS records, CAST(SUM(total) AS DOUBLE) AS total_sales
FROM sales GROUP BY part""",
    "random_split_cover": SALES_SQL + """
SELECT COUNT(*) AS records, CAST(SUM(total) AS DOUBLE) AS total_sales, TRUE AS share_holds FROM sales""",
}
