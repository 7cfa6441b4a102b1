"""Registered queries: prediction files, latest rows, comparison of the layers, errors, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.operators import ordered
from salesflow.operators.comparison import compare_layers, prediction_difference, prediction_error
from salesflow.operators.describe import describe
from salesflow.session import scratch_dir
from salesflow.sources import files
from salesflow.sources.tables import prediction_set

COLUMNS = ("Invoice ID", "Total", "Prediction", "Prediction Time (s)")
ORDER = ["o_orderdate", "o_orderkey", *files.ARRIVAL]
BATCH, STREAM = 5, 7
#: Blocks of prediction files in the order they are written, and the folders they go to.
ARRIVING = {2: "c", 0: "a", 1: "b"}


def _batch(spark: SparkSession, sf_dir: str, arrival: bool = False) -> DataFrame:
    return prediction_set(spark, sf_dir, BATCH, arrival)


def _stream(spark: SparkSession, sf_dir: str, arrival: bool = False) -> DataFrame:
    return prediction_set(spark, sf_dir, STREAM, arrival)


def _double(*columns: str) -> list[Column]:
    return [F.col(f"`{c}`").cast("double").alias(c) for c in columns]


def _compared(stream: DataFrame, batch: DataFrame) -> DataFrame:
    return prediction_difference(
        compare_layers(stream.select("Invoice ID", "Total", "Prediction"), batch.select("Invoice ID", "Total", "Prediction"))
    )


_MERGED = ("Total_stream", "Prediction_stream", "Total_batch", "Prediction_batch")


def serve_predictions_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = []
    for name, rows in (("batch", _batch(spark, sf_dir)), ("stream", _stream(spark, sf_dir))):
        folders.append(scratch_dir(spark, f"predictions-{name}"))
        files.write_predictions(rows.select(*COLUMNS), folders[-1])
    return files.scan_predictions(spark, *folders)


def serve_last50(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = ordered.last_rows(_batch(spark, sf_dir, arrival=True), ORDER)
    return latest.select("Invoice ID", *_double(*COLUMNS[1:]))


def serve_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(_stream(spark, sf_dir), _batch(spark, sf_dir)).select("Invoice ID", *_double(*_MERGED))


def serve_join_last50(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboards' own composite: each layer's last rows, then the join."""
    stream = ordered.last_rows(_stream(spark, sf_dir, arrival=True), ORDER)
    batch = ordered.last_rows(_batch(spark, sf_dir, arrival=True), ORDER)
    return _compared(stream, batch).select("Invoice ID", *_double(*_MERGED, "Prediction_Difference"))


def serve_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = _compared(_stream(spark, sf_dir), _batch(spark, sf_dir))
    return compared.select("Invoice ID", *_double("Prediction_Difference"))


def _rounded(statistics: DataFrame, digits: int) -> DataFrame:
    return statistics.withColumn("value", F.round("value", digits))


def serve_diff_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(describe(serve_diff(spark, sf_dir), ["Prediction_Difference"]), 8)


def serve_predictions_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(describe(_stream(spark, sf_dir), list(COLUMNS[1:])), 4)


def serve_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prediction_error(_stream(spark, sf_dir)).select("Invoice ID", *_double("error"))


def _cumulative(predictions: DataFrame) -> DataFrame:
    errors = prediction_error(predictions).select(*ORDER, "Invoice ID", "error")
    summed = ordered.cumulative_error(errors, ORDER, keep=["Invoice ID", "error"])
    return summed.select("Invoice ID", *_double("error", "cumulative_error"))


def serve_cumulative_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cumulative(_stream(spark, sf_dir, arrival=True))


def serve_cumulative_error_last50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cumulative(ordered.last_rows(_stream(spark, sf_dir, arrival=True), ORDER))


def serve_arrival_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction files written in blocks whose names say another order: the places of each block's rows by file time."""
    root, block = scratch_dir(spark, "arrival"), F.col("`Invoice ID`").cast("bigint") % 3
    rows = _batch(spark, sf_dir).select(*COLUMNS)
    for share, folder in ARRIVING.items():
        files.write_predictions(rows.where(block == share), f"{root}/{folder}")
    arrived = files.with_arrival(files.scan_predictions(spark, root)).select(*files.ARRIVAL, block.alias("block"))
    numbered = ordered.number_rows(arrived, list(files.ARRIVAL))
    return numbered.groupBy("block").agg(
        F.count("*").alias("records"), F.min("row_number").alias("first_row"), F.max("row_number").alias("last_row")
    )


QUERIES = {
    "serve_predictions_scan": serve_predictions_scan,
    "serve_arrival_order": serve_arrival_order,
    "serve_last50": serve_last50,
    "serve_join": serve_join,
    "serve_join_last50": serve_join_last50,
    "serve_diff": serve_diff,
    "serve_diff_describe": serve_diff_describe,
    "serve_errors": serve_errors,
    "serve_cumulative_error": serve_cumulative_error,
    "serve_cumulative_error_last50": serve_cumulative_error_last50,
    "serve_predictions_describe": serve_predictions_describe,
}

_SETS = """
WITH totals AS (
  SELECT o_orderdate, o_orderkey, CAST(o_orderkey AS VARCHAR) AS invoice, CAST(o_totalprice AS DECIMAL(14,2)) AS total
  FROM orders),
batch AS (SELECT *, CAST(total + CAST(0.01 AS DECIMAL(3,2)) * (o_orderkey % 5 - 2) AS DECIMAL(14,2)) AS prediction
  FROM totals),
stream AS (SELECT *, CAST(total + CAST(0.01 AS DECIMAL(3,2)) * (o_orderkey % 7 - 3) AS DECIMAL(14,2)) AS prediction
  FROM totals)"""

_MERGED_SQL = """
  SELECT s.invoice AS "Invoice ID", CAST(s.total AS DOUBLE) AS "Total_stream",
         CAST(s.prediction AS DOUBLE) AS "Prediction_stream", CAST(b.total AS DOUBLE) AS "Total_batch",
         CAST(b.prediction AS DOUBLE) AS "Prediction_batch",
         CAST(s.prediction - b.prediction AS DOUBLE) AS "Prediction_Difference"
  FROM {stream} s JOIN {batch} b ON s.invoice = b.invoice"""

_LAST = "(SELECT * FROM {} ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50)"


def _describe_sql(column: str, source: str, digits: int) -> str:
    statistics = {
        "count": f'CAST(COUNT("{column}") AS DOUBLE)',
        "mean": f'AVG("{column}")',
        "std": f'stddev_samp("{column}")',
        "min": f'MIN("{column}")',
        "25%": f'quantile_cont("{column}", 0.25)',
        "50%": f'quantile_cont("{column}", 0.5)',
        "75%": f'quantile_cont("{column}", 0.75)',
        "max": f'MAX("{column}")',
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{column}' AS column_name, '{name}' AS statistic, round({sql}, {digits}) AS value FROM {source}"
        for name, sql in statistics.items()
    )


_FOUR = """invoice AS "Invoice ID", CAST(total AS DOUBLE) AS "Total",
       CAST(prediction AS DOUBLE) AS "Prediction", CAST(0.5 AS DOUBLE) AS "Prediction Time (s)\""""

_RUNNING = """
SELECT invoice AS "Invoice ID", CAST(prediction - total AS DOUBLE) AS error,
       CAST(SUM(prediction - total) OVER (ORDER BY o_orderdate, o_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_error
FROM """

ORACLES = {
    "serve_predictions_scan": f"{_SETS} SELECT {_FOUR} FROM batch UNION ALL SELECT {_FOUR} FROM stream",
    "serve_arrival_order": """
SELECT block, records, CAST(SUM(records) OVER (ORDER BY place) - records + 1 AS BIGINT) AS first_row,
       CAST(SUM(records) OVER (ORDER BY place) AS BIGINT) AS last_row
FROM (SELECT o_orderkey % 3 AS block, (o_orderkey + 1) % 3 AS place, COUNT(*) AS records FROM orders GROUP BY ALL)""",
    "serve_last50": f"{_SETS} SELECT {_FOUR} FROM {_LAST.format('batch')}",
    "serve_join": f"""{_SETS}
SELECT * EXCLUDE ("Prediction_Difference") FROM ({_MERGED_SQL.format(stream='stream', batch='batch')})""",
    "serve_join_last50": _SETS + _MERGED_SQL.format(stream=_LAST.format("stream"), batch=_LAST.format("batch")),
    "serve_diff": f"""{_SETS}
SELECT "Invoice ID", "Prediction_Difference" FROM ({_MERGED_SQL.format(stream='stream', batch='batch')})""",
    "serve_diff_describe": f"""{_SETS}, merged AS ({_MERGED_SQL.format(stream='stream', batch='batch')})
{_describe_sql('Prediction_Difference', 'merged', 8)}""",
    "serve_errors": f"""{_SETS}
SELECT invoice AS "Invoice ID", CAST(prediction - total AS DOUBLE) AS error FROM stream""",
    "serve_cumulative_error": f"{_SETS} {_RUNNING} stream",
    "serve_cumulative_error_last50": f"{_SETS} {_RUNNING} {_LAST.format('stream')}",
    "serve_predictions_describe": f"{_SETS}, four AS (SELECT {_FOUR} FROM stream)\n"
    + "\nUNION ALL\n".join(_describe_sql(c, "four", 4) for c in COLUMNS[1:]),
}
