"""The running results, as one streaming query per view or all from one pass over the topic."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesflow.functions.codecs import as_events, decode_json, rejected_events
from salesflow.operators.speed import SPEED_VIEWS, TOP_RATED_VIEW, VIEW_FIELDS, named_query, top_rated
from salesflow.schema import MONEY_SUM
from salesflow.session import held
from salesflow.streaming.runners import complete_versions, latest, put_version, run_append, run_complete, start

RUNNING_SCHEMA = (
    "city string, product_line string, customer_type string, "
    f"total {MONEY_SUM}, gross_income {MONEY_SUM}, quantity double, records bigint"
)


def run_view(messages: DataFrame, view: str, root: str, columns: str | None = None, every: str | None = None) -> DataFrame:
    """One view as a query of its own, decoding only what it needs; returns its table at ``root/result``.

    Aggregates replace their result after every micro-batch, the rating
    filter appends. Messages it cannot use go to ``root/rejected`` with a
    reason, by a query of their own.
    """
    decoded = decode_json(messages, VIEW_FIELDS[view])
    rows = named_query(as_events(decoded), view, columns)
    run = run_append if view == TOP_RATED_VIEW else run_complete
    with ThreadPoolExecutor(max_workers=1) as pool:
        aside = pool.submit(run_append, rejected_events(decoded), f"{root}/rejected", f"{root}/rejected-checkpoint", every=every)
        run(rows, f"{root}/result", f"{root}/checkpoint", every=every)
    aside.result()
    return running_result(rows.sparkSession, view, f"{root}/result", rows.schema)


def running_result(spark: SparkSession, view: str, path: str, schema: T.StructType) -> DataFrame:
    """What ``run_view`` has brought about so far."""
    return spark.read.schema(schema).parquet(path) if view == TOP_RATED_VIEW else latest(spark, path, schema)


def run_separately(messages: DataFrame, root: str) -> dict[str, DataFrame]:
    """All five views side by side, each reading the topic for itself with its own checkpoint."""
    with ThreadPoolExecutor(max_workers=len(SPEED_VIEWS)) as pool:
        running = {view: pool.submit(run_view, messages, view, f"{root}/{view}") for view in SPEED_VIEWS}
    return {view: job.result() for view, job in running.items()}


# What the results need of an event; only this is decoded, and kept between the two writes of a batch.
_USED = tuple(dict.fromkeys(field for fields in VIEW_FIELDS.values() for field in fields))

# A dictionary of digests would be given up after its first million bytes, and costs more than parsing does.
_RATED_PACKING = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary#id": "false"}


def partials(events: DataFrame) -> DataFrame:
    """Sums at the grain the four running aggregates share."""
    return events.groupBy("city", "product_line", "customer_type").agg(
        F.sum("total").cast(MONEY_SUM).alias("total"),
        F.sum("gross_income").cast(MONEY_SUM).alias("gross_income"),
        F.sum("quantity").alias("quantity"),
        F.count(F.lit(1)).alias("records"),
    )


def views_from_partials(sums: DataFrame) -> dict[str, DataFrame]:
    def total(field: str, name: str) -> Column:
        return F.sum(field).cast("double").alias(name)

    return {
        "total_sales_by_city_product_view": sums.groupBy("city", "product_line").agg(total("total", "total_sales")),
        "total_sales_by_customer_type_view": sums.groupBy("customer_type").agg(
            total("total", "total_sales_by_customer_type")
        ),
        "total_gross_income_by_product_view": sums.groupBy("product_line").agg(
            total("gross_income", "total_gross_income")
        ),
        "total_quantity_by_product_view": sums.groupBy("product_line").agg(total("quantity", "total_quantity_sold")),
    }


def merge_partials(sums: DataFrame) -> DataFrame:
    """Sums of the same group become one."""
    return sums.groupBy("city", "product_line", "customer_type").agg(
        F.sum("total").cast(MONEY_SUM).alias("total"),
        F.sum("gross_income").cast(MONEY_SUM).alias("gross_income"),
        F.sum("quantity").alias("quantity"),
        F.sum("records").alias("records"),
    )


def running_sums(spark: SparkSession, root: str) -> DataFrame:
    """All sums so far: the newest snapshot, as large as there are groups, whatever the number of batches."""
    return latest(spark, f"{root}/running", RUNNING_SCHEMA)


def current_views(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return views_from_partials(running_sums(spark, root))


def store_batch(messages: DataFrame, batch_id: int, root: str) -> None:
    """Write the top-rated rows and the refused messages of one micro-batch, and bring the running sums up to it.

    The sums are those of the newest snapshot before this batch with the
    batch's own added, group by group, as a new snapshot. So a replay writes what is
    there already, and a batch that fails leaves the snapshot before it.
    """
    spark, path = messages.sparkSession, f"{root}/running"
    with held(decode_json(messages, _USED)) as decoded:
        events = as_events(decoded)
        rated = top_rated(events).select("id", "invoice_id", "product_line", "rating")
        rated.write.mode("overwrite").options(**_RATED_PACKING).parquet(f"{root}/top_rated/batch_id={batch_id}")
        rejected_events(decoded).write.mode("overwrite").parquet(f"{root}/rejected/batch_id={batch_id}")
        earlier = [v for v in complete_versions(spark, path) if v < batch_id]
        sums = partials(events)
        if earlier:
            sums = merge_partials(sums.unionByName(spark.read.schema(RUNNING_SCHEMA).parquet(f"{path}/version={earlier[-1]}")))
        put_version(sums, path, batch_id)


def run_speed_layer(messages: DataFrame, root: str, every: str | None = None) -> StreamingQuery:
    """One streaming query instead of five: each message is fetched and decoded once.

    Readers take the newest snapshot of the running sums, which equals the complete-mode result.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, root)

    return start(messages.writeStream.foreachBatch(one_batch), f"{root}/checkpoint", every)
