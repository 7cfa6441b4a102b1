"""Registered queries: batch views, ingestion, codecs, blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions import codecs
from salesflow.functions.cleaning import nan_to_null, strip_prefix
from salesflow.operators import ingest, ordered, views
from salesflow.plans.refresh import publish_view
from salesflow.session import scratch_dir
from salesflow.sources import files
from salesflow.sources.tables import prediction_set, raw_sales, sales, table

SCHEMA_ID = 7


def _unique(name: str, path: str) -> str:
    """A table name that no other run uses."""
    return f"{name}_{path.rsplit('-', 1)[1]}"


def _total(field: str, name: str) -> Column:
    return F.sum(field).cast("double").alias(name)


def view_sales_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sales_monthly_summary(sales(spark, sf_dir, "product_line", "date", "quantity", "total"))


def view_profitability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.profitability_by_product_line(sales(spark, sf_dir, "product_line", "total", "cogs"))


def view_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = views.product_performance_summary(
        sales(spark, sf_dir, "product_line", "gross_margin_percentage", "quantity")
    )
    return summary.withColumn("avg_margin", F.round("avg_margin", 8))


def view_payment_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.payment_method_sales_summary(sales(spark, sf_dir, "payment", "total", "invoice_id"))


def view_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.gender_sales_summary(sales(spark, sf_dir, "gender", "total", "invoice_id"))


def view_refresh_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second refresh replaces the first; nothing adds up."""
    folder = scratch_dir(spark, "views")
    name = _unique("payment_method_sales_summary", folder)
    for _ in range(2):
        publish_view(view_payment_method(spark, sf_dir), name, folder)
    return spark.table(name)


def orc_sales_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "sales")
    name = _unique("sales", path)
    for _ in range(2):  # creating it again changes nothing
        files.create_sales_table(spark, name, path)
    sales(spark, sf_dir).write.insertInto(name, overwrite=True)
    return spark.table(name).groupBy("branch").agg(F.count("*").alias("records"), _total("total", "total_sales"))


def _csv_copy(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "raw-csv")
    raw_sales(spark, sf_dir).write.csv(path, header=True)
    return path


def ingest_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of the complete records by branch, and how many rows were refused for a field that is missing or does not fit."""
    tagged = ingest.tag_rejects(files.read_raw_csv(spark, _csv_copy(spark, sf_dir), as_text=True))
    whole = F.col(ingest.REASON).isNull()

    def of_whole(field: str, kind: str | None = None) -> Column:
        return F.when(whole, F.col(field).cast(kind) if kind else F.col(field))

    return tagged.groupBy("branch").agg(  # one pass over the text for both
        F.count_if(~whole).alias("refused"),
        F.nullif(F.count_if(whole), F.lit(0)).alias("records"),
        F.sum(of_whole("quantity")).cast("bigint").alias("quantity"),
        F.sum(of_whole("total", "decimal(18,4)")).cast("double").alias("total_sales"),
        F.sum(of_whole("cogs", "decimal(18,4)")).cast("double").alias("total_cost"),
        F.round(F.avg(of_whole("rating")), 8).alias("avg_rating"),
        F.min(of_whole("date")).alias("first_date_text"),
        F.max(of_whole("time")).alias("last_time_text"),
    )


def ingest_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sale from files of one folder whose headers differ in order, in case of packing, and by columns of their own."""
    path, raw = scratch_dir(spark, "mixed-csv"), raw_sales(spark, sf_dir)
    names = [f"`{c}`" for c in raw.columns]
    share = F.col("Quantity") % 3
    raw.where(share == 0).write.csv(path, header=True)
    raw.where(share == 1).select(*reversed(names)).write.mode("append").csv(path, header=True, compression="gzip")
    noted = raw.where(share == 2).select(F.lit("a, \"b\"").alias("Note"), *names[5:], F.lit(1).alias("Rank"), *names[:5])
    noted.write.mode("append").option("escape", '"').csv(path, header=True)
    sales_again = ingest.tag_rejects(files.read_mixed_csv(spark, path, as_text=True))
    amounts = {f: F.col(f).cast("double") for f in ("tax_5_percent", "total", "cogs", "gross_income")}
    rounded = {f: F.round(f, 9) for f in ("unit_price", "gross_margin_percentage", "rating")}
    return sales_again.withColumns(amounts | rounded)


def ingest_unique_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per branch, rows of which many are equal, their distinct ids, and how many ids a second reading gives again."""
    scan = files.read_raw_csv(spark, _csv_copy(spark, sf_dir)).select("Branch")
    readings = [files.with_row_ids(scan).withColumn("reading", F.lit(i)) for i in range(2)]
    each = readings[0].unionAll(readings[1]).groupBy(F.unhex("id").alias("id")).agg(  # half the bytes of the text
        F.min("Branch").alias("branch"), F.count("*").alias("rows"), (F.max("reading") - F.min("reading") + 1).alias("n")
    )
    return each.groupBy("branch").agg(
        (F.sum("rows") / 2).cast("bigint").alias("records"), F.count("*").alias("ids"), F.count_if(F.col("n") == 2).alias("ids_again")
    )


def scan_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    inferred = files.read_csv_inferred(spark, _csv_copy(spark, sf_dir))
    return inferred.groupBy(F.col("Branch").alias("branch")).agg(
        F.count("*").alias("records"),
        F.sum("Quantity").cast("bigint").alias("quantity"),
        F.sum(F.col("Total").cast("decimal(18,4)")).cast("double").alias("total_sales"),
        F.round(F.avg("Rating"), 8).alias("avg_rating"),
    )


def ingest_null_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events carry no usable value; they arrive as NaN and leave as NULL."""
    error = F.col("event_type") == "error"
    raw = table(spark, sf_dir, "events").select(
        "event_type", F.when(error, F.lit(float("nan"))).otherwise(F.col("value")).alias("value")
    )
    cleaned = nan_to_null(raw.withColumn("was_nan", F.isnan("value")))
    return cleaned.groupBy("event_type").agg(
        F.count("*").alias("events"),
        F.count_if("was_nan").alias("nan_before"),
        F.count_if(F.isnan("value")).alias("nan_after"),
        F.count_if(F.col("value").isNull()).alias("null_after"),
        F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total_value"),
    )


def ingest_reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that leaves out the unspecified payments and garbles the quantity of the lowest ratings."""
    faulty = raw_sales(spark, sf_dir).withColumns(
        {
            "Payment": F.when(F.col("Payment") != "4-NOT SPECIFIED", F.col("Payment")),
            "Quantity": F.when(F.col("Rating") == 4.0, "n/a").otherwise(F.col("Quantity").cast("string")),
        }
    )
    as_text = faulty.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in faulty.columns])
    outcome = F.coalesce(F.col(ingest.REASON), F.lit("accepted")).alias("outcome")
    return ingest.tag_rejects(as_text).groupBy(outcome).agg(F.count("*").alias("records"))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = codecs.encode_json(sales(spark, sf_dir), key="id")
    return codecs.as_events(codecs.decode_json(messages)).groupBy("city", "customer_type").agg(
        F.count("*").alias("records"),
        _total("total", "total_sales"),
        _total("gross_income", "total_gross_income"),
        F.sum("quantity").cast("bigint").alias("quantity"),
        F.max("rating").alias("best_rating"),
        F.count_distinct("payment", "gender").alias("customer_segments"),
    )


def json_reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of error events are cut short, those of signups carry text for the amount."""
    events = table(spark, sf_dir, "events")
    head = F.concat(F.lit('{"id": "'), F.col("event_id").cast("string"), F.lit('", "rating": '))
    amount = F.when(F.col("event_type") == "signup", F.lit('"none"')).otherwise(F.col("value").cast("string"))
    tail = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.lit("}"))
    messages = events.select("event_type", F.encode(F.concat(head, amount, tail), "UTF-8").alias("value"))
    decoded = codecs.decode_json(messages)
    outcome = F.when(F.col("id").isNull(), "rejected").when(F.col(codecs.CORRUPT).isNotNull(), "kept with warning")
    return decoded.groupBy(outcome.otherwise("kept").alias("outcome")).agg(
        F.count("*").alias("messages"), F.sum(F.col("rating").cast("decimal(18,4)")).cast("double").alias("total_value")
    )


def avro_frame_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry framing around an opaque payload, taken apart again."""
    records = sales(spark, sf_dir, "invoice_id", "product_line", "payment", "time")
    payload = F.encode(F.concat_ws("|", "invoice_id", "product_line", "payment", "time"), "UTF-8")
    framed = records.select("invoice_id", codecs.frame(payload, SCHEMA_ID).alias("value"))
    value = F.col("value")
    return framed.select(
        "invoice_id",
        codecs.frame_magic(value).alias("magic"),
        codecs.frame_schema_id(value).alias("schema_id"),
        F.octet_length(codecs.unframe(value)).alias("payload_bytes"),
        F.decode(codecs.unframe(value), "UTF-8").alias("payload"),
    )


def strip_prefix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("gender", "payment", "quantity", "total")
    prefixed = sales(spark, sf_dir, *fields).toDF(*[f"sales.{f}" for f in fields])
    return strip_prefix(prefixed).groupBy("gender", "payment").agg(
        F.sum("quantity").alias("quantity"), _total("total", "total_sales")
    )


def batch_of_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(14,2)").alias("price")
    orders = files.with_arrival(table(spark, sf_dir, "orders")).select("o_orderkey", price, *files.ARRIVAL)
    return ordered.blocks_of(orders, ["o_orderkey", *files.ARRIVAL], keep=["o_orderkey", "price"]).groupBy("batch").agg(
        F.count("*").alias("records"), F.min("o_orderkey").alias("first_key"), _total("price", "total_price")
    )


def preview_first5(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return ordered.first_rows(orders, ["o_orderkey"])


def empty_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a price yield no predictions: an empty, readable output with all its columns."""
    nothing = prediction_set(spark, sf_dir, 5).where(F.col("Total").isNull()).select(*files.PREDICTIONS.names)
    path = scratch_dir(spark, "predictions")
    files.write_predictions(nothing, path)
    scanned = files.scan_predictions(spark, path)
    return scanned.agg(F.count("*").alias("records")).select(
        "records", F.lit(len(scanned.columns)).alias("columns"), F.lit(scanned.isEmpty()).alias("is_empty")
    )


QUERIES = {
    "view_sales_monthly": view_sales_monthly,
    "view_profitability": view_profitability,
    "view_product_performance": view_product_performance,
    "view_payment_method": view_payment_method,
    "view_gender": view_gender,
    "view_refresh_twice": view_refresh_twice,
    "orc_sales_roundtrip": orc_sales_roundtrip,
    "ingest_canonical": ingest_canonical,
    "ingest_mixed_headers": ingest_mixed_headers,
    "ingest_unique_ids": ingest_unique_ids,
    "scan_csv_infer": scan_csv_infer,
    "ingest_null_normalise": ingest_null_normalise,
    "ingest_reject_split": ingest_reject_split,
    "json_roundtrip": json_roundtrip,
    "json_reject_split": json_reject_split,
    "avro_frame_strip": avro_frame_strip,
    "strip_prefix": strip_prefix_query,
    "batch_of_50": batch_of_50,
    "preview_first5": preview_first5,
    "empty_predictions": empty_predictions,
}

# The sales mapping, written as inner joins over all six tables.
SALES_SQL = """
WITH sales AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS invoice_id,
         r_name AS branch,
         n_name AS city,
         CASE WHEN c_acctbal >= 5000 THEN 'Member' ELSE 'Normal' END AS customer_type,
         CASE WHEN l_linestatus = 'F' THEN 'Female' ELSE 'Male' END AS gender,
         p_type AS product_line,
         l_extendedprice / l_quantity AS unit_price,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS tax_5_percent,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS total,
         o_orderdate AS sale_date,
         strftime(o_orderdate, '%-m/%-d/%Y') AS "date",
         strftime(l_shipdate, '%H:%M') AS "time",
         o_orderpriority AS payment,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS cogs,
         100 * l_tax / (1 + l_tax) AS gross_margin_percentage,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS gross_income,
         CAST(40 + (l_partkey * 7 + l_linenumber) % 61 AS DOUBLE) / 10 AS rating
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)
"""

_PAYMENT_SQL = SALES_SQL + """
SELECT payment, CAST(SUM(total) AS DOUBLE) AS total_sales, COUNT(DISTINCT invoice_id) AS total_invoices
FROM sales GROUP BY payment"""

GENDER_SQL = SALES_SQL + """
SELECT gender, CAST(SUM(total) AS DOUBLE) AS total_sales, COUNT(DISTINCT invoice_id) AS total_invoices
FROM sales GROUP BY gender"""

ORACLES = {
    "view_sales_monthly": SALES_SQL + """
SELECT product_line, CAST(year(sale_date) AS INTEGER) AS year, CAST(month(sale_date) AS INTEGER) AS month,
       CAST(SUM(quantity) AS BIGINT) AS total_quantity, CAST(SUM(total) AS DOUBLE) AS total_sales
FROM sales GROUP BY ALL""",
    "view_profitability": SALES_SQL + """
SELECT product_line, CAST(SUM(total) AS DOUBLE) AS total_sales, CAST(SUM(cogs) AS DOUBLE) AS total_cost,
       CAST(SUM(total) - SUM(cogs) AS DOUBLE) AS total_profit
FROM sales GROUP BY product_line""",
    "view_product_performance": SALES_SQL + """
SELECT product_line, round(AVG(gross_margin_percentage), 8) AS avg_margin,
       CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold
FROM sales GROUP BY product_line""",
    "view_payment_method": _PAYMENT_SQL,
    "view_gender": GENDER_SQL,
    "view_refresh_twice": _PAYMENT_SQL,
    "orc_sales_roundtrip": SALES_SQL + """
SELECT branch, COUNT(*) AS records, CAST(SUM(total) AS DOUBLE) AS total_sales FROM sales GROUP BY branch""",
    "ingest_mixed_headers": SALES_SQL + """
SELECT invoice_id, branch, city, customer_type, gender, product_line, round(CAST(unit_price AS DOUBLE), 9) AS unit_price, quantity,
       CAST(tax_5_percent AS DOUBLE) AS tax_5_percent, CAST(total AS DOUBLE) AS total, "date", "time", payment,
       CAST(cogs AS DOUBLE) AS cogs, round(CAST(gross_margin_percentage AS DOUBLE), 9) AS gross_margin_percentage,
       CAST(gross_income AS DOUBLE) AS gross_income, round(rating, 9) AS rating, CAST(NULL AS VARCHAR) AS reject_reason
FROM sales""",
    "ingest_unique_ids": SALES_SQL + """
SELECT branch, COUNT(*) AS records, COUNT(*) AS ids, COUNT(*) AS ids_again FROM sales GROUP BY branch""",
    "ingest_canonical": SALES_SQL + """
SELECT branch, COUNT(*) AS records, CAST(0 AS BIGINT) AS refused, CAST(SUM(quantity) AS BIGINT) AS quantity,
       CAST(SUM(total) AS DOUBLE) AS total_sales, CAST(SUM(cogs) AS DOUBLE) AS total_cost,
       round(AVG(rating), 8) AS avg_rating, MIN("date") AS first_date_text, MAX("time") AS last_time_text
FROM sales GROUP BY branch""",
    "scan_csv_infer": SALES_SQL + """
SELECT branch, COUNT(*) AS records, CAST(SUM(quantity) AS BIGINT) AS quantity,
       CAST(SUM(total) AS DOUBLE) AS total_sales, round(AVG(rating), 8) AS avg_rating
FROM sales GROUP BY branch""",
    "ingest_null_normalise": """
SELECT event_type, COUNT(*) AS events, COUNT(*) FILTER (WHERE event_type = 'error') AS nan_before,
       CAST(0 AS BIGINT) AS nan_after, COUNT(*) FILTER (WHERE event_type = 'error') AS null_after,
       CAST(SUM(CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(18,4)) END) AS DOUBLE) AS total_value
FROM events GROUP BY event_type""",
    "ingest_reject_split": SALES_SQL + """
SELECT CASE WHEN rating = 4.0 AND payment = '4-NOT SPECIFIED' THEN 'quantity invalid; payment missing'
            WHEN rating = 4.0 THEN 'quantity invalid'
            WHEN payment = '4-NOT SPECIFIED' THEN 'payment missing'
            ELSE 'accepted' END AS outcome,
       COUNT(*) AS records
FROM sales GROUP BY outcome""",
    "json_roundtrip": SALES_SQL + """
SELECT city, customer_type, COUNT(*) AS records, CAST(SUM(total) AS DOUBLE) AS total_sales,
       CAST(SUM(gross_income) AS DOUBLE) AS total_gross_income, CAST(SUM(quantity) AS BIGINT) AS quantity,
       MAX(rating) AS best_rating, COUNT(DISTINCT (payment, gender)) AS customer_segments
FROM sales GROUP BY city, customer_type""",
    "json_reject_split": """
SELECT CASE event_type WHEN 'error' THEN 'rejected' WHEN 'signup' THEN 'kept with warning' ELSE 'kept' END AS outcome,
       COUNT(*) AS messages,
       CAST(SUM(CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(value AS DECIMAL(18,4)) END) AS DOUBLE)
         AS total_value
FROM events GROUP BY outcome""",
    "avro_frame_strip": SALES_SQL + f"""
SELECT invoice_id, 0 AS magic, {SCHEMA_ID} AS schema_id,
       CAST(octet_length(encode(concat_ws('|', invoice_id, product_line, payment, "time"))) AS INTEGER) AS payload_bytes,
       concat_ws('|', invoice_id, product_line, payment, "time") AS payload
FROM sales""",
    "strip_prefix": SALES_SQL + """
SELECT gender, payment, CAST(SUM(quantity) AS BIGINT) AS quantity, CAST(SUM(total) AS DOUBLE) AS total_sales
FROM sales GROUP BY gender, payment""",
    "batch_of_50": """
WITH numbered AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
SELECT CAST((rn - 1) // 50 AS BIGINT) AS batch, COUNT(*) AS records, MIN(o_orderkey) AS first_key,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total_price
FROM numbered GROUP BY 1""",
    "preview_first5": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5""",
    "empty_predictions": """
SELECT COUNT(*) AS records, 4 AS columns, COUNT(*) = 0 AS is_empty FROM orders WHERE o_totalprice IS NULL""",
}
