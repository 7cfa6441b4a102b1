"""Parquet source tables, and the sales records derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions.cleaning import content_key
from salesflow.schema import FIELDS, RAW_TO_FIELD
from salesflow.sources.files import ARRIVAL, with_arrival

# Prices in cents times rates in hundredths are exact in this.
_EXACT = "decimal(18,4)"
_ORDER_FIELDS = {"date", "payment"}
_CUSTOMER_FIELDS = {"branch", "city", "customer_type"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """Sales records, one per line item; only the tables the asked-for fields need are joined.

    Each lookup is a left join on the looked-up table's unique key, so it
    neither drops nor multiplies line items, and leaving one out cannot
    change the other fields. No join carries a hint: Catalyst broadcasts
    ``nation``, ``region`` and any lookup whose measured size is under the
    threshold; beyond it, it sort-merges, and adaptive execution splits
    partitions of a hot order, customer or part. Line items are always the
    left side, the one that may be split. Parts are looked up first, while
    line items are narrow; orders last, so that the sales of an invoice come
    out side by side, which later combining and compression live on.
    """
    wanted = set(fields or FIELDS)
    with_id = "id" in wanted
    if with_id:
        wanted |= set(FIELDS)
    rows = table(spark, sf_dir, "lineitem")

    if "rating" in wanted:  # from the part's key, which then need not go further
        rows = rows.withColumn("rating", (40 + (F.col("l_partkey") * 7 + F.col("l_linenumber")) % 61).cast("double") / 10)
    if "product_line" in wanted:
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    if wanted & (_ORDER_FIELDS | _CUSTOMER_FIELDS):
        orders = table(spark, sf_dir, "orders")
        if wanted & _CUSTOMER_FIELDS:
            places = (
                table(spark, sf_dir, "customer")
                .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            )
            orders = orders.join(places, F.col("o_custkey") == F.col("c_custkey"), "left")
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")

    price = F.col("l_extendedprice").cast("decimal(12,2)")
    rate = F.col("l_tax").cast("decimal(4,2)")
    tax = (price * rate).cast(_EXACT)
    expressions = {
        "invoice_id": F.col("l_orderkey").cast("string"),
        "branch": F.col("r_name"),
        "city": F.col("n_name"),
        "customer_type": F.when(F.col("c_acctbal") >= 5000, "Member").when(F.col("c_acctbal") < 5000, "Normal"),
        "gender": F.when(F.col("l_linestatus") == "F", "Female").otherwise("Male"),
        "product_line": F.col("p_type"),
        "unit_price": F.col("l_extendedprice") / F.col("l_quantity"),
        "quantity": F.col("l_quantity").cast("int"),
        "tax_5_percent": tax,
        "total": (price * (F.lit(1) + rate)).cast(_EXACT),
        "date": F.date_format("o_orderdate", "M/d/yyyy"),
        "time": F.date_format("l_shipdate", "HH:mm"),
        "payment": F.col("o_orderpriority"),
        "cogs": price.cast(_EXACT),
        "gross_margin_percentage": 100 * F.col("l_tax") / (1 + F.col("l_tax")),
        "gross_income": tax,
        "rating": F.col("rating"),
    }
    records = rows.select(*[expression.alias(f) for f, expression in expressions.items() if f in wanted])
    if with_id:
        records = records.withColumn("id", content_key([f for f in FIELDS if f != "id"]))
    return records.select(*(fields or FIELDS))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records under the headers of the raw CSV file."""
    return sales(spark, sf_dir, *RAW_TO_FIELD.values()).toDF(*RAW_TO_FIELD)


def prediction_set(spark: SparkSession, sf_dir: str, modulus: int, arrival: bool = False) -> DataFrame:
    """One formula-made prediction per order: total plus a few cents, never from a model.

    With the arrival columns, (date, order, arrival) is a total order even
    where an order occurs many times.
    """
    orders = table(spark, sf_dir, "orders")
    total = F.col("o_totalprice").cast("decimal(14,2)")
    shift = F.lit("0.01").cast("decimal(3,2)") * (F.col("o_orderkey") % modulus - modulus // 2)
    return (with_arrival(orders) if arrival else orders).select(
        *(ARRIVAL if arrival else ()),
        "o_orderdate",
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("Invoice ID"),
        total.alias("Total"),
        (total + shift).cast("decimal(14,2)").alias("Prediction"),
        F.lit(0.5).alias("Prediction Time (s)"),
    )
