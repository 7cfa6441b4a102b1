"""One order, part and customer hold a third of all rows; results stay whole and joins get split."""

import random

import pytest
from pyspark.sql import functions as F

from salesflow.operators import views
from salesflow.operators.comparison import compare_layers
from salesflow.sources.tables import sales

HOT = 7
LINES, ORDERS, PARTS, CUSTOMERS = 60000, 3000, 400, 300


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The source tables at a size where a third of the lines belongs to one order and one part."""
    folder = str(tmp_path_factory.mktemp("skewed"))

    def hot(key, count, salt):
        return F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(count)))

    tables = {
        "region": spark.range(5).selectExpr("cast(id AS int) r_regionkey", "concat('R', id) r_name"),
        "nation": spark.range(25).selectExpr("cast(id AS int) n_nationkey", "concat('N', id) n_name", "cast(id % 5 AS int) n_regionkey"),
        "customer": spark.range(CUSTOMERS).selectExpr("id c_custkey", "cast(id % 25 AS int) c_nationkey", "id * 40.0D c_acctbal"),
        "part": spark.range(PARTS).selectExpr("id p_partkey", "concat('T', id % 6) p_type"),
        "orders": spark.range(ORDERS).select(
            F.col("id").alias("o_orderkey"), hot("id", CUSTOMERS, 1).alias("o_custkey"),
            F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(cast(id % 400 AS int))").alias("o_orderdate"),
            F.expr("concat(id % 5 + 1, '-P')").alias("o_orderpriority"),
        ),
        "lineitem": spark.range(0, LINES, 1, 8).select(
            hot("id", ORDERS, 2).alias("l_orderkey"), hot("id", PARTS, 3).alias("l_partkey"),
            F.expr("cast(id % 7 AS int)").alias("l_linenumber"), F.expr("cast(id % 50 + 1 AS double)").alias("l_quantity"),
            F.expr("cast(id AS double) + 0.25D").alias("l_extendedprice"), F.lit(0.05).alias("l_tax"),
            F.expr("if(id % 2 = 0, 'F', 'O')").alias("l_linestatus"), F.expr("timestamp_ntz'2020-02-02'").alias("l_shipdate"),
        ),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture
def tight(spark):
    """Thresholds scaled down to the fixture, as a cluster's are to its data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "12k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_split_and_counted_right(spark, skewed, tight):
    view = views.payment_method_sales_summary(sales(spark, skewed, "payment", "total", "invoice_id"))
    assert "skew=true" in final_plan(view)
    expected = spark.sql(f"""
        SELECT o_orderpriority payment, cast(sum(l_extendedprice) * 1.05 AS double) total_sales,
               count(DISTINCT l_orderkey) total_invoices
        FROM parquet.`{skewed}/lineitem.parquet` JOIN parquet.`{skewed}/orders.parquet` ON l_orderkey = o_orderkey
        GROUP BY 1""")
    want = {r.payment: (r.total_sales, r.total_invoices) for r in expected.collect()}
    got = {r.payment: (r.total_sales, r.total_invoices) for r in view.collect()}
    assert got.keys() == want.keys()
    for key in want:
        assert got[key][1] == want[key][1] and got[key][0] == pytest.approx(want[key][0], rel=1e-9)


def test_all_lookups_keep_every_line(spark, skewed, tight):
    records = sales(spark, skewed, "branch", "city", "product_line", "payment", "quantity")
    plan = final_plan(records)
    assert plan.count("skew=true") >= 2
    assert records.count() == LINES
    assert records.where("branch IS NULL OR product_line IS NULL OR payment IS NULL").isEmpty()


def test_hot_invoice_in_the_comparison(spark, tight):
    rng = random.Random(3)
    stream = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("Invoice ID"),
        F.col("id").cast("double").alias("Total"), F.lit(rng.random()).alias("Prediction"),
    )
    batch = spark.range(30000).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("Invoice ID"),
        F.col("id").cast("double").alias("Total"), F.lit(1.0).alias("Prediction"),
    )
    joined = compare_layers(stream, batch)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 30000


def test_distinct_count_spreads_a_hot_group(spark, skewed):
    """The shuffle below the count is keyed by group and invoice, so one gender is no single task."""
    view = views.gender_sales_summary(sales(spark, skewed, "gender", "total", "invoice_id"))
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(gender" in plan and "invoice_id" in plan.split("hashpartitioning(gender")[2].split(")")[0]
