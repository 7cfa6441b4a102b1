import pytest
from pyspark.sql import functions as F

from salesflow.operators import views
from salesflow.plans import refresh
from salesflow.sources.tables import sales


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_repeated_invoice_counts_once_but_sums_twice(spark):
    df = spark.createDataFrame([("Cash", "i1", 1.0), ("Cash", "i1", 2.0), ("Card", None, 4.0)], "payment string, invoice_id string, total double")
    assert rows(views.payment_method_sales_summary(df)) == [("Card", 4.0, 0), ("Cash", 3.0, 1)]


def test_totals_beyond_32_bits(spark):
    df = spark.range(4).select(F.lit("A").alias("product_line"), F.lit(2**31 - 1).cast("int").alias("quantity"),
                               F.lit(1.0).alias("gross_margin_percentage"))
    assert views.product_performance_summary(df).first().total_quantity_sold == 4 * (2**31 - 1)


def test_views_of_nothing_are_empty(spark, sf):
    nothing = sales(spark, sf).where("total < 0")
    assert all(view(nothing).isEmpty() for view in views.VIEWS.values())


def test_views_from_partials_equal_views(spark, sf):
    all_sales = sales(spark, sf)
    halves = [all_sales.where("rating < 7"), all_sales.where("rating >= 7")]
    parts = [refresh.cube_parts(h) for h in halves]
    first, second = (refresh.invoice_keys(h) for h in halves)
    counts = refresh.count_parts(first).unionAll(refresh.count_parts(refresh.unseen(second, first)))
    merged = refresh.views_from_partials(refresh.merge_cubes(parts[0].unionByName(parts[1])), refresh.merge_counts(counts))
    for name, operator in views.VIEWS.items():
        expected, found = rows(operator(all_sales)), rows(merged[name])
        assert len(expected) == len(found)
        for a, b in zip(expected, found):
            assert all(x == y or x == pytest.approx(y, rel=1e-12) for x, y in zip(a, b)), (name, a, b)


def test_refresh_all_twice_and_after_growth(spark, sf, tmp_path):
    some = sales(spark, sf).where("gender = 'Female'")
    for df in (some, some, sales(spark, sf)):
        refresh.refresh_all(df, str(tmp_path), "grown_")
        for name, operator in views.VIEWS.items():
            table, expected = spark.table(f"grown_{name}"), operator(df)
            assert table.columns == expected.columns and table.count() == expected.count()
        assert rows(spark.table("grown_gender_sales_summary")) == rows(views.gender_sales_summary(df))


def test_empty_refresh_replaces_old_rows(spark, sf, tmp_path):
    everything = sales(spark, sf)
    for df in (everything, everything.where("total < 0")):
        refresh.publish_view(views.gender_sales_summary(df), "emptied_gender", str(tmp_path))
    assert spark.table("emptied_gender").isEmpty()


def test_unseen_treats_missing_members_as_equal(spark):
    schema = refresh.KEYS_SCHEMA
    history = spark.createDataFrame([("payment", None, "i1"), ("payment", "Cash", "i2")], schema)
    batch = spark.createDataFrame([("payment", None, "i1"), ("payment", None, "i3"), ("gender", "Cash", "i2")], schema)
    assert rows(refresh.unseen(batch, history)) == [("gender", "Cash", "i2"), ("payment", None, "i3")]
