from datetime import date

from pyspark.sql import functions as F

from salesflow.functions.cleaning import content_key, nan_to_null, random_key, sale_date, strip_prefix
from salesflow.operators.views import sales_monthly_summary


def test_dates_of_both_widths_and_no_dates(spark):
    df = spark.createDataFrame([("1/5/2019",), ("01/05/2019",), ("13/45/2019",), ("bad",), (None,)], "t string")
    found = [r.d for r in df.select(sale_date(F.col("t")).alias("d")).collect()]
    assert found == [date(2019, 1, 5), date(2019, 1, 5), None, None, None]


def test_undated_sales_form_one_null_month(spark):
    rows = [("A", "bad", 1, 1.0), ("A", "13/45/2019", 2, 1.0), ("A", "1/5/2019", 4, 1.0), ("A", "01/05/2019", 8, 1.0)]
    sales = spark.createDataFrame(rows, "product_line string, date string, quantity int, total double")
    got = {(r.year, r.month): r.total_quantity for r in sales_monthly_summary(sales).collect()}
    assert got == {(None, None): 3, (2019, 1): 12}


def test_nan_becomes_null_everywhere(spark):
    df = spark.createDataFrame([(float("nan"), '"NaN"', 1), (2.0, "x", None)], "a double, b string, c int")
    assert [tuple(r) for r in nan_to_null(df).collect()] == [(None, None, 1), (2.0, "x", None)]


def test_prefix_is_stripped_only_where_present(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["sales.total", "other", "sales.a.b"])
    assert strip_prefix(df).columns == ["total", "other", "a.b"]


def test_content_key_is_repeatable_and_tells_null_from_empty(spark):
    df = spark.createDataFrame([("x", None), ("x", ""), ("x", None)], "a string, b string")
    keys = [r[0] for r in df.select(content_key(["a", "b"])).collect()]
    again = [r[0] for r in df.repartition(3).select(content_key(["a", "b"])).collect()]
    assert keys[0] == keys[2] != keys[1]
    assert sorted(keys) == sorted(again)


def test_random_key_differs_per_row(spark):
    assert spark.range(1000).select(random_key().alias("k")).distinct().count() == 1000
