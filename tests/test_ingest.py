from decimal import Decimal

from salesflow.operators import ingest
from salesflow.schema import RAW_TO_FIELD, SALES
from salesflow.sources import files
from salesflow.sources.tables import raw_sales, sales, table

GOOD = {
    "Invoice ID": "750-67-8428", "Branch": "A", "City": "O'Brien", "Customer type": "Member", "Gender": "Female",
    "Product line": "Health", "Unit price": "74.69", "Quantity": "7", "Tax 5%": "26.1415", "Total": "548.9715",
    "Date": "1/5/2019", "Time": "13:08", "Payment": "Ewallet", "cogs": "522.83",
    "gross margin percentage": "4.761904762", "gross income": "26.1415", "Rating": "9.1",
}


def text_rows(spark, *changes):
    rows = [tuple({**GOOD, **change}.values()) for change in changes]
    schema = ", ".join(f"`{c}` string" for c in GOOD)
    return spark.createDataFrame(rows, schema)


def test_reject_reasons(spark):
    raw = text_rows(
        spark, {}, {"Quantity": "x"}, {"Rating": None}, {"Quantity": None, "Total": "1e99"}, {"Rating": "NaN"}
    )
    good, bad = ingest.split_rejects(raw)
    assert good.count() == 1 and good.columns == list(RAW_TO_FIELD.values())
    assert sorted(r.reject_reason for r in bad.collect()) == [
        "quantity invalid", "quantity missing; total invalid", "rating missing", "rating missing",
    ]
    row = good.first()
    assert (row.city, row.quantity, row.total) == ("O'Brien", 7, Decimal("548.9715"))


def test_canonical_types(spark):
    typed = ingest.canonicalise(text_rows(spark, {}))
    assert {f.name: f.dataType for f in typed.schema} == {f.name: f.dataType for f in SALES.fields if f.name != "id"}


def test_csv_copy_holds_every_sale(spark, sf, tmp_path):
    path = str(tmp_path / "raw")
    raw_sales(spark, sf).write.csv(path, header=True)
    read = ingest.canonicalise(files.read_raw_csv(spark, path))
    mine = sales(spark, sf, *RAW_TO_FIELD.values())
    assert read.exceptAll(mine).isEmpty() and mine.exceptAll(read).isEmpty()


def test_missing_csv_values_are_null(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(",".join(GOOD) + "\n" + ",".join(GOOD.values()).replace("Ewallet", "") + "\n")
    text = files.read_raw_csv(spark, str(path), as_text=True)
    good, bad = ingest.split_rejects(text)
    assert good.isEmpty() and bad.first().reject_reason == "payment missing"
    assert files.read_csv_inferred(spark, str(path)).first()["Quantity"] == 7


def test_leaving_out_lookups_changes_nothing(spark, sf):
    """The fields of a pruned record equal those of the full record."""
    full = sales(spark, sf)
    for fields in (("gender", "total"), ("product_line", "quantity"), ("payment", "date"), ("city", "branch", "rating")):
        pruned, whole = sales(spark, sf, *fields), full.select(*fields)
        assert pruned.exceptAll(whole).isEmpty() and whole.exceptAll(pruned).isEmpty()
    assert full.count() == table(spark, sf, "lineitem").count()


def test_views_read_only_their_columns(spark, sf):
    plan = sales(spark, sf, "gender", "total", "invoice_id")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert "l_linestatus" in plan and "l_shipdate" not in plan
