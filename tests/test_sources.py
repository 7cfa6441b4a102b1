import gzip

import pytest
from pyspark.sql import functions as F

from salesflow import session
from salesflow.schema import RAW, SALES
from salesflow.sources import files, kafka


def test_kafka_options():
    assert kafka.read_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest",
    }
    assert kafka.read_options("h:1", "t", "earliest", 50)["maxOffsetsPerTrigger"] == "50"
    assert kafka.write_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.acks": "all", "kafka.retries": "5",
        "kafka.delivery.timeout.ms": "120000",
    }


def test_sales_table_is_created_once(spark, sf, tmp_path):
    from salesflow.sources.tables import sales

    files.create_sales_table(spark, "sales_once", str(tmp_path / "s"))
    sales(spark, sf).limit(10).write.insertInto("sales_once")
    files.create_sales_table(spark, "sales_once", str(tmp_path / "s"))
    stored = spark.table("sales_once")
    assert stored.count() == 10
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in SALES]
    assert list((tmp_path / "s").glob("*.orc"))


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Session:
    def __init__(self, master, checkpoint=None):
        self.conf = _Conf(checkpoint)
        self.sparkContext = type("C", (), {"master": master, "applicationId": f"app-{master}"})()


def test_scratch_follows_the_cluster_setting():
    assert session.scratch_root(_Session("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"
    assert session.scratch_root(_Session("local[2]", "/shared")) == "/shared"
    with pytest.raises(RuntimeError):
        session.scratch_root(_Session("yarn"))


def test_scratch_dirs_are_never_reused(spark):
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")


def test_stage_returns_the_written_rows(spark):
    staged = session.stage(spark.range(10), "staged")
    assert staged.count() == 10
    assert "Range" not in staged._jdf.queryExecution().optimizedPlan().toString()


def test_raw_csv_is_read_by_header_names_with_quotes_and_missing_markers(spark, tmp_path):
    from salesflow.operators.ingest import tag_rejects
    from salesflow.schema import RAW_TO_FIELD

    values = dict.fromkeys(RAW_TO_FIELD, "1") | {"City": 'San ""Old"" Town, X', "Gender": "Female", "Payment": "NA", "Date": "1/5/2019"}
    names = ["Extra", *reversed(RAW_TO_FIELD)]
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join(f'"{values.get(n, "x")}"' for n in names) + "\n")
    row = tag_rejects(files.read_raw_csv(spark, str(tmp_path), as_text=True)).first()
    assert (row.city, row.gender, row.date, row.total) == ('San "Old" Town, X', "Female", "1/5/2019", 1)
    assert row.payment is None and row.reject_reason == "payment missing"
    typed = files.read_raw_csv(spark, str(tmp_path)).first()
    assert typed["City"] == 'San "Old" Town, X' and typed["Quantity"] == 1 and typed["Payment"] is None
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "b.csv").write_text("City,Gender\nx,y\n")
    with pytest.raises(ValueError, match="Invoice ID"):
        files.read_raw_csv(spark, str(tmp_path / "b"))


def test_equal_rows_have_ids_of_their_own(spark, tmp_path):
    """Two equal files, cut into many blocks: no id twice, the same ids in a second reading, also by one task."""
    lines = "\n".join(["a,b", *["same,row"] * 3000]) + "\n"
    for name in ("one", "two"):
        (tmp_path / f"{name}.csv").write_text(lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        scan = spark.read.csv(str(tmp_path), header=True).withColumn("id", F.lit("old"))
        first, again = (sorted(r.id for r in files.with_row_ids(df).collect()) for df in (scan, scan.coalesce(1)))
        assert scan.rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(set(first)) == 6000 and first == again
    assert files.with_row_ids(scan.limit(0)).columns == ["a", "b", "id"]


def test_files_with_different_headers(spark, tmp_path):
    names = [f.name for f in RAW.fields]
    values = {n: ("3" if n == "Quantity" else "1.5" if f.dataType.typeName() in ("double", "decimal") else f"{n}, x") for n, f in zip(names, RAW.fields)}

    def put(name, columns, opener=open, **more):
        cells = values | more
        with opener(tmp_path / name, "wt", encoding="utf-8", newline="") as out:
            out.write(",".join(columns) + "\r\n" + ",".join(f'"{cells[c]}"' for c in columns) + "\n")

    put("a.csv", names)
    put("b.csv", names[::-1], **{"City": "B"})
    put("c.csv.gz", ["Extra", *names[3:], *names[:3]], opener=gzip.open, Extra="own", City="C")
    put("d.csv", names, City="D")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "_ignored.csv").write_text("no,header")
    got = files.read_mixed_csv(spark, str(tmp_path))
    assert got.columns == names
    assert sorted((r["City"], r["Gender"], r["Quantity"]) for r in got.collect()) == [(c, "Gender, x", 3) for c in ("B", "C", "City, x", "D")]
    (tmp_path / "none").mkdir()
    assert files.read_mixed_csv(spark, str(tmp_path / "none"), as_text=True).count() == 0
    put("e.csv", names[1:])
    with pytest.raises(ValueError, match="Invoice ID"):
        files.read_mixed_csv(spark, str(tmp_path))
