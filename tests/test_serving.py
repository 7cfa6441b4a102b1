import os

from pyspark.sql import functions as F

from salesflow.operators.comparison import compare_layers, prediction_difference, prediction_error
from salesflow.operators.ordered import last_rows, number_rows
from salesflow.schema import PREDICTIONS
from salesflow.sources import files


def predictions(spark, *rows):
    return spark.createDataFrame(list(rows), PREDICTIONS)


def test_join_pairs_repeated_invoices(spark):
    stream = predictions(spark, ("a", 1.0, 1.5, 0.1), ("a", 1.0, 1.25, 0.1), ("b", 2.0, 2.0, 0.1))
    batch = predictions(spark, ("a", 1.0, 1.0, 0.2), ("a", 1.0, 2.0, 0.2), ("c", 9.0, 9.0, 0.2))
    joined = prediction_difference(compare_layers(stream, batch))
    assert joined.columns == [
        "Invoice ID", "Total_stream", "Prediction_stream", "Prediction Time (s)_stream",
        "Total_batch", "Prediction_batch", "Prediction Time (s)_batch", "Prediction_Difference",
    ]
    assert sorted(r.Prediction_Difference for r in joined.collect()) == [-0.75, -0.5, 0.25, 0.5]


def test_error_sign(spark):
    assert prediction_error(predictions(spark, ("a", 1.0, 1.5, 0.1))).first().error == 0.5


def test_arrival_is_file_time_then_line(spark, tmp_path):
    """Files are read in the order of their modification time, whatever their names."""
    for name, stamp in (("z.csv", 1000), ("a.csv", 3000), ("m.csv", 2000)):
        path = tmp_path / name
        path.write_text("".join(f"{name}-{i},{i}.0,{i}.5,0.1\n" for i in range(40)))
        os.utime(path, (stamp, stamp))
    (tmp_path / "notes.txt").write_text("not,a,prediction,file\n")
    order = [f"{n}-{i}" for n in ("z.csv", "m.csv", "a.csv") for i in range(40)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        arrived = files.with_arrival(files.scan_predictions(spark, str(tmp_path)))
        numbered = number_rows(arrived, list(files.ARRIVAL), partitions=3)
        assert [r["Invoice ID"] for r in numbered.orderBy("row_number").collect()] == order
        latest = last_rows(arrived, list(files.ARRIVAL), 50)
        assert {r["Invoice ID"] for r in latest.collect()} == set(order[-50:])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_empty_output_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "out")
    files.write_predictions(predictions(spark, ("a", 1.0, 1.5, 0.1)), path)
    files.write_predictions(predictions(spark), path)
    scanned = files.scan_predictions(spark, path)
    assert scanned.isEmpty() and scanned.schema == PREDICTIONS


def test_scan_unites_folders_without_header(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    files.write_predictions(predictions(spark, ("a", 1.0, 1.5, 0.1)), one)
    files.write_predictions(predictions(spark, ("a", 1.0, 1.5, 0.1), ("b", 2.0, None, 0.1)), two)
    rows = files.scan_predictions(spark, one, two)
    assert sorted(tuple(r) for r in rows.where(F.col("Prediction").isNotNull()).collect()) == [("a", 1.0, 1.5, 0.1)] * 2
    assert rows.count() == 3


def test_describe_keeps_a_column_without_values(spark):
    from salesflow.operators.describe import describe

    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    got = {(r.column_name, r.statistic): r.value for r in describe(df, ["a", "b"]).collect()}
    assert got["b", "count"] == 0 and got["b", "mean"] is None and got["b", "50%"] is None
    assert got["a", "count"] == 2 and got["a", "50%"] == 2.0
