import json

import pytest
from pyspark.sql import functions as F

from salesflow.functions import codecs
from salesflow.functions.cleaning import content_key
from salesflow.operators.speed import sales_by_city_product, top_rated
from salesflow.plans.landing import UNKEYED
from salesflow.schema import FIELDS, avro_schema, avro_schema_from_file
from salesflow.sources.tables import sales


def messages(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return df.select(F.encode("t", "UTF-8").alias("value"))


def test_bad_messages_are_set_aside(spark):
    decoded = codecs.decode_json(
        messages(spark, '{"id": "a", "total": 1.5}', "garbage", '{"id": "b", "total": 1.5', None, "[1]", "")
    )
    assert [r.id for r in codecs.as_events(decoded).collect()] == ["a"]
    assert codecs.rejected_events(decoded).count() == 5


def test_wrong_type_loses_the_field_only(spark):
    decoded = codecs.decode_json(messages(spark, '{"id": "a", "quantity": "x", "total": 2.5}'))
    row = codecs.as_events(decoded).first()
    assert (row.quantity, float(row.total)) == (None, 2.5)
    assert decoded.first()._corrupt_record is not None


def test_nan_rating_is_no_top_rating_and_sums_survive(spark):
    rows = ['{"id": "a", "rating": NaN, "total": NaN, "city": NaN}', '{"id": "b", "rating": 4.5, "total": 2.0}']
    events = codecs.as_events(codecs.decode_json(messages(spark, *rows)))
    assert [r.id for r in top_rated(events).collect()] == ["b"]
    assert [tuple(r) for r in sales_by_city_product(events).collect()] == [(None, None, 2.0)]


def test_only_named_fields_are_decoded(spark):
    decoded = codecs.decode_json(messages(spark, '{"id": "a", "total": 1.5, "quantity": "x"}'), ("id", "total"))
    assert decoded.columns == ["id", "total", "_corrupt_record"]
    assert [tuple(r) for r in decoded.collect()] == [("a", 1.5, None)]


def test_quote_and_unicode_survive(spark):
    df = spark.createDataFrame([("1", "O'Brien"), ("2", 'a "b" \\ ü\n'), ("3", None)], "id string, city string")
    encoded = codecs.encode_json(df, key="id")
    assert [bytes(r.key) for r in encoded.collect()] == [b"1", b"2", b"3"]
    assert json.loads(bytes(encoded.collect()[2].value)) == {"id": "3", "city": None}
    decoded = codecs.as_events(codecs.decode_json(encoded)).select("id", "city")
    assert decoded.exceptAll(df).isEmpty() and df.exceptAll(decoded).isEmpty()


def test_decode_happens_once_before_a_filter(spark, sf):
    events = codecs.as_events(codecs.decode_json(codecs.encode_json(sales(spark, sf))))
    plan = top_rated(events).select("id", "rating")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_frame_and_unframe(spark):
    df = spark.createDataFrame([(bytearray(b""),), (bytearray(b"abc\x00\xff"),)], "p binary")
    framed = df.select("p", codecs.frame(F.col("p"), 305419896).alias("value"))
    row = framed.orderBy(F.length("p").desc()).first()
    assert bytes(row.value) == b"\x00\x12\x34\x56\x78abc\x00\xff"
    v = F.col("value")
    out = framed.select("p", codecs.frame_magic(v), codecs.frame_schema_id(v), codecs.unframe(v)).collect()
    for p, magic, schema_id, payload in out:
        assert (magic, schema_id, payload) == (0, 305419896, p)


def test_avro_schema_has_the_contract(tmp_path):
    schema = json.loads(avro_schema())
    types = {f["name"]: f["type"] for f in schema["fields"]}
    assert tuple(types) == FIELDS
    assert types["quantity"] == "int" and types["rating"] == "float" and types["date"] == "string"
    path = tmp_path / "schema.avsc"
    path.write_text(avro_schema(namespace="shop"))
    assert json.loads(avro_schema_from_file(str(path)))["namespace"] == "shop"


def test_avro_roundtrip(spark, sf):
    rows = sales(spark, sf).limit(20).selectExpr(
        *[
            f"cast({f} as int) as {f}" if f == "quantity"
            else f"cast({f} as float) as {f}"
            if f in ("unit_price", "tax_5_percent", "total", "cogs", "gross_margin_percentage", "gross_income", "rating")
            else f
            for f in FIELDS
        ]
    )
    try:
        decoded = codecs.decode_avro(codecs.encode_avro(rows, 1)).collect()
    except Exception as error:
        if "avro" in str(error).lower():
            pytest.skip("the spark-avro package is not on the class path")
        raise
    assert len(decoded) == 20


def test_unframe_refuses_what_is_not_framed(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07ab"),), (bytearray(b"\x01\x00\x00\x00\x07ab"),), (bytearray(b"\x00\x00"),)], "v binary")
    assert [r[0] and bytes(r[0]) for r in df.select(codecs.unframe(F.col("v"))).collect()] == [b"ab", None, None]


def test_id_put_in_front_is_the_message_of_a_record_with_its_id(spark, sf):
    """Byte for byte, with missing fields, quotes, umlauts and no rows at all; the fields become text once."""
    odd = [("a", 'say "hi"', None), (None, "Köln\n", 0.5), (None, None, None), ("NaN", "", float("nan"))]
    for records in (sales(spark, sf, *UNKEYED), spark.createDataFrame(odd, "invoice_id string, city string, rating double")):
        keyed = records.withColumn("id", content_key(records.columns)).select("id", *records.columns)
        expected, found = codecs.encode_json(keyed, key="id"), codecs.encode_json_with_id(records)
        assert found.schema.simpleString() == expected.schema.simpleString()
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
        if "branch" in records.columns:
            assert found._jdf.queryExecution().optimizedPlan().toString().count("StructsToJsonEvaluator") == 1
    assert codecs.encode_json_with_id(sales(spark, sf, *UNKEYED).limit(0)).count() == 0
