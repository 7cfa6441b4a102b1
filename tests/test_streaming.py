"""Layer parity, replay, restart: streams end up with what the batch operators say."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesflow.functions.codecs import as_events, decode_json, encode_json
from salesflow.operators import speed, views
from salesflow.plans import refresh
from salesflow.plans.landing import sales_messages, sales_topic
from salesflow.session import streaming_session
from salesflow.sources import topic
from salesflow.sources.tables import sales
from salesflow.streaming import batch_layer, compaction, speed_layer
from salesflow.streaming.runners import latest, put_version, run_append, run_complete, run_paced, seconds_per_batch


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def messages(spark, sf):
    return lambda: sales_messages(spark, sf, files_per_trigger=2, messages_per_file=500)


def test_separate_queries_equal_batch(spark, sf, tmp_path):
    everything = sales(spark, sf)
    results = speed_layer.run_separately(sales_messages(spark, sf, streaming_session(spark, 3)), str(tmp_path))
    assert set(results) == set(speed.SPEED_VIEWS)
    for name, found in results.items():
        operator, projection = speed.SPEED_VIEWS[name]
        assert rows(found) == rows(operator(everything).selectExpr(*projection.split(", ")))


def test_state_is_carried_over_micro_batches(spark, sf, tmp_path):
    events = as_events(decode_json(sales_messages(spark, sf, streaming_session(spark, 3), 2, 500)))
    counts = events.groupBy("product_line").agg(F.count("*").alias("n"))
    query = run_complete(counts, f"{tmp_path}/out", f"{tmp_path}/ckpt")
    assert query.lastProgress["batchId"] >= 2
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
    assert latest(spark, f"{tmp_path}/out", counts.schema).agg(F.sum("n")).first()[0] == sales(spark, sf, "gender").count()


def test_restart_adds_nothing_and_continues(spark, sf, tmp_path):
    path, out = f"{tmp_path}/topic", f"{tmp_path}/out"
    first, second = (sales(spark, sf).where(F.col("gender") == g) for g in ("Female", "Male"))

    def run():
        events = as_events(decode_json(topic.subscribe(spark, path, 2)))
        run_append(speed.top_rated(events).select("id", "rating"), out, f"{tmp_path}/ckpt")
        return spark.read.parquet(out).count()

    topic.publish(encode_json(first), path, 500)
    expected = speed.top_rated(first).count()
    assert run() == expected
    assert run() == expected
    topic.publish(encode_json(second), path, 500)
    assert run() == expected + speed.top_rated(second).count()


def test_batch_loop_with_every_batch_replayed(spark, sf, messages, tmp_path):
    query = batch_layer.run_batch_loop(messages(), str(tmp_path), "replayed_", replays=1)
    last = query.lastProgress["batchId"]
    assert last >= 2 and len(seconds_per_batch(query)) == last + 1
    everything = sales(spark, sf)
    assert batch_layer.stored_sales(spark, str(tmp_path)).count() == everything.count()
    for name, operator in views.VIEWS.items():
        expected, found = rows(operator(everything)), rows(spark.table(f"replayed_{name}"))
        assert len(expected) == len(found)
        for a, b in zip(expected, found):
            assert all(x == y or x == pytest.approx(y, rel=1e-12) for x, y in zip(a, b)), (name, a, b)


def test_many_batches_stay_few_files_and_cost_what_the_second_does(spark, sf, tmp_path):
    """Merged twice over; every version a reader may hold stays whole, and no batch reads those before it."""
    root, held = str(tmp_path), []
    stream = sales_messages(spark, sf, files_per_trigger=1, messages_per_file=250)
    put = compaction.put_version

    def noted(result, path, version, **options):
        put(result, path, version, **options)
        if path.endswith("manifests") and version in (7, 15):  # readers that began before the next merge
            held.append((batch_layer.stored_sales(spark, root), batch_layer.stored_sales(spark, root).count()))
        if held and version in (8, 16):
            assert held[-1][0].count() == held[-1][1]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(compaction, "put_version", noted)
        query = batch_layer.run_batch_loop(stream, root, "many_")
    seconds = seconds_per_batch(query)
    last = query.lastProgress["batchId"]
    assert last >= 20 and len(held) == 2
    everything = sales(spark, sf)
    assert batch_layer.stored_sales(spark, root).count() == everything.count()
    folders = compaction.listed(spark, f"{root}/manifests")
    assert len(folders) <= 2 * compaction.FANOUT and folders[0]["tier"] == 1
    for merged in (r["folder"] for r in folders if r["tier"]):
        assert len(list(Path(merged).glob("part=sales/*.orc"))) == 1
    assert len(list((tmp_path / "cube").iterdir())) == 3
    keys = [refresh.invoice_keys(everything).count()]
    assert [s["numRowsTotal"] for s in query.lastProgress["stateOperators"]] == keys
    assert sorted(seconds.values())[len(seconds) // 2] * 3 > seconds[last]
    for name, operator in views.VIEWS.items():
        assert len(rows(operator(everything))) == spark.table(f"many_{name}").count()
    counted = spark.table("many_gender_sales_summary").agg(F.sum("total_invoices")).first()[0]
    assert counted == everything.select("gender", "invoice_id").distinct().count()


def test_batch_loop_sets_bad_messages_aside(spark, sf, tmp_path):
    path = f"{tmp_path}/topic"
    good = encode_json(sales(spark, sf).where("quantity = 1"), key="id")
    incomplete = good.selectExpr("key", "replace(cast(value AS string), '\"rating\"', '\"r\"') AS v").limit(1)
    texts = [("x", "garbage"), ("y", '{"branch": "A"}')]
    bad = spark.createDataFrame(texts, "k string, v string").select(
        F.encode("k", "UTF-8").alias("key"), F.encode("v", "UTF-8").alias("value")
    )
    topic.publish(good.unionByName(bad), path)
    topic.publish(incomplete.select("key", F.encode("v", "UTF-8").alias("value")), path)
    batch_layer.run_batch_loop(topic.subscribe(spark, path), f"{tmp_path}/root", "aside_")
    assert batch_layer.stored_sales(spark, f"{tmp_path}/root").count() == good.count()
    reasons = sorted(r.reject_reason[:17] for r in batch_layer.refused_messages(spark, f"{tmp_path}/root").collect())
    assert reasons == ["id missing; invoi", "malformed message", "rating missing"]


def test_speed_layer_equals_batch(spark, sf, messages, tmp_path):
    root = str(tmp_path)
    speed_layer.run_speed_layer(messages(), root)
    before = {name: rows(view) for name, view in speed_layer.current_views(spark, root).items()}
    versions = [p.name for p in (tmp_path / "running").iterdir()]
    assert len(versions) == 3 and speed_layer.running_sums(spark, root).inputFiles()  # one snapshot is read, three stay
    assert {Path(f).parent.name for f in speed_layer.running_sums(spark, root).inputFiles()} == {max(versions, key=lambda v: int(v.split("=")[1]))}
    everything = sales(spark, sf)
    for name, found in before.items():
        assert found == rows(speed.SPEED_VIEWS[name][0](everything))
    count = speed.top_rated(everything).count()
    assert spark.read.parquet(f"{root}/top_rated").count() == count
    first = spark.read.parquet(f"{root}/top_rated/batch_id=0").count()
    taken = spark.read.schema(topic.MESSAGES).parquet(sales_topic(spark, sf)).limit(0)
    speed_layer.store_batch(taken, 99, root)  # an empty batch adds nothing either
    assert spark.read.parquet(f"{root}/top_rated").count() == count and first > 0
    assert {name: rows(view) for name, view in speed_layer.current_views(spark, root).items()} == before


def test_speed_layer_batch_stored_twice(spark, sf, tmp_path):
    whole = spark.read.schema(topic.MESSAGES).parquet(sales_topic(spark, sf))
    for _ in range(2):
        speed_layer.store_batch(whole, 0, str(tmp_path))
    everything = sales(spark, sf)
    for name, view in speed_layer.current_views(spark, str(tmp_path)).items():
        assert rows(view) == rows(speed.SPEED_VIEWS[name][0](everything))
    assert spark.read.parquet(f"{tmp_path}/top_rated").count() == speed.top_rated(everything).count()


def test_named_view_is_readable_by_sql_on_a_stream(spark, messages):
    result = speed.named_query(as_events(decode_json(messages())), "top_rated_products_view")
    assert result.isStreaming and result.columns == ["id", "product_line", "rating"]


def test_views_of_one_session_do_not_take_each_others_rows(spark, sf):
    events = sales(spark, sf)
    first = speed.named_query(events.where("gender = 'Male'"), "total_quantity_by_product_view")
    second = speed.named_query(events.where("1 = 0"), "total_quantity_by_product_view")
    assert first.count() > 0 and second.count() == 0 and spark.table("total_quantity_by_product_view").count() == 0


def test_paced_batches_begin_apart_also_after_a_slow_one(spark, messages, tmp_path):
    slow = lambda batch, batch_id: time.sleep(1.3 if batch_id == 1 else 0)
    taken = run_paced(messages(), lambda b, i: (b.count(), slow(b, i)), f"{tmp_path}/ckpt", 0.7)
    assert len(taken) >= 3 and [t.batch_id for t in taken] == list(range(len(taken)))
    assert all(t.rows <= 2 * 500 for t in taken)
    assert all(b.began - a.began >= 0.7 for a, b in zip(taken, taken[1:])) and taken[2].began - taken[1].began >= 1.3


def test_refused_messages_are_kept_with_a_reason(spark, tmp_path):
    texts = ['{"id": "a", "customer_type": "x", "total": 1e15}', '{"id": "b", "customer_type": "x", "total": 0.00004}',
             '{"id": "c", "customer_type": "x", "total": 5.0}', '{"id": "d", "total": 1e18}', '{"total": 2}', "garbage"]
    bodies = spark.createDataFrame([(t,) for t in texts], "t string")
    topic.publish(bodies.select(F.lit(None).cast("binary").alias("key"), F.encode("t", "UTF-8").alias("value")), f"{tmp_path}/topic")
    found = speed_layer.run_view(topic.subscribe(spark, f"{tmp_path}/topic"), "total_sales_by_customer_type_view", f"{tmp_path}/view")
    assert rows(found) == [("x", 1e15 + 5.00004)]
    reasons = sorted(r.reject_reason for r in spark.read.parquet(f"{tmp_path}/view/rejected").collect())
    assert reasons == ["id missing", "malformed message", "total does not fit"]


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path, schema = f"{tmp_path}/v", spark.range(1).schema
    assert latest(spark, path, schema).isEmpty()
    for version in range(5):
        put_version(spark.range(version + 1), path, version)
    begun = latest(spark, path, schema)
    with pytest.raises(Exception):
        put_version(spark.range(9).select(F.raise_error(F.lit("lost")).cast("long").alias("id")), path, 5)
    assert latest(spark, path, schema).count() == 5
    put_version(spark.range(7), path, 5)
    put_version(spark.range(99), path, 5)  # a replay of a complete version
    assert latest(spark, path, schema).count() == 7 and begun.count() == 5
    assert len(list((tmp_path / "v").iterdir())) == 3
