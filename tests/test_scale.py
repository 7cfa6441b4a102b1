"""What must not grow with the number of micro-batches, passes or files."""

import glob

import pyarrow.parquet as pq
import pytest

from salesflow.operators.views import gender_sales_summary
from salesflow.plans import batch_queries, landing, model_queries, stream_queries
from salesflow.plans.landing import files_for, publish_sales, sales_messages
from salesflow.session import held, scratch_dir
from salesflow.sources.tables import sales
from salesflow.streaming import batch_layer, compaction, runners, score_layer, speed_layer


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_sales_of_an_invoice_come_out_side_by_side(spark, sf, no_broadcast):
    parts = [[r[0] for r in p] for p in sales(spark, sf).select("invoice_id", "product_line", "payment").rdd.glom().collect()]
    runs = sum(sum(a != b for a, b in zip([None, *p], p)) for p in parts)
    assert runs == sales(spark, sf, "invoice_id").distinct().count()


def test_topic_is_packed_and_a_large_file_can_be_shared(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr("salesflow.sources.topic.ROW_GROUP", 1 << 16)
    publish_sales(sales(spark, sf).coalesce(1), str(tmp_path / "topic"), 50_000)
    [file] = glob.glob(f"{tmp_path}/topic/*.parquet")
    found = pq.ParquetFile(file).metadata
    assert found.row_group(0).column(1).compression == "ZSTD" and found.num_row_groups > 1


def test_scoring_lists_earlier_batches_once(spark, sf, tmp_path, monkeypatch):
    listed = []
    for module in (score_layer, runners):
        own = module.folders
        monkeypatch.setattr(module, "folders", lambda *a, own=own: listed.append(a[1]) or own(*a))
    model = model_queries.scoring.load_model(model_queries._saved_model(spark, sf))
    messages = sales_messages(spark, sf, files_per_trigger=1, messages_per_file=1000)
    score_layer.run_scoring(messages, model, str(tmp_path))
    assert len(runners.complete_versions(spark, f"{tmp_path}/scored")) >= 5
    assert len(listed) <= 3  # result and scored at the start, and the line above
    assert model_queries.files.scan_predictions(spark, f"{tmp_path}/result").count() == sales(spark, sf, "gender").count()
    assert score_layer.untimed(spark, str(tmp_path)) == []


def test_training_joins_run_once(spark, sf, monkeypatch, tmp_path):
    staged = []
    own = model_queries.scoring.stage
    monkeypatch.setattr(model_queries.scoring, "stage", lambda df, name: staged.append(own(df, name)) or staged[-1])
    digested = []
    digest = model_queries.scoring.rows_digest
    monkeypatch.setattr(model_queries.scoring, "rows_digest", lambda df, *s: digested.append(df) or digest(df, *s))
    model_queries.scoring.registered_model(model_queries._training_sales(spark, sf), str(tmp_path))
    assert len(staged) == 1 and digested == staged


def test_batches_grow_with_the_topic_but_stay_several():
    assert [files_for(n, 5) for n in (0, 6_000, 600_000, 36_000_000)] == [1, 1, 2, landing.FILES_PER_TRIGGER]


def test_paced_batches_do_not_multiply_with_the_messages(spark, sf, monkeypatch):
    taken = []
    own = stream_queries.run_paced
    monkeypatch.setattr(stream_queries, "run_paced", lambda *a: taken.extend(own(*a)) or taken)
    monkeypatch.setattr(stream_queries, "MESSAGES_PER_FILE", 100)
    monkeypatch.setattr(stream_queries, "FILES_ONE_BY_ONE", 6)
    found = stream_queries.stream_paced(spark, sf).collect()
    assert 1 < len(taken) <= 16 and sum(t.rows for t in taken) == sum(r["records"] for r in found)
    assert all(r["within_limit"] and r["apart"] for r in found)


def test_batch_loop_has_two_state_parts_a_core(spark, sf, monkeypatch):
    queries = []
    own = batch_layer.run_batch_loop
    monkeypatch.setattr(batch_layer, "run_batch_loop", lambda *a, **k: queries.append(own(*a, **k)) or queries[-1])
    monkeypatch.setitem(landing._TOPICS, (spark.sparkContext.applicationId, sf, landing.MESSAGES_PER_FILE), scratch_dir(spark, "own-topic"))
    publish_sales(sales(spark, sf), landing._TOPICS[spark.sparkContext.applicationId, sf, landing.MESSAGES_PER_FILE])
    assert stream_queries.batch_loop_views(spark, sf).count() == 2
    [state] = queries[0].lastProgress["stateOperators"]
    assert state["numShufflePartitions"] == 2 * spark.sparkContext.defaultParallelism


def test_batch_loop_views_replays_every_one_of_several_batches(spark, sf, monkeypatch):
    stored = []
    own = batch_layer.store_batch
    monkeypatch.setattr(batch_layer, "store_batch", lambda s, parts, batch_id, root: stored.append(batch_id) or own(s, parts, batch_id, root))
    topic_of = (spark.sparkContext.applicationId, sf, landing.MESSAGES_PER_FILE)
    monkeypatch.setitem(landing._TOPICS, topic_of, scratch_dir(spark, "own-topic"))
    publish_sales(sales(spark, sf), landing._TOPICS[topic_of], 1500)
    found = stream_queries.batch_loop_views(spark, sf).collect()
    batches = sorted(set(stored))
    assert len(batches) >= 3 and stored == [b for b in batches for _ in range(2)]
    assert sorted(map(tuple, found)) == sorted(map(tuple, gender_sales_summary(sales(spark, sf)).collect()))


def test_a_sale_is_not_rewritten_once_well_filled(spark, tmp_path):
    """Whatever the number of batches, merged folders of a full file stay; smaller ones go on being merged."""

    def run(name, file_bytes):
        rewritten = []

        def merge(folders, files, into):
            rewritten.extend(folders)
            parts = spark.read.parquet(*folders)
            parts.coalesce(files).write.parquet(into)

        for batch in range(9):
            folder = f"{tmp_path}/{name}/batch_id={batch}"
            spark.range(batch * 10, batch * 10 + 10).write.parquet(folder)
            compaction.add_batch(spark, f"{tmp_path}/{name}-m", folder, batch, merge, lambda a, b: f"{tmp_path}/{name}/batches={a}-{b}", 2, file_bytes)
        read = compaction.read_table(spark, f"{tmp_path}/{name}-m", lambda folders: spark.read.parquet(*folders))
        assert sorted(r[0] for r in read.collect()) == list(range(90))
        return sum("batches=" in f for f in rewritten)

    assert run("filled", 1) == 0
    assert run("small", 1 << 30) > 0


def test_ingest_reads_the_text_once_and_shuffles_ids_once(spark, sf):
    canonical = plan(batch_queries.ingest_canonical(spark, sf))
    assert canonical.count("FileScan csv") == 1 and "Join" not in canonical
    ids = plan(batch_queries.ingest_unique_ids(spark, sf))
    assert ids.count("Exchange hashpartitioning") == 2


def test_no_dictionary_of_what_never_repeats(spark, sf, tmp_path):
    publish_sales(sales(spark, sf, *landing.UNKEYED), f"{tmp_path}/topic")
    speed_layer.store_batch(spark.read.parquet(f"{tmp_path}/topic"), 0, str(tmp_path))
    for folder, columns in (("topic", {"key", "value"}), ("top_rated/batch_id=0", {"id"})):
        group = pq.ParquetFile(glob.glob(f"{tmp_path}/{folder}/*.parquet")[0]).metadata.row_group(0)
        chunks = {c.path_in_schema: c for c in map(group.column, range(group.num_columns))}
        assert all(chunks[c].compression == "ZSTD" and not chunks[c].has_dictionary_page for c in columns)


def test_decoded_messages_are_held_unpacked_and_let_go(spark):
    key = "spark.sql.inMemoryColumnarStorage.compressed"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), held(spark.range(9)) as kept:
        assert kept.is_cached and spark.conf.get(key) == "false" and kept.count() == 9
        raise ValueError
    assert not kept.is_cached and spark.conf.get(key) == before


def test_restart_publishes_and_takes_every_sale_of_both_halves(spark, sf, monkeypatch):
    published = []
    own = stream_queries.publish_sales
    monkeypatch.setattr(stream_queries, "publish_sales", lambda r, *a: published.append(r) or own(r, *a))
    found = stream_queries.stream_restart(spark, sf).collect()
    assert sum(r["records"] for r in found) == sum(p.count() for p in published) == sales(spark, sf, "gender").count()
    assert all(p.columns == list(landing.UNKEYED) for p in published)


def test_light_queries_take_more_files_at_a_time_than_the_loop(spark, sf, monkeypatch):
    limits = []
    own = stream_queries.topic.subscribe
    monkeypatch.setattr(stream_queries.topic, "subscribe", lambda s, p, n=None: limits.append(n) or own(s, p, n))
    stream_queries.stream_rejects(spark, sf)
    stream_queries._loop_messages(spark, sf)
    assert limits == [landing.FILES_PER_LIGHT_TRIGGER, landing.FILES_PER_TRIGGER] and limits[0] > limits[1]


def test_scored_join_looks_training_sales_up_once(spark, sf, monkeypatch):
    looked_up = []
    own = model_queries._training_sales
    monkeypatch.setattr(model_queries, "_training_sales", lambda *a: looked_up.append(a) or own(*a))
    found = model_queries.serve_scored_join(spark, sf).collect()
    assert len(looked_up) == 1 and all(r["pairs"] == r["close_pairs"] for r in found)
    assert len(found) == sales(spark, sf, "invoice_id").distinct().count()
