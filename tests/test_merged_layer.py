from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesflow.functions.codecs import encode_json
from salesflow.operators.views import VIEWS
from salesflow.schema import SALES
from salesflow.sources import topic
from salesflow.sources.tables import sales
from salesflow.streaming import merged_layer
from salesflow.streaming.runners import complete_versions


def rows(view):
    return sorted(
        tuple(round(float(v), 6) if isinstance(v, (float, Decimal)) else v for v in r) for r in view.collect()
    ), view.columns


def agree(spark, root, everything):
    found = merged_layer.combined_views(spark, root)
    assert set(found) == set(VIEWS)
    for name, operator in VIEWS.items():
        expected = operator(everything)
        assert rows(found[name].select(*expected.columns)) == rows(expected), name


@pytest.fixture(scope="module")
def halves(spark, sf):
    """Four parts of the sales, cut across invoices, so that an invoice is met by both layers."""
    everything = sales(spark, sf).select(*SALES.names)
    part = F.pmod(F.xxhash64("id"), F.lit(4))
    return [everything.where(part == i) for i in range(4)]


def test_layers_answer_together_at_every_hand_over(spark, halves, tmp_path):
    root, so_far = str(tmp_path / "layers"), None
    for batch_id, part in enumerate(halves):
        for _ in range(2):  # a replayed batch changes nothing
            merged_layer.store_batch(encode_json(part, key="id"), batch_id, root)
        so_far = part if so_far is None else so_far.unionByName(part)
        agree(spark, root, so_far)
        if batch_id in (0, 2):
            assert merged_layer.consolidate(spark, root, batch_id) == batch_id
            assert merged_layer.consolidate(spark, root, batch_id) == batch_id
            agree(spark, root, so_far)
    assert merged_layer.handover(spark, root) == 2
    # both layers hold batches 1 and 2; batch 3 is the speed layer's alone
    assert merged_layer.stored_batches(spark, root) == [1, 2, 3]
    merged_layer.store_batch(encode_json(halves[0], key="id"), 0, root)  # taken over long ago
    agree(spark, root, so_far)


def test_a_failed_hand_over_leaves_the_one_before(spark, halves, tmp_path):
    root = str(tmp_path / "failed")
    for batch_id, part in enumerate(halves[:2]):
        merged_layer.store_batch(encode_json(part, key="id"), batch_id, root)
    merged_layer.consolidate(spark, root, 0)
    (tmp_path / "failed" / "batch_keys" / "version=1").mkdir()
    assert merged_layer.handover(spark, root) == 0
    agree(spark, root, halves[0].unionByName(halves[1]))
    assert merged_layer.consolidate(spark, root) == 1
    agree(spark, root, halves[0].unionByName(halves[1]))


def test_before_the_first_batch_all_views_are_empty(spark, tmp_path):
    root = str(tmp_path / "none")
    assert merged_layer.consolidate(spark, root) == -1
    assert all(view.isEmpty() for view in merged_layer.combined_views(spark, root).values())


def test_stream_hands_over_as_it_goes(spark, halves, tmp_path):
    root, path = str(tmp_path / "run"), str(tmp_path / "topic")
    for part in halves:
        topic.publish(encode_json(part.coalesce(1), key="id"), path)
    topic.publish(spark.createDataFrame([(bytearray(b"k"), bytearray(b"not json"))], "key binary, value binary").coalesce(1), path)
    merged_layer.run_layers(topic.subscribe(spark, path, 1), root, 2)
    assert len(complete_versions(spark, f"{root}/batch_counts")) == 2
    assert merged_layer.handover(spark, root) == 3
    agree(spark, root, halves[0].unionByName(halves[1]).unionByName(halves[2]).unionByName(halves[3]))
    assert merged_layer.refused_messages(spark, root).count() == 1
