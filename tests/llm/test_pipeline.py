"""The pipeline on a small table, beside plain Python for what its stages decide."""

from __future__ import annotations

import corpus_pipeline
from salesflow.llm import near_duplicates
from salesflow.session import scratch_scope, stage
from tests.llm.test_operators import _bodies, _linked_components


def test_stages_on_documents(spark, sf):
    with scratch_scope(spark):
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        columns, kept = docs.columns, {}
        for name, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, sf), "test-stage")
            kept[name] = docs.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == columns
    good = [(r.doc_id, r.text) for r in kept["quality classifier"]]
    groups = {}
    for doc_id, text in good:
        groups.setdefault(_bodies(text), []).append((-len(text or ""), doc_id))
    single = {min(g)[1] for g in groups.values()}
    assert {r.doc_id for r in kept["exact dedup"]} == single
    linked = _linked_components([x for x in good if x[0] in single])
    assert {r.doc_id for r in kept["MinHash near-dedup"]} == {d for d, (_, c) in linked.items() if c == d}
    assert {r.doc_id for r in kept["best-fit packing"]} == {r.doc_id for r in kept["MinHash near-dedup"]}
    assert corpus_pipeline.run(spark, sf).count() == len(kept["best-fit packing"])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    stays = {d for d, _ in good}
    clean = [d in stays for d, q in labels.items() if q == 1]
    assert sum(clean) / len(clean) > 0.97


def test_one_of_near_copies_stays_with_missing_and_repeated_ids(spark, sf):
    def text(name, last):
        return " ".join([f"{name}{i}" for i in range(40)] + [last])

    groups = {
        "a": [(None, "x"), (None, "y"), (None, "z")],  # no id at all
        "b": [(1, "x"), (5, "y"), (None, "z")],  # ids that other, lone documents have as well
        "c": [(9, "x"), (9, "y")],  # near copies under one id
        "lone": [(5, "x")],
        "own": [(None, "x")],
    }
    docs = [(doc_id, text(name, last)) for name, rows in groups.items() for doc_id, last in rows]
    docs += [(1, text("b", "x")), (20, " "), (21, None)]  # a repeated row, rows without words
    with scratch_scope(spark):
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        rows = corpus_pipeline.drop_near_copies(spark, df, sf).collect()
        kept = near_duplicates.decisions(df).where("kept").count()
    assert sorted((r.text or "").split("0 ")[0] for r in rows) == ["", " ", "a", "b", "c", "lone", "own"]
    assert next(r.doc_id for r in rows if (r.text or "").startswith("b0")) == 1
    assert kept == len(rows)
