"""Training-data operators beside brute force, on odd rows and on hot groups."""

from __future__ import annotations

import json
import random
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salesflow.llm import block_names, components, language, licenses, line_quality, near_duplicates, numbering, sampling, sharding, voronoi
from salesflow.llm.queries import op7_language, op10_line_quality
from salesflow.session import stage

TEXTS = [
    None,
    "",
    " \t\n",
    "One two three four five six.",
    "One  two three\tfour five six.",
    "ONE two three four five SIX.",
    "one two",
    "one two",
    "ñandú über 漢字 😀",
    "x" * 9000,
    "x" * 9001,
    "lorem ipsum dolor sit amet " * 3000,
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and keys, columns with clashing names."""
    rows = [(i, t, "a", 1, 0.5) for i, t in enumerate(TEXTS)] + [(None, "one two", "b", 2, 0.1), (None, None, None, 3, 0.2)]
    rows += [(3, TEXTS[3], "c", 4, None), (3, "other text under the same key", "c", 4, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, shard int, score double").repartition(4)


def _bodies(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def test_shards_and_slots_of_odd_rows(odd):
    rows = sharding.placements(odd, weights=[1.0] * 3).collect()
    assert len(rows) == odd.count()
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert {r.shard for r in rows} <= {0, 1, 2}
    assert all(r.grown_shard in (r.shard, 3) for r in rows)
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for (t,) in odd.select("text").collect())
    assert sorted((r.size, r.text_crc32) for r in rows) == want
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert sharding.placements(odd.limit(0)).count() == 0


def test_shards_follow_weights(spark):
    df = sharding.assign_shards(spark.range(20000), "id", [1.0, 2.0, 5.0])
    counts = {r[0]: r[1] for r in df.groupBy("shard").count().collect()}
    assert [round(counts[i] / 20000, 1) for i in range(3)] == [0.1, 0.2, 0.6] or abs(counts[2] / 20000 - 0.625) < 0.02
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), [1.0, 0.0])


def test_many_equal_rows_share_a_shard_with_gapless_slots(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("doc_id"), F.lit("same").alias("text")).repartition(7)
    rows = sharding.placements(df).collect()
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def _check_copies(rows, docs, key=_bodies):
    groups = {}
    for doc_id, text in docs:
        groups.setdefault(key(text), []).append((doc_id, text))
    assert len(rows) == len(docs)
    kept = sorted(r.group_size for r in rows if r.kept)
    assert kept == sorted(len(g) for g in groups.values())
    best = {b: min((-len(t or ""), d is None, d or 0) for d, t in g) for b, g in groups.items()}
    by_digest = {}
    for r in rows:
        by_digest.setdefault((r.text_sha256), set()).add((r.keep_id, r.group_size))
    assert len(by_digest) == len(groups)
    assert all(len(v) == 1 for v in by_digest.values())
    assert sorted((list(v)[0][0] or 0, list(v)[0][1]) for v in by_digest.values()) == sorted((best[b][2], len(g)) for b, g in groups.items())


@pytest.mark.parametrize("size", [1, 3, 4096])
def test_block_names_on_odd_rows(odd, size):
    docs = [(d, t) for d, t in odd.select("doc_id", "text").where("length(text) < 20 OR text IS NULL OR length(text) = 28").collect()]
    df = odd.where("length(text) < 20 OR text IS NULL OR length(text) = 28") if size == 1 else odd
    docs = docs if size == 1 else [(d, t) for d, t in odd.select("doc_id", "text").collect()]
    if size == 3:
        df, docs = df.where("text IS NULL OR length(text) < 9000"), [x for x in docs if len(x[1] or "") < 9000]
    _check_copies(block_names.exact_duplicates(df, size=size).collect(), docs)
    assert block_names.exact_duplicates(odd.limit(0)).count() == 0


def test_blocks_with_equal_digests_get_their_own_names(odd):
    docs = [(d, t) for d, t in odd.select("doc_id", "text").collect()]
    weak = lambda block: F.length(block).cast("long") % 3
    _check_copies(block_names.exact_duplicates(odd, size=2000, digest=weak).collect(), docs)


def test_numbers_are_gapless(spark):
    df = spark.range(1000).select((F.col("id") * 7).alias("x"))
    assert sorted(r.name for r in numbering.number(df, ["x"], buckets=13).collect()) == list(range(1, 1001))


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links for x in (a, b) if any(p != q and x in (p, q) for p, q in links)}
    part = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long"), rounds=1).collect()}
    assert all(find(c) == find(n) for n, c in part.items())


def _linked_components(docs):
    sets = {}
    for doc_id, text in docs:
        words = (text or "").encode().lower().split()
        width = min(5, len(words))
        sets[doc_id] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    docs, base = [], [rng.choice(words) for _ in range(120)]
    for i in range(150):  # a large group of near copies, some of them linked only through others
        own = list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = rng.choice(words)
        docs.append((1000 - i, " ".join(own)))
    for i in range(100):
        own = [rng.choice(words) for _ in range(rng.randint(0, 12))]
        docs.append((2000 + 2 * i, " ".join(own)))
        docs.append((2001 + 2 * i, " ".join(own + [rng.choice(words)]).upper()))
    docs += [(1, None), (2, " "), (3, "a b"), (4, "A  b"), (5, "a b c d e f g h"), (6, "a b c d e f g")]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, component_id string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(df).collect()}
    assert got == _linked_components(docs)


def test_near_duplicates_about_the_size_where_sketches_change(spark):
    """Sets below, at and above the size up to which all shingles are in the sketch, linked to each other and not."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(2300)]
    docs = []
    for i, size in enumerate([1540, 1700, 2040, 2051, 2053, 2060, 2200, 2300] * 3):
        own = base[:size]
        for _ in range(12 * (i // 8)):
            own[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(df).collect()}
    assert got == _linked_components(docs)


def test_compared_pairs_grow_with_the_links_not_with_all_pairs(spark, monkeypatch):
    """Texts of one origin of which most pairs are just too different: few pairs are fetched, all decisions are right."""
    compared = {}

    def counted(df, name):
        staged = stage(df, name)
        if name in ("open-pairs", "other-leaders"):
            compared[name] = compared.get(name, 0) + staged.count()
        return staged

    monkeypatch.setattr(near_duplicates, "stage", counted)
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(104)]
    docs = []
    for i in range(500):
        own = list(base)
        for place in rng.sample(range(104), 2):
            own[place] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(df).collect()}
    assert got == _linked_components(docs)
    assert compared["open-pairs"] < 6 * 500


def test_near_duplicates_of_odd_rows(odd):
    rows = near_duplicates.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert {r.component_id for r in rows if r.doc_id == 7} == {6}
    assert near_duplicates.near_duplicates(odd.limit(0)).count() == 0


def test_near_duplicates_with_missing_and_repeated_keys(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    docs, want = [], []
    for i in range(40):  # all sets have as many shingles, and half of the rows have no key or one key
        own = rng.sample(words, 60)
        key = (None, 7)[i % 2]
        docs += [(key, " ".join(own)), (100 + i, " ".join([*own[:-2], *rng.sample(words, 2)]))]
        want += [(key, 7 if key else 100 + i), (100 + i, 7 if key else 100 + i)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = near_duplicates.near_duplicates(df).collect()
    assert {r.n_shingles for r in rows} == {56}
    assert sorted((r.doc_id or 0, r.component_id) for r in rows) == sorted((d or 0, c) for d, c in want)


def test_sketch_tells_shared_samples():
    rng = np.random.default_rng(0)
    for size in (10, 100, 3000):
        common, one, two = (np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)) for n in (6 * size, size, size))
        sets = [np.unique(np.concatenate([common, own])) for own in (one, two)]
        bits = 64 * near_duplicates.SKETCH
        a, b = (near_duplicates.odd_sketch(found) for found in sets)
        if size <= 100:  # all shingles: never more bits than shingles differ, and nearly as many
            assert 2 * size - 12 <= int(np.bitwise_count(a ^ b).sum()) <= 2 * size
        samples = [near_duplicates.samples_of(found) for found in sets]
        n_a, n_b = map(len, samples)
        a, b = map(near_duplicates.odd_sketch, samples)
        odd_bits = int(np.bitwise_count(a ^ b).sum())
        shared = (n_a + n_b + bits / 2 * np.log(1 - 2 * odd_bits / bits)) / 2
        filled = (1 << near_duplicates.BINS) * (1 - np.exp(-8 * size / (1 << near_duplicates.BINS)))
        assert abs(shared / filled - 0.75) < 0.06


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, 8)).round(2)
    vectors[50:120] = vectors[7]  # a hot vector: ties by id
    rows = [(i, v.tolist(), i) for i, v in enumerate(vectors)]
    rows += [(300, None, 0), (301, [1.0, None], 0), (302, [float("nan")] * 8, 0), (303, [float("inf")] * 8, 0), (None, [1.0] * 8, 0)]
    rows += [(320, [0.5] * 3, 0), (340, [], 0), (5, vectors[5].tolist(), 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").repartition(3)
    got = voronoi.top_k(df, F.col("vec_id") % 20 == 0, pivots=6, block_rows=40).collect()
    table = {i: np.floor(64 * np.pad(np.array(v), (0, 8 - len(v)))).astype(int) for i, v, _ in rows if i is not None and v is not None and (not v or np.all(np.isfinite(np.array(v, dtype=float))))}
    want = []
    for q in table:
        if q % 20 == 0:
            best = sorted((-int(table[q] @ v), i) for i, v in table.items() if i != q)[:20]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert voronoi.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert voronoi.top_k(df.where("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0


def test_language_accuracy_and_odd_rows(spark, sf, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = op7_language(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.97
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out and 0 <= r.score <= 1 for r in rows)
    found = language.with_language(odd, language.fit(docs)).collect()
    assert len(found) == odd.count()
    assert {(r.lang_pred, r.score) for r in found if not any(c.isalpha() for c in r.text or "")} == {("und", 0.0)}
    empty = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.with_language(odd, empty).collect()} == {"und"}


def _plain_bayes(docs):
    """Naive Bayes over the same buckets, one n-gram at a time with dictionaries."""

    def buckets(text):
        codes = [32] + [ord(c) if c.isalpha() or ord(c) >= 0x300 else 32 for c in text.lower()] + [32]
        for order in language.ORDERS:
            for at in range(len(codes) - order + 1):
                h = order
                for code, factor in zip(codes[at : at + order], language._MULTIPLIERS.tolist()):
                    h = (h + code * factor) & 0xFFFFFFFF
                    h ^= h >> 15
                yield ((h * language._MULTIPLIERS.tolist()[-1]) & 0xFFFFFFFF) >> (32 - language.BITS)

    counts, documents = {}, {}
    for _, lang, text in docs:
        documents[lang] = documents.get(lang, 0) + 1
        own = counts.setdefault(lang, {})
        for b in buckets(text):
            own[b] = own.get(b, 0) + 1

    def predict(text):
        total = {}
        for lang, own in counts.items():
            size = sum(own.values()) + (1 << language.BITS)
            total[lang] = np.log(documents[lang] / sum(documents.values())) + sum(np.log((own.get(b, 0) + 1) / size) for b in buckets(text))
        best = max(sorted(total), key=total.get)
        return best, 1 / sum(np.exp(min(v - total[best], 0)) for v in total.values())

    return predict


def test_language_equals_plain_naive_bayes(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 3000")
    rows = sorted({(r.doc_id, r.lang, r.text) for r in docs.collect() if r.lang and any(map(str.isalpha, r.text or ""))})
    assert len(rows) > 50
    learned, asked = rows[::2], rows[1::2]
    df = spark.createDataFrame(learned + learned[:20], "doc_id long, lang string, text string").repartition(3)
    short = [t[:40] for *_, t in asked if any(map(str.isalpha, t[:40]))] + [t for *_, t in asked[:20]]
    found = language.with_language(spark.createDataFrame([(t,) for t in short], "text string"), language.fit(df)).collect()
    predict = _plain_bayes(learned)
    for r in found:
        lang, score = predict(r.text)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-3


def test_hundreds_of_languages_are_learned(spark):
    rng = np.random.default_rng(3)
    letters = [chr(0x4E00 + i) for i in range(4000)]
    rows = [(i, f"l{i % 400:03}", "".join(rng.choice(letters[10 * (i % 400) : 10 * (i % 400) + 10], 30))) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    model = language.fit(df)
    assert len(model.languages) == 400
    found = language.with_language(df.withColumnRenamed("lang", "true"), model).collect()
    assert sum(r.true == r.lang_pred for r in found) > 780
    parts = [model.scores([t])[0] for *_, t in rows[:30]]
    assert np.allclose(model.scores([t for *_, t in rows[:30]]), parts)


def test_only_blocks_that_are_asked_for_are_copied(spark):
    placed = spark.createDataFrame([(i, [i], [i], i % 4) for i in range(100)], "vid long, vector array<long>, ids array<long>, cell int")
    asked = spark.createDataFrame([(0, 0, 0), (0, 0, 5), (3, 0, 2)], "cell int, chunk int, part int")
    held = voronoi.needed_blocks(placed, asked, F.lit(1)).groupBy("cell", "part").count().collect()
    assert {(r.cell, r.part): r["count"] for r in held} == {(0, 0): 25, (0, 5): 25, (3, 2): 25}
    far = [[2.0**55, 1.0], [-(2.0**55), 1.0], [2.0**40, 0.0]]
    df = spark.createDataFrame(list(enumerate(far)), "vec_id long, embedding array<double>")
    rows = voronoi.top_k(df, F.col("vec_id") == 0).collect()
    assert [(r.vec_id, r.score) for r in rows] == [(2, 2**63 - 1), (1, -(2**63))]


def test_queries_are_sent_once_to_a_bin_and_a_few_rows_at_a_time(spark, monkeypatch):
    """Nothing a task holds grows with queries times cells, and bins of several cells give what brute force gives."""
    rng = np.random.default_rng(4)
    pivots = rng.integers(-64, 64, (1000, 16)).astype(float)
    bins = voronoi._bins(pivots, np.full(1000, 10), 200)
    assert set(np.bincount(bins)) == {20}
    cells = pd.DataFrame({"cell": range(1000), "radius": 200.0, "norm": 300.0, "n": 10, "ids": 10, "bin": bins, "chunks": 1})
    vectors = rng.integers(-64, 64, (10_000, 16))
    frame = pd.DataFrame({"vid": range(10_000), "vector": list(vectors), "cell": 0, "norm": np.sqrt((vectors**2).sum(axis=1)), "part": 0})
    run = voronoi._needed(pivots, cells, np.full(1000, 300.0), 21)
    tracemalloc.start()
    sent = [(len(f), f.drop_duplicates(["vid", "cell"]).shape[0]) for f in run(iter([frame]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(n for n, _ in sent) == 50 * 10_000 and all(n == own <= voronoi.AT_ONCE for n, own in sent)
    assert peak < 64 << 20

    monkeypatch.setattr(voronoi, "BINS", 3)
    values = rng.normal(size=(400, 8)).round(2)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "vec_id long, embedding array<double>")
    table = np.floor(64 * values).astype(int)
    want = [(q, r, i, -s) for q in range(0, 400, 20) for r, (s, i) in enumerate(sorted((-int(table[q] @ table[i]), i) for i in range(400) if i != q)[:5], 1)]
    for block_rows in (60, 8192):
        got = voronoi.top_k(df, F.col("vec_id") % 20 == 0, k=5, pivots=20, block_rows=block_rows).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_quality_accuracy_and_odd_rows(spark, sf, odd):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op10_line_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert sum(held) / len(held) > 0.9
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    field = line_quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), most_documents=100)
    scored = line_quality.with_quality(odd, field).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    none = line_quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet").limit(0))
    assert none.score("anything") == 0.5


def test_quality_in_stretches_equals_whole_texts(spark, sf, monkeypatch):
    """Measures and scores do not depend on how many lines are held at once; a text of very many lines takes bounded memory."""
    rng = np.random.default_rng(5)
    field = line_quality.QualityField(
        rng.random(line_quality.WIDTH), rng.random(line_quality.WIDTH) + 0.5, rng.normal(size=line_quality.WIDTH + 1),
        np.array([[0.7, -0.2], [-0.4, 0.5]]), (3.0, -1.0),
    )
    texts = [t or "" for (t,) in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(40).collect()]
    texts += ["", "\n", "\n" * 9, "a\nb\n\na\n", "ü\n漢字\nü", "one line"]
    for text in texts:
        whole = line_quality.Lines(text)
        measures, size = whole.features(0)
        assert len(whole) == 1 and len(size) == text.count("\n") + 1
        for at_once in (1, 2, 3, 7):
            lines = line_quality.Lines(text, at_once)
            parts = [lines.features(i) for i in range(len(lines))]
            assert [len(s) for _, s in parts[:-1]] == [at_once] * (len(parts) - 1)
            assert np.array_equal(np.vstack([m for m, _ in parts]), measures) and np.array_equal(np.concatenate([s for _, s in parts]), size)
    plain = [field.score(t) for t in texts]
    monkeypatch.setattr(line_quality.Lines.__init__, "__defaults__", (3,))
    assert np.allclose([field.score(t) for t in texts], plain, rtol=0, atol=1e-9)
    monkeypatch.undo()
    tracemalloc.start()
    assert 0 <= field.score("\n" * 300_000 + "end") <= 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20


def test_fitting_samples_are_bounded_where_a_key_repeats(spark, monkeypatch):
    same = spark.range(20000).select(F.lit("a").alias("lang"), F.lit(5).alias("doc_id"), F.col("id").cast("string").alias("text"))
    few = spark.range(4000).select(F.lit("b").alias("lang"), F.col("id").alias("doc_id"), F.lit(str(7)).alias("text")).where("doc_id < 9 OR doc_id = 3999")
    rows = same.union(few).union(few.withColumn("doc_id", F.lit(1)))
    sample = sampling.drawn(rows.repartition(5), {"a": 20000, "b": 10}, "lang", "doc_id", "text", 1000)
    assert 800 < sample.where("lang = 'a'").count() < 1200
    assert sample.where("lang = 'b'").count() == 10
    again = sampling.drawn(rows.repartition(3), {"a": 20000, "b": 10}, "lang", "doc_id", "text", 1000)
    assert sorted(sample.collect()) == sorted(again.collect())
    docs = [(5, f"one line {i}\nanother line of {i}") for i in range(600)] + [(6, "\n".join(f"row {i}" for i in range(250)))] * 3
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(5, 1), (5, 1), (5, 0), (6, 0), (6, 0)], "doc_id long, quality int")
    fitted = []
    monkeypatch.setattr(line_quality, "_fit", lambda measured, quality: fitted.append((measured, quality.tolist())))
    line_quality.fit(df, labels, most_lines=100)  # everything fits: each text once, the long one in three stretches
    line_quality.fit(df, labels, most_documents=100, most_lines=100)
    line_quality.fit(df, labels, most_lines=100, most_fitted=200)
    every, fewer, short = fitted
    assert sorted(every[1]) == [0] * 3 + [1] * 600
    whole = np.vstack([m for (m, _), q in zip(*every) if q == 0])
    assert len(whole) == 250 and sorted(whole.tolist()) == sorted(line_quality.Lines(docs[-1][1]).features(0)[0].tolist())
    assert 60 < len(fewer[1]) < 140
    assert 0 < sum(len(m) for m, _ in short[0]) < 500


def test_marginals_match_enumeration():
    import itertools

    rng = np.random.default_rng(3)
    odds, steps = rng.normal(size=6) * 2, rng.normal(size=(2, 2))
    total, good = 0.0, np.zeros(6)
    for path in itertools.product((0, 1), repeat=6):
        weight = np.exp(sum(o * y for o, y in zip(odds, path)) + sum(steps[a, b] for a, b in zip(path, path[1:])))
        total += weight
        good += weight * np.array(path)
    assert np.allclose(line_quality.marginals(odds.tolist(), steps), good / total)
    batch, _ = line_quality._expected(odds[None], np.ones((1, 6), bool), steps)
    assert np.allclose(batch[0], good / total)


def test_licences_by_evidence_and_nearest_directory(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License.", 1),
        (2, "a/b/c/x.txt", "nothing to see here", 1),
        (3, "a/b/COPYING", "Licensed under the Apache License, Version 2.0.", 1),
        (4, "a/y.txt", "This work is licensed under the GNU General Public License, version 3.\n" + " ".join(f"w{i}" for i in range(200)), 1),
        (5, "z/q.txt", "word " * 500, 1),
        (6, None, None, 1),
        (7, "a/b", "", 1),
        (2, "a/b/c/x.txt", "nothing to see here", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string, evidence int")
    got = sorted((json.dumps([r.doc_id, r.path, r.own_license, r.evidence, r.license, r.license_dir]) for r in licenses.scan(df).collect()))
    want = [
        [1, "a/LICENSE", "MIT", "file", "MIT", None],
        [2, "a/b/c/x.txt", None, "inherited", "Apache-2.0", "a/b"],
        [2, "a/b/c/x.txt", None, "inherited", "Apache-2.0", "a/b"],
        [3, "a/b/COPYING", "Apache-2.0", "file", "Apache-2.0", None],
        [4, "a/y.txt", "GPL-3.0", "header", "GPL-3.0", None],
        [5, "z/q.txt", None, None, None, None],
        [6, None, None, None, None, None],
        [7, "a/b", None, "inherited", "MIT", "a"],
    ]
    assert got == sorted(json.dumps(w) for w in want)
    assert licenses.scan(df.limit(0)).count() == 0


def test_a_hot_missing_key_is_ordered_by_many_tasks(spark):
    """A third of the rows without key and with different texts: gapless slots, no range of a shard near that third."""
    key = F.when(F.col("id") % 3 > 0, F.col("id"))
    df = spark.range(6000).select(key.alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    rows = sharding.placements(df.repartition(5), ranges=24).collect()
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    null = sorted((r.slot, r.size, r.text_crc32) for r in rows if r.doc_id is None)
    assert [n[1:] for n in null] == sorted(n[1:] for n in null)
    sizes = df.select(F.lit(0).alias("shard"), F.length("text").alias("size"), F.crc32(F.col("text").cast("binary")).alias("crc"))
    groups = sharding.ranged(sizes, ["shard", "size", "crc"], 24).groupBy("shard", "bucket").count().collect()
    assert len(groups) > 12 and max(g["count"] for g in groups) < 1000


def test_exact_copies_under_a_hot_missing_key(spark):
    """A third of the rows without key, some texts equal: one row of each group stays, and different texts are told apart."""
    key = F.when(F.col("id") % 3 > 0, F.col("id"))
    df = spark.range(900).select(key.alias("doc_id"), F.concat(F.lit("t "), (F.col("id") % 450).cast("string")).alias("text")).repartition(6)
    rows = block_names.exact_duplicates(df).collect()
    _check_copies(rows, [(r.doc_id, r.text) for r in df.collect()])
