"""Encoding, packing and the token matrix, against the tokenizers library and against round trips."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from salesflow.llm import bpe, complement_packing, encoding, token_matrix
from salesflow.llm.queries import op2_token_matrix, op5_complement_packing, op6_bpe

ODD = [
    None,
    "",
    "   ",
    "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>",
    "It's we'll THEY'RE 'twas don't!!! 1234,5",
    "İstanbul İ< ΑΣ ẞ ﬁ ½ ٣ Å é ́x H̱",
    "漢字 한글 😀🇩🇪 ♥ ☺♥a  x y\x85z\x1cw",
    "a" * 500 + " " + "ab" * 400,
    "word " * 9000,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(encoding.vocabulary())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _random_texts(n):
    rng = random.Random(5)
    signs = "abcdehimnorstu  \n\t'.,!#-ABCéñßİσΣ1②́😀<|>"
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def test_both_coders_agree_with_the_library(library):
    fast, exact = encoding.Encoder(encoding.vocabulary(), remembered=300), bpe.Bpe(encoding.vocabulary(), remembered=300)
    for text in [t or "" for t in ODD] + _random_texts(3000):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(fast.encode(text), "<u4").tolist() == ids
        assert np.frombuffer(exact.encode(text), "<u4").tolist() == ids
        assert exact.decode(np.array(ids, "<u4")).decode() == library.decode(ids, skip_special_tokens=False)


def test_other_tokenizers_get_whole_texts():
    path = encoding.vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    text = "Hello  there,\n\n it's 3 o'clock"
    assert np.frombuffer(encoding.Encoder(path).encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_round_trip_query_matches_the_library(spark, sf, library):
    rows = {r.doc_id: r for r in op6_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        row = rows[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(said.encode()).hexdigest()


def _odd_table(spark):
    rows = [(i if i != 4 else None, t, "x", 7) for i, t in enumerate(ODD)] + [(1, "", "x", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int").repartition(3)


def _assert_packed(rows, docs, library, capacity, fewest=False):
    expected = {}
    for doc in docs:
        ids = library.encode(doc.text or "", add_special_tokens=False).ids + [1]
        expected.setdefault(doc.doc_id, []).append(ids)
    sequences, found = {}, {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
        found.setdefault(row.doc_id, []).append((row.piece, row.start, row.length, row.ids_crc32))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for doc, texts in expected.items():
        pieces = []
        for ids in texts:
            for piece, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at : at + capacity]
                pieces.append((piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
        assert sorted(pieces) == sorted(found.pop(doc))
    assert not found
    if fewest:
        assert len(sequences) == -(-sum(len(i) for t in expected.values() for i in t) // capacity)


def test_packing_query_is_lossless_and_tight(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    _assert_packed(op5_complement_packing(spark, sf).collect(), docs, library, 4096, fewest=True)


def test_packing_of_odd_rows(spark, library):
    df = _odd_table(spark)
    packed = complement_packing.pack_documents(df, encoding.vocabulary(), capacity=64).collect()
    _assert_packed(packed, df.collect(), library, 64)
    assert complement_packing.pack_documents(df.limit(0), encoding.vocabulary()).count() == 0


def test_plan_places_every_piece_once():
    rng = random.Random(1)
    for _ in range(100):
        capacity, counts = rng.choice([1, 8, 50, 4096]), {}
        for _ in range(rng.randint(0, 300)):
            length = min(capacity, 1 + int(rng.expovariate(5 / capacity)))
            counts[length] = counts.get(length, 0) + rng.choice([1, 1, 40])
        slots, rows = complement_packing.plan(counts, capacity), {}
        order = slots[:, 0] << 44 | slots[:, 1]
        for length, n in counts.items():
            for rank in range(n):
                slot = slots[np.searchsorted(order, length << 44 | rank, side="right") - 1]
                assert slot[0] == length
                past = rank - slot[1]
                rows.setdefault(slot[3] + past // slot[2], []).append((slot[4] + past % slot[2] * length, length))
        for row in rows.values():
            at = 0
            for offset, length in sorted(row):
                assert offset == at
                at += length
            assert at <= capacity


def test_exact_complements_fill_rows():
    slots = complement_packing.plan({10: 3, 6: 2, 4: 2, 5: 1, 3: 1, 2: 1}, 10)
    assert slots[:, 3].max() + 1 == 6  # 10 three times, 6+4 twice, 5+3+2
    assert complement_packing.plan({}, 10).shape == (0, 5)


def test_matrix_round_trip(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    _assert_matrix(op2_token_matrix(spark, sf).collect(), docs, library, 4096)
    odd = _odd_table(spark)
    rows = token_matrix.pack_matrix(odd, encoding.vocabulary(), width=100, window=300).collect()
    _assert_matrix(rows, odd.collect(), library, 100)
    assert token_matrix.pack_matrix(odd.limit(0), encoding.vocabulary()).count() == 0


def _assert_matrix(rows, docs, library, width):
    found = {}
    assert len({r.sequence_id for r in rows}) == len(rows)
    for row in rows:
        ids, places = np.frombuffer(row.ids, "<u2"), np.frombuffer(row.positions, "<u4")
        assert len(ids) == len(places) == width and row.cu_seqlens[0] == 0 and row.cu_seqlens[-1] == row.n_tokens
        assert not ids[row.n_tokens :].any()
        for i, (doc, piece, start) in enumerate(zip(row.doc_ids, row.pieces, row.starts, strict=True)):
            begin, end = row.cu_seqlens[i], row.cu_seqlens[i + 1]
            assert places[begin:end].tolist() == list(range(end - begin))
            found.setdefault(doc, []).append((start, piece, ids[begin:end].tolist()))
    want = {}
    for doc in docs:
        ids = library.encode(doc.text or "", add_special_tokens=False).ids + [1]
        want.setdefault(doc.doc_id, []).extend((at, at // width, ids[at : at + width]) for at in range(0, len(ids), width))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def test_matrix_is_written_and_taken_apart(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    packed = token_matrix.pack_matrix(docs, encoding.vocabulary(), width=512)
    token_matrix.write_matrix(packed, str(tmp_path / "matrix"))
    back = token_matrix.segments(spark.read.parquet(str(tmp_path / "matrix")))
    sums = back.groupBy("doc_id").sum("length").collect()
    counts = {r.doc_id: r.n_tokens + 1 for r in op6_bpe(spark, sf).collect()}
    assert {r[0]: r[1] for r in sums} == counts


def test_capacity_tree():
    rng = random.Random(3)
    tree, held = token_matrix.CapacityTree(40), []
    for _ in range(2000):
        if held and rng.random() < 0.4:
            out = held.pop(rng.randrange(len(held)))
            tree.add(out, -1)
        else:
            held.append(rng.randint(0, 40))
            tree.add(held[-1], 1)
        least = rng.randint(0, 40)
        assert tree.smallest(least) == min((h for h in held if h >= least), default=None)
    assert token_matrix.best_fit_decreasing([5, 5, 3, 7, 10], 10) == [[4], [3, 2], [0, 1]]
