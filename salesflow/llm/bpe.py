"""Exact byte-pair encoding by backtracking over longest matches, and decoding from an offset table."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Chunks, and words, that a worker remembers before it starts afresh.
REMEMBERED = 500_000
#: Bytes of token ids gathered into one batch of results; a longer text is a batch of its own.
BATCH_BYTES = 1 << 22

# Fixed values of the vocabulary file's format.
_END = "</w>"
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"

_LOADED: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    """The worker's coder for ``path``; later tasks of the worker find it warm."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if it prints, else the next free one above 255."""
    shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class OffsetTable:
    """Strings by id as one run of bytes and the offsets where each begins."""

    def __init__(self, strings: list[str], separator: str):
        raw = [(s + separator).encode() for s in strings]
        self._bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self._length = np.array([len(r) for r in raw], dtype=np.int64)
        self._start = np.cumsum(self._length) - self._length
        self._cut = len(separator.encode())

    def join(self, ids: np.ndarray) -> bytes:
        """The strings of ``ids`` with the separator between them."""
        if not len(ids):
            return b""
        length = self._length[ids]
        ends = np.cumsum(length)
        at = np.repeat(self._start[ids] - (ends - length), length)
        at += np.arange(ends[-1])
        return self._bytes[at].tobytes()[: -self._cut or None]


class Bpe:
    """A lower-casing word tokenizer with byte letters and word ends.

    A word is a string of symbols, one per byte; the last byte of a word is a
    symbol of its own kind. ``encode_word`` walks it from the left: the longest
    token that starts there (all are found by one Aho-Corasick pass) is taken
    if it is compatible with the token before it, else the next shorter one; a
    place from which nothing fits is remembered and the token before it given
    up. A chain of tokens in which all neighbours are compatible is the result
    of the merges, and every prefix of a word has one such chain, so a place is
    given up at most once.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = _byte_letters()
        symbols: dict[str, str] = {}
        for token in vocabulary:
            if len(token) == 1:
                symbols[token] = chr(letters[token])
            elif len(token) == 1 + len(_END) and token.endswith(_END):
                symbols[token] = chr(256 + letters[token[0]])
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special_pattern = re.compile("|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) or r"(?!)")
        self._rank: dict[int, int] = {}
        self._halves: dict[int, tuple[int, int]] = {}
        self._merge: dict[tuple[int, int], int] = {}
        self._pairs: dict[int, bool] = {}
        usable = {vocabulary[t] for t in symbols}
        for rank, (left, right) in enumerate(merges):
            token = vocabulary[left + right]
            a, b = vocabulary[left], vocabulary[right]
            symbols[left + right] = symbols[left] + symbols[right]
            # a token is of use if merging its own text ends in it
            if a in usable and b in usable and token not in usable and self._apart(a, b, rank):
                usable.add(token)
                self._rank[token], self._halves[token] = rank, (a, b)
            self._merge.setdefault((a, b), rank)
        self._find = ahocorasick.Automaton()
        for token, text in symbols.items():
            if vocabulary[token] in usable:
                self._find.add_word(text, (vocabulary[token], len(text)))
        self._find.make_automaton()
        by_id = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self._special.items()}
        size = max(by_id) + 1
        self.texts = OffsetTable([by_id.get(i, "") for i in range(size)], " ")
        self.decimals = OffsetTable([str(i) for i in range(size)], " ")
        self._split = regex.compile(_WORDS).findall
        self._remembered = remembered
        self._words: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {"": b""}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens along one edge of the token's merge tree, each with the rank at which it is merged further."""
        edge, until = [], float("inf")
        while True:
            edge.append((token, until))
            if token not in self._halves:
                return edge
            until, token = self._rank[token], self._halves[token][side]

    def _apart(self, left: int, right: int, before: float = float("inf")) -> bool:
        """No merge of rank below ``before`` joins the neighbours across their border.

        Parts a and b that meet there merge if the merge comes before either is
        merged away; of equal merges the one further left is done first.
        """
        for a, a_until in self._edge(left, 1):
            for b, b_until in self._edge(right, 0):
                rank = self._merge.get((a, b))
                if rank is not None and rank < before and rank < a_until and rank <= b_until:
                    return False
        return True

    def compatible(self, left: int, right: int) -> bool:
        pair = left << 20 | right
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) > 2 * self._remembered:
                self._pairs.clear()
            known = self._pairs[pair] = self._apart(left, right)
        return known

    def encode_word(self, symbols: str) -> list[int]:
        size = len(symbols)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
        for end, found in self._find.iter(symbols):
            starts[end + 1 - found[1]].append(found)  # shorter ones come first
        chain: list[int] = []
        trail: list[int] = []  # where each token of the chain begins
        dead: set[int] = set()
        at, compatible = 0, self.compatible
        while at < size:
            left = starts[at]
            while left:
                token, length = left.pop()
                if (not chain or compatible(chain[-1], token)) and at + length not in dead:
                    chain.append(token)
                    trail.append(at)
                    at += length
                    break
            else:
                dead.add(at)
                chain.pop()
                at = trail.pop()
        return chain

    def _word(self, word: str) -> bytes:
        raw = word.encode()
        symbols = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        return np.array(self.encode_word(symbols), dtype="<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        text = unicodedata.normalize("NFC", text)
        text = text.lower() if text.isascii() else "".join(map(str.lower, text))
        out = []
        for word in self._split(text):
            ids = self._words.get(word)
            if ids is None:
                if len(self._words) >= self._remembered:
                    self._words.clear()
                ids = self._word(word)
                if len(word) <= 64:
                    self._words[word] = ids
            out.append(ids)
        return b"".join(out)

    def _chunk(self, chunk: str) -> bytes:
        ids, at = [], 0
        for hit in self._special_pattern.finditer(chunk):
            ids += [self._plain(chunk[at : hit.start()]), np.array([self._special[hit.group()]], "<u4").tobytes()]
            at = hit.end()
        return b"".join([*ids, self._plain(chunk[at:])])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian unsigned 32-bit integers; blanks part words, so chunks are independent."""
        chunks = text.replace("\n", " ").split(" ")
        try:
            return b"".join(map(self._chunks.__getitem__, chunks))
        except KeyError:
            known, out = self._chunks, []
            if len(known) > self._remembered:
                known = self._chunks = {"": b""}
            for chunk in chunks:
                ids = known.get(chunk)
                if ids is None:
                    ids = self._chunk(chunk)
                    if len(chunk) <= 64:
                        known[chunk] = ids
                out.append(ids)
            return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens with one blank between them, in UTF-8; the vocabulary file names no decoder."""
        return self.texts.join(ids)


def encode_documents(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids binary): the ids of every whole text; a missing text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = loaded(tokenizer).encode
        for batch in batches:
            yield from _batches(batch, lambda text: (encode(text),), ["ids"], [pa.binary()])

    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, ids binary"
    )


def _batches(batch: pa.RecordBatch, apply, names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    keys, rows, held = [], [], 0

    def built() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(types)
        arrays = [pa.array(keys, pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *names])

    for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        row = apply(text.as_py() or "")
        keys.append(key)
        rows.append(row)
        held += sum(len(x) for x in row if isinstance(x, bytes))
        if held > BATCH_BYTES:
            yield built()
            keys, rows, held = [], [], 0
    yield built()


def round_trip(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row.

    Whole texts are encoded and decoded again where they are read, without a
    shuffle; only digests leave the task. A missing or empty text has no ids,
    and both digests are those of the empty string. Repeated rows and null keys
    give a row each; other columns are ignored, whatever their names. Memory is
    bounded by a few times the longest text and by ``REMEMBERED``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(tokenizer)

        def digests(text: str) -> tuple[int, str, str]:
            ids = np.frombuffer(bpe.encode(text), dtype="<u4")
            listed, said = hashlib.sha256(), hashlib.sha256()
            for at in range(0, len(ids), 1 << 20):  # a longer text is decoded in parts
                gap = b" " if at else b""
                listed.update(gap + bpe.decimals.join(ids[at : at + (1 << 20)]))
                said.update(gap + bpe.decode(ids[at : at + (1 << 20)]))
            return len(ids), listed.hexdigest(), said.hexdigest()

        for batch in batches:
            yield from _batches(batch, digests, ["n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.string(), pa.string()])

    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
