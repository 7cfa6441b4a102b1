"""Packed token matrices: best-fit-decreasing rows of ids, segment lengths and position resets, in binary columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.encoding import loaded

#: Ids in a row of the matrix.
WIDTH = 4096
#: Ids a task gathers before it packs them; bounds its memory. Rows are filled to well over 99 % at this size.
WINDOW = 1 << 21
#: Rows of one result batch.
BATCH_ROWS = 256
#: Id that ends every document, and the id that fills up a row.
END_ID, PAD_ID = 1, 0

_COLUMNS = {
    "sequence_id": pa.int64(),
    "n_tokens": pa.int32(),
    "ids": pa.binary(),
    "cu_seqlens": pa.list_(pa.int32()),
    "positions": pa.binary(),
    "doc_ids": pa.list_(pa.int64()),
    "pieces": pa.list_(pa.int32()),
    "starts": pa.list_(pa.int64()),
}
SCHEMA = (
    "sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, positions binary,"
    " doc_ids array<long>, pieces array<int>, starts array<long>"
)


class CapacityTree:
    """A segment tree over free capacities: the smallest one that is at least a given length."""

    def __init__(self, most: int):
        self._size = 1 << most.bit_length()
        self._held = [0] * (2 * self._size)

    def add(self, capacity: int, times: int) -> None:
        node = self._size + capacity
        while node:
            self._held[node] += times
            node >>= 1

    def smallest(self, least: int) -> int | None:
        """The smallest capacity held that is at least ``least``."""
        held, node = self._held, self._size + least
        if held[node]:
            return least
        while node > 1:  # up to the first right sibling that holds something, then down its left side
            if not node & 1 and held[node + 1]:
                node += 1
                while node < self._size:
                    node = 2 * node if held[2 * node] else 2 * node + 1
                return node - self._size
            node >>= 1
        return None


def best_fit_decreasing(lengths: list[int], width: int) -> list[list[int]]:
    """Rows of indices; each length goes to the fullest row that still has room for it."""
    tree, rows, free = CapacityTree(width), [], [[] for _ in range(width + 1)]
    for index in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[index]
        room = tree.smallest(length)
        if room is None:
            row, room = len(rows), width
            rows.append([])
        else:
            row = free[room].pop()
            tree.add(room, -1)
        rows[row].append(index)
        free[room - length].append(row)
        tree.add(room - length, 1)
    return rows


def pack_matrix(
    df: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    window: int = WINDOW,
    end_id: int = END_ID,
    pad_id: int = PAD_ID,
) -> DataFrame:
    """Rows of a packed id matrix, with what is needed to take it apart again.

    ``ids`` holds ``width`` little-endian ids (16 bits if the vocabulary fits,
    else 32), filled up with ``pad_id`` after ``n_tokens``; ``cu_seqlens`` the
    cumulative segment lengths from 0; ``positions`` the place of each id in
    its segment as 32 bits, starting over at every segment. Per segment,
    ``doc_ids``, ``pieces`` and ``starts`` say which ids of which document it
    holds: documents longer than a row are cut without loss.

    Tasks pack their own rows, ``window`` ids at a time: no shuffle, bounded
    memory, and a repeated task gives the same rows. A missing or empty text is
    its end id alone; null keys and repeated rows are packed like others; an
    empty table gives no rows; other columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer)
        kind, end = "<u2" if encoder.size <= 1 << 16 else "<u4", np.array([end_id], "<u4").tobytes()
        made = TaskContext.get().partitionId() << 33

        def rows(pieces: list) -> Iterator[pa.RecordBatch]:
            nonlocal made
            packed, out = best_fit_decreasing([len(p[3]) for p in pieces], width), []
            for number, members in enumerate(packed):
                held = [pieces[i] for i in members]
                ends = np.cumsum([0, *(len(p[3]) for p in held)]).astype(np.int32)
                ids, places = np.full(width, pad_id, kind), np.zeros(width, "<u4")
                ids[: ends[-1]] = np.concatenate([p[3] for p in held])
                places[: ends[-1]] = np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))
                out.append((made, int(ends[-1]), ids.tobytes(), ends, places.tobytes(), *([p[i] for p in held] for i in range(3))))
                made += 1
                if len(out) == BATCH_ROWS or number + 1 == len(packed):
                    arrays = [pa.array(c, t) for c, t in zip(zip(*out), _COLUMNS.values())]
                    yield pa.RecordBatch.from_arrays(arrays, names=list(_COLUMNS))
                    out = []

        pieces, gathered = [], 0
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(encoder.encode(body.as_py() or "") + end, "<u4").astype(kind)
                for piece, at in enumerate(range(0, len(ids), width)):
                    pieces.append((doc, piece, at, ids[at : at + width]))
                    gathered += len(pieces[-1][3])
                    if gathered >= window:
                        yield from rows(pieces)
                        pieces, gathered = [], 0
        yield from rows(pieces)

    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def write_matrix(packed: DataFrame, path: str) -> None:
    """Write the rows once; Spark's committer drops what a lost task had written."""
    packed.write.option("compression", "zstd").parquet(path)


def segments(packed: DataFrame) -> DataFrame:
    """One row per segment of a packed matrix: doc_id, piece, start, sequence_id, offset, length."""
    each = packed.select("sequence_id", "cu_seqlens", "doc_ids", "pieces", F.posexplode("starts").alias("i", "start"))
    begin, end = F.element_at("cu_seqlens", F.col("i") + 1), F.element_at("cu_seqlens", F.col("i") + 2)
    return each.select(
        F.element_at("doc_ids", F.col("i") + 1).alias("doc_id"),
        F.element_at("pieces", F.col("i") + 1).alias("piece"),
        "start",
        "sequence_id",
        begin.alias("offset"),
        (end - begin).alias("length"),
    )
