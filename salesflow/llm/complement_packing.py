"""Packing token sequences into as few rows as possible: exact complements first, then best fit.

Only the histogram of lengths, at most ``capacity`` rows, passes through the
driver. Pieces find their places by their rank among the pieces of equal length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.encoding import loaded
from salesflow.session import stage

CAPACITY = 4096
#: Id that ends every document.
END_ID = 1
#: Ranges that the pieces of one length are ranked in.
BUCKETS = 1024

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, row long"


def token_pieces(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document; ``part`` and ``row`` tell repeated rows apart.

    A document is its ids and ``end_id``; a missing text has ``end_id`` alone.
    Documents beyond ``capacity`` are cut into pieces of that length, the last
    one shorter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = loaded(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            found = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(body.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    held = ids[at : at + 4 * capacity]
                    found.append((doc, piece, at // 4, len(held) // 4, zlib.crc32(held), part, row))
                    row += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "row"]
            columns = list(zip(*found)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, _PIECES)


def _exact(count: np.ndarray, capacity: int) -> tuple[list, np.ndarray]:
    """Take groups of lengths that fill a row exactly; what has no such group is returned as counts.

    ``count`` holds how many pieces of each length are available. For the
    longest length left, the gap is looked up among single lengths, then sums
    of two, then sums of three; a group found is taken as often as the counts
    allow, so every step uses up a length or a group.
    """
    groups, rest = [], np.zeros_like(count)

    def pair(total: int, most: int) -> tuple[int, int] | None:
        """The largest length up to ``most``, and its partner, that add up to ``total``."""
        high, low = min(most, total - 1), (total + 1) // 2
        if high < low:
            return None
        large = count[low : high + 1]
        small = count[total - high : total - low + 1][::-1]
        fits = (large > 0) & (small > 0)
        if total % 2 == 0 and fits[0] and large[0] < 2:
            fits[0] = False
        at = np.flatnonzero(fits)
        return (low + int(at[-1]), total - low - int(at[-1])) if len(at) else None

    def complement(gap: int, most: int) -> list[int] | None:
        if gap == 0:
            return []
        if gap <= most and count[gap] > 0:
            return [gap]
        two = pair(gap, most)
        if two:
            return list(two)
        for first in np.flatnonzero(count[: min(most, gap - 2) + 1])[::-1].tolist():
            if 3 * first < gap:
                break
            count[first] -= 1
            two = pair(gap - first, first)
            count[first] += 1
            if two:
                return [first, *two]
        return None

    for length in range(capacity, 0, -1):
        while count[length] > 0:
            count[length] -= 1
            others = complement(capacity - length, length)
            count[length] += 1
            if others is None:
                rest[length], count[length] = count[length], 0
                break
            kinds, copies = np.unique([length, *others], return_counts=True)
            times = int((count[kinds] // copies).min())
            count[kinds] -= times * copies
            groups.append(([(int(k), int(c)) for k, c in zip(kinds[::-1], copies[::-1])], times))
    return groups, rest


def _best_fit(count: np.ndarray, capacity: int) -> list:
    """Best fit by falling length over counts: equal rows are filled together."""
    open_rows: list[list] = [[] for _ in range(capacity + 1)]  # by gap: (items, rows)
    held = np.zeros(capacity + 1, dtype=bool)

    def put(items: list, rows: int, gap: int) -> None:
        if rows:
            open_rows[gap].append((items, rows))
            held[gap] = True

    for length in np.flatnonzero(count)[::-1].tolist():
        left = int(count[length])
        while left:
            gaps = held[length:]
            if gaps.any():
                gap = length + int(gaps.argmax())
                items, rows = open_rows[gap].pop()
                held[gap] = bool(open_rows[gap])
            else:
                gap, items, rows = capacity, [], left  # new rows, as many as are needed
            each = gap // length
            used = min(rows, left // each)
            put([*items, (length, each)], used, gap - each * length)
            left -= used * each
            if used < rows and 0 < left < each:
                put([*items, (length, left)], 1, gap - left * length)
                used, left = used + 1, 0
            if items:
                put(items, rows - used, gap)
    return [group for groups in open_rows for group in groups]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Slots as rows (length, first rank, copies per row, first sequence, offset), sorted by (length, first rank).

    The piece of rank k of a length belongs to the last slot whose first rank
    is at most k.
    """
    count = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        count[length] = n
    groups, rest = _exact(count, capacity)
    slots, ranks, sequence = [], np.zeros(capacity + 1, dtype=np.int64), 0
    for items, rows in [*groups, *_best_fit(rest, capacity)]:
        offset = 0
        for length, copies in items:
            slots.append((length, ranks[length], copies, sequence, offset))
            ranks[length] += copies * rows
            offset += copies * length
        sequence += rows
    table = np.array(slots, dtype=np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def _place(slots: np.ndarray):
    order = slots[:, 0] << 44 | slots[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            slot = slots[np.searchsorted(order, length << 44 | rank, side="right") - 1]
            past = rank - slot[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                    pa.array(slot[:, 3] + past // slot[:, 2], pa.int64()),
                    pa.array(slot[:, 4] + past % slot[:, 2] * length, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to staged ``token_pieces``.

    Pieces are ranked inside (length, digest bucket) and get their bucket's
    offset, so a length that a third of all pieces share is ranked by many
    tasks. The slots are at most a few for each of ``capacity`` lengths,
    whatever the number of pieces.
    """
    marked = pieces.withColumn("bucket", F.pmod(F.xxhash64("part", "row"), F.lit(buckets)).cast("int"))
    sizes = stage(marked.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "length-counts")
    histogram = {r[0]: r[1] for r in sizes.groupBy("length").agg(F.sum("n")).collect()}  # at most ``capacity`` rows
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("part", "row")) - 1
    ranked = marked.withColumn("inside", inside).join(bases, ["length", "bucket"]).withColumn("rank", F.col("inside") + F.col("base"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select(*columns).mapInArrow(_place(plan(histogram, capacity)), schema)


def pack_documents(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenize, cut and pack whole documents: one row per piece with its place.

    Null keys and repeated rows are packed as rows of their own, equal lengths
    in any order; an empty table gives no rows; other columns are ignored,
    whatever their names. Pieces are staged, so ranks do not change when a task
    is repeated.
    """
    return pack(stage(token_pieces(df, tokenizer, key, text, capacity, end_id), "pieces"), capacity)
