"""Exact top-k by inner product as a Voronoi join: pivots, bounds from summaries, local solving."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.numbering import number
from salesflow.session import stage

#: Fewest and most cells; between them there are as many as the root of the distinct vectors. Each has a pivot, a
#: vector chosen by digest. Their number decides how much work is saved, not what is found.
FEWEST, MOST = 32, 1024
#: Most vectors, and most queries, that one task holds.
BLOCK_ROWS = 8192
#: Small cells share a bin until it holds this part of all vectors, or a block of them; bins are what queries are sent to.
BINS = 64
#: Numbers in a table of vectors by pivots or queries by cells that is held at once, and rows handed on at once.
TABLE, AT_ONCE = 1 << 19, 8192


def quantised(vector: Column, scale: int = 64) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def finite(vector: Column) -> Column:
    """No component is missing, NaN or infinite, and there is a vector at all."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == math.inf))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, vector in enumerate(vectors):
        out[row, : len(vector)] = vector
    return out


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products: doubles while every partial sum fits one, else whole numbers; past 64 bits the nearest 64-bit number."""
    reach = np.abs(left.astype(np.float64)).max(initial=0) * np.abs(right.astype(np.float64)).max(initial=0) * max(left.shape[1], 1)
    if reach < 2**52:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if reach < 2**62:
        return left @ right.T
    return np.clip(left.astype(object) @ right.astype(object).T, -(2**63), 2**63 - 1).astype(np.int64)


def _slices(frames: Iterator[pd.DataFrame], columns: int) -> Iterator[pd.DataFrame]:
    """The frames in pieces whose table of so many columns has about ``TABLE`` numbers."""
    rows = max(TABLE // max(columns, 1), 1)
    for frame in frames:
        for start in range(0, len(frame), rows):
            yield frame.iloc[start : start + rows]


def _bins(pivots: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """For each cell the bin it goes to: cells that lie side by side, until they hold ``most`` vectors; a larger cell is alone.

    Cells are walked through from each pivot to the nearest one not yet taken,
    so that a query which asks for a cell asks for the others of its bin too.
    """
    out, left = np.zeros(len(pivots), dtype=np.int64), np.ones(len(pivots), dtype=bool)
    squares = (pivots**2).sum(axis=1)
    at, bin_, held = 0, 0, 0
    for _ in range(len(pivots)):
        left[at] = False
        if held and held + counts[at] > most:
            bin_, held = bin_ + 1, 0
        out[at], held = bin_, held + counts[at]
        at = int(np.where(left, squares - 2 * pivots @ pivots[at], np.inf).argmin())
    return out


def _nearest(pivots: np.ndarray):
    """(cell, distance to its pivot, norm) of every vector."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squares = (pivots**2).sum(axis=1)
        for frame in _slices(frames, len(pivots)):
            points = _matrix(frame["vector"], pivots.shape[1]).astype(np.float64)
            norms = (points**2).sum(axis=1)
            away = np.maximum(norms[:, None] - 2 * points @ pivots.T + squares, 0)
            cell = away.argmin(axis=1)
            yield frame.assign(
                cell=cell.astype(np.int32), far=np.sqrt(away[np.arange(len(frame)), cell]), norm=np.sqrt(norms)
            )

    return run


def _needed(pivots: np.ndarray, cells: pd.DataFrame, spread: np.ndarray, k: int):
    """For each query the chunks of the bins with cells that may hold one of its k best.

    A cell with pivot p, radius r and largest norm m, seen from a query q of a
    group with pivot g and spread s, scores within p.q -+ |q| r, and within
    p.g -+ (|g| r + s m) for the whole group. Cells taken by falling lower
    bound until they hold k vectors give a score that the k best reach; a cell
    whose upper bound is below it has no part in the result. A query is sent
    once to a bin, however many of its cells it asks for, and rows are handed
    on a few at a time: what a task holds does not grow with cells or queries.
    """
    cells = cells.sort_values("bin", kind="stable")
    first = np.flatnonzero(np.diff(cells["bin"].to_numpy(), prepend=-1))
    bins, chunks = cells["bin"].to_numpy()[first], cells["chunks"].to_numpy()[first]
    index = cells["cell"].to_numpy()
    centre, radius, norm = pivots[index], cells["radius"].to_numpy(), cells["norm"].to_numpy()
    counts = cells["ids"].to_numpy()
    slack = 1e-6 * (1 + np.abs(pivots).max(initial=0)) ** 2 * (1 + pivots.shape[1])

    def reached(low: np.ndarray) -> np.ndarray:
        order = np.argsort(-low, axis=1, kind="stable")
        held = np.cumsum(counts[order], axis=1)
        at = np.minimum((held < k).sum(axis=1), low.shape[1] - 1)
        rows = np.arange(len(low))
        return np.where(held[:, -1] >= k, low[rows, order[rows, at]], -np.inf)

    group = pivots @ centre.T
    width = np.sqrt((pivots**2).sum(axis=1))[:, None] * radius + spread[:, None] * norm
    group_floor, group_top = reached(group - width), group + width

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _slices(frames, max(len(index), int(chunks.sum()))):
            points = _matrix(frame["vector"], pivots.shape[1]).astype(np.float64)
            middle, reach = points @ centre.T, frame["norm"].to_numpy()[:, None] * radius
            home = frame["cell"].to_numpy()
            floor = np.maximum(reached(middle - reach), group_floor[home])[:, None] - slack
            wanted = (middle + reach >= floor) & (group_top[home] >= floor)
            row, at = np.nonzero(np.logical_or.reduceat(wanted, first, axis=1))
            times = chunks[at]
            chunk = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, at = np.repeat(row, times), np.repeat(at, times)
            for start in range(0, len(row), AT_ONCE):
                some = slice(start, start + AT_ONCE)
                yield pd.DataFrame(
                    {
                        "cell": bins[at[some]].astype(np.int32),
                        "chunk": chunk[some].astype(np.int32),
                        "part": frame["part"].to_numpy()[row[some]],
                        "vid": frame["vid"].to_numpy()[row[some]],
                        "vector": frame["vector"].to_numpy()[row[some]],
                    }
                )

    return run


def _solve(width: int, k: int):
    """The k best (score, id) of every query among the vectors of one block."""

    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        vids, ids, scores = [], [], []
        if len(queries) and len(block):
            least = np.array([x[0] for x in block["ids"]])
            data = _matrix(block["vector"], width)
            lists = block["ids"].to_numpy()
            for part in _slices([queries], len(block)):
                table = _products(_matrix(part["vector"], width), data)
                bar = np.partition(table, -k, axis=1)[:, -k] if table.shape[1] > k else table.min(axis=1)
                for vid, row, least_score in zip(part["vid"], table, bar):
                    take = np.flatnonzero(row >= least_score)
                    take = take[np.lexsort((least[take], -row[take]))][:k]
                    pairs = sorted((-int(row[i]), int(x)) for i in take for x in lists[i])[:k]
                    vids += [vid] * len(pairs)
                    scores += [-s for s, _ in pairs]
                    ids += [x for _, x in pairs]
        return pd.DataFrame({"vid": vids, "vec_id": ids, "score": scores}, dtype="int64")

    return run


def needed_blocks(placed: DataFrame, asked: DataFrame, chunks: Column) -> DataFrame:
    """The vectors of ``placed`` dealt into ``chunks`` blocks of their cell, once for each part that ``asked`` for the block."""
    block = F.pmod(F.xxhash64("vid", F.lit(7)), chunks).cast("int").alias("chunk")
    return placed.select("cell", block, "vector", "ids").join(asked, ["cell", "chunk"])


def top_k(
    df: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    scale: int = 64,
    pivots: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` largest integer inner products.

    Components are floor(scale * x). Queries are the rows for which
    ``is_query``, a condition on ``key``, holds; candidates are all rows but
    those with the query's own key. Ties go to the smaller key.

    Distinct vectors get a number and at most k + 1 of their keys (no query can
    return more of them), so a vector that fills a third of the table is one
    candidate. Only ``pivots`` vectors (by default as many as the root of the
    distinct vectors, ``FEWEST`` to ``MOST``) and one summary row per cell pass
    through the driver. Tasks hold at most about ``block_rows`` vectors and as
    many queries. Small cells that lie side by side share a bin. A query goes to
    the bins with a cell its bounds ask for, and a block of a bin only to the
    parts of the queries that asked for it.

    Rows without a key, without a vector, or with a missing, NaN or infinite
    component take no part. A shorter vector counts as filled up with zeros.
    Repeated rows count once. No query or no other row: no rows. Other columns
    are ignored, whatever their names.
    """
    rows = df.where(finite(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), is_query.alias("asks"), quantised(F.col(vector), scale).alias("vector")
    )
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    listed = (
        rows.dropDuplicates(["vec_id", "vector"])
        .withColumn("nth", F.row_number().over(by_vector))
        .where(F.col("nth") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    points = stage(number(listed, ["vector"], "vid"), "vectors")
    asked = stage(
        rows.where("asks").select("vec_id", "vector").distinct().join(points.select("vector", "vid"), "vector").select("vec_id", "vid"),
        "queries",
    )
    if pivots is None:
        pivots = min(max(math.isqrt(points.count()), FEWEST), MOST)
    chosen = points.orderBy(F.xxhash64("vector"), "vid").limit(pivots).select("vector").collect()
    widest = points.agg(F.max(F.size("vector"))).first()[0] or 0
    centres = _matrix(pd.Series([r[0] for r in chosen], dtype=object), widest).astype(np.float64)

    schema = "vid long, vector array<long>, ids array<long>"
    placed = stage(
        points.select("vid", "vector", "ids").mapInPandas(_nearest(centres), f"{schema}, cell int, far double, norm double"),
        "cells",
    )
    cells = (
        placed.groupBy("cell")
        .agg(F.max("far").alias("radius"), F.max("norm").alias("norm"), F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("ids"))
        .toPandas()
    )
    held_by = np.zeros(len(centres), dtype=np.int64)
    held_by[cells["cell"]] = cells["n"]
    bins = _bins(centres, held_by, min(block_rows, -(-int(held_by.sum()) // BINS)))
    cells["bin"] = bins[cells["cell"]]
    cells["chunks"] = np.ceil(cells.groupby("bin")["n"].transform("sum") / block_rows).astype(int)
    queries = placed.join(asked.select("vid").distinct(), "vid", "left_semi")
    spread = np.zeros(max(len(centres), 1))
    n_queries = 0
    for row in queries.groupBy("cell").agg(F.max("far"), F.count(F.lit(1))).collect():  # one row per cell
        spread[row[0]], n_queries = row[1], n_queries + row[2]
    parts = max(1, math.ceil(n_queries / block_rows))
    mark = F.pmod(F.xxhash64("vid"), F.lit(parts)).cast("int")
    found_schema = "vid long, vec_id long, score long"
    if not len(cells) or not n_queries:
        found = df.sparkSession.createDataFrame([], found_schema)
    else:
        asking = queries.select("vid", "vector", "cell", "norm", mark.alias("part")).mapInPandas(
            _needed(centres, cells, spread, k + 1), "cell int, chunk int, part int, vid long, vector array<long>"
        )
        sent = stage(asking, "asked-cells")
        by_bin = cells.groupby("bin")["chunks"].max().reindex(range(int(bins.max()) + 1), fill_value=1)
        chunk_count = F.element_at(F.lit(by_bin.tolist()), F.col("cell") + 1)
        at = ["cell", "chunk", "part"]
        dealt = placed.withColumn("cell", F.element_at(F.lit(bins.tolist()), F.col("cell") + 1).cast("int"))
        held = needed_blocks(dealt, sent.select(*[F.col(c).alias(c) for c in at]).distinct(), chunk_count)
        found = sent.groupBy(*at).cogroup(held.groupBy(*at)).applyInPandas(_solve(widest, k + 1), found_schema)
    best = Window.partitionBy("vid").orderBy(F.desc("score"), "vec_id")
    short = stage(found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth"), "nearest")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        asked.withColumnRenamed("vec_id", "query_id")
        .join(short, "vid")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
