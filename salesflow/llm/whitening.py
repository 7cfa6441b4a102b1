"""Whitening with weighted multiplicities: identical vectors are one row that counts as often as it occurs.

Vectors become whole numbers, so sums and the centred matrix products are
exact, whatever the order of tasks, as long as the products of a batch fit
53 bits; beyond that they are made of Python's integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.lookups import lookup
from salesflow.session import stage

#: Steps of a unit and the offset that makes entries positive.
SCALE, OFFSET = 64, 1_000_000
#: Components of a vector at most; those with less than this part of the largest eigenvalue cannot be told from rounding.
COMPONENTS, LEAST = 32, 1e-10
#: Entries from this size on do not fit a long once scaled.
TOO_LARGE = float(1 << 56)
#: Distinct vectors multiplied at once.
ROWS = 8192

_EXACT = pa.decimal128(38, 0)
Batches = Iterator[pa.RecordBatch]


def usable(vector: Column) -> Column:
    """Not null, not empty, and all entries finite and small enough to be scaled."""
    return F.coalesce(
        (F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < TOO_LARGE), F.lit(False))),
        F.lit(False),
    )


def scaled(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(OFFSET).cast("long"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _parts(batches: Batches, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield _matrix(part.column("x"), width), part.column("weight").to_numpy(), part


def _product(left: np.ndarray, weight: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The weighted product of whole numbers, as Python's integers."""
    most = max(int(np.abs(left).max()), 1) * max(int(np.abs(right).max()), 1) * sum(map(int, weight))
    if most < 1 << 53:
        return ((left.T * weight.astype(float)) @ right.astype(float)).astype(np.int64).astype(object)
    return (left.astype(object).T * weight.astype(object)) @ right.astype(object)


def _sums(width: int) -> Callable[[Batches], Batches]:
    def summed(batches: Batches) -> Batches:
        total = np.zeros(width, dtype=object)
        for x, weight, _ in _parts(batches, width):
            total = total + _product(np.ones((len(x), 1), dtype=np.int64), weight, x - OFFSET)[0]
        yield pa.RecordBatch.from_arrays([pa.array([[Decimal(int(v)) for v in total]], pa.list_(_EXACT))], names=["parts"])

    return summed


def _products(width: int, centre: list[int]) -> Callable[[Batches], Batches]:
    """The weighted sums of products of centred entries, the upper triangle row by row."""

    def multiplied(batches: Batches) -> Batches:
        total, upper = np.zeros((width, width), dtype=object), np.triu_indices(width)
        for x, weight, _ in _parts(batches, width):
            z = x - np.array(centre, dtype=np.int64)
            total = total + _product(z, weight, z)
        yield pa.RecordBatch.from_arrays([pa.array([[Decimal(int(v)) for v in total[upper]]], pa.list_(_EXACT))], names=["parts"])

    return multiplied


def _whitened(width: int, count: int, sums: list[int], axes: np.ndarray) -> Callable[[Batches], Batches]:
    """Add each vector's deviation and its coordinates on the scaled components."""
    centre = [round(s / count) for s in sums]
    rest = [s - count * c for s, c in zip(sums, centre)]  # at most half of ``count``, so the double below is as good as exact

    def projected(batches: Batches) -> Batches:
        shift, own = np.array(rest, dtype=object), np.array(rest, dtype=float) / count
        for x, weight, part in _parts(batches, width):
            z = x - np.array(centre, dtype=np.int64)
            far = (count * int(np.abs(z).max()) + max(abs(r) for r in rest)) ** 2 * width
            if far < 1 << 63:
                spread = ((count * z - np.array(rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
            else:
                spread = ((count * z.astype(object) - shift) ** 2).sum(axis=1).tolist()
            coordinates = (z - own) @ axes
            flat = pa.array(coordinates.ravel(), pa.float64())
            offsets = pa.array(np.arange(0, coordinates.size + 1, axes.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("x"), part.column("copies"), part.column("weight"), pa.array(map(Decimal, map(int, spread)), _EXACT), pa.ListArray.from_arrays(offsets, flat)],
                names=["x", "copies", "weight", "deviation", "whitened"],
            )

    return projected


def _spread(width: int, mean: list[float]) -> Callable[[Batches], Batches]:
    """The weighted sums of products of centred coordinates."""

    def multiplied(batches: Batches) -> Batches:
        total = np.zeros((width, width))
        for batch in batches:
            z = _matrix(batch.column("whitened"), width) - np.array(mean)
            total += (z.T * batch.column("weight").to_numpy().astype(float)) @ z
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["parts"])

    return multiplied


def _added(partials: DataFrame) -> list:
    """One array per task, added place by place; the driver gets as many numbers as one array has."""
    places = partials.select(F.posexplode("parts").alias("at", "part")).groupBy("at").agg(F.sum("part").alias("part"))
    return [row["part"] for row in sorted(places.collect(), key=lambda row: row["at"])]


def _components(products: list[int], rest: list[int], count: int, width: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Scaled axes and shares of the variance, by falling eigenvalue; the covariance is rounded once, entry by entry."""
    covariance = np.zeros((width, width))
    for i, j, c in zip(*np.triu_indices(width), products):
        covariance[i, j] = covariance[j, i] = (count * c - rest[i] * rest[j]) / (count * count)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = np.flatnonzero(values > max(values[0] * LEAST, 0.0))[:most]
    return vectors[:, kept] / np.sqrt(values[kept]), values[kept] / max(np.trace(covariance), np.finfo(float).tiny)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", weights: str = "counts", most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every usable row and component.

    An entry c becomes x = floor(64 c) + 1000000. The fit list holds each
    distinct x as often as it occurs (``weights`` "counts") or once ("one");
    n is its length, S its sum, and covariances have n as divisor.
    ``component`` counts from 1 by falling eigenvalue; ``deviation`` is the
    sum over dimensions of (n x - S)^2, exact (an error beyond 38 digits);
    ``whitened`` is x - S / n on the component over the root of its
    eigenvalue; ``explained`` is the eigenvalue's share; ``identity_error``,
    the same in all rows, is the largest absolute entry of the covariance of
    ``whitened`` minus the identity.

    Rows whose vector is null, empty, or has an entry that is null, not
    finite or of 2^56 and more take no part, nor do vectors of another length
    than the most frequent (the longest of those equally frequent). A null key
    stays null; rows that repeat are rows each. Components without variance,
    below 1e-10 of the largest eigenvalue, cannot be whitened and have no
    rows; so a table of equal vectors, or an empty one, gives none. Other
    columns are ignored, whatever their names.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"weights are counts or one, not {weights}")
    spark = df.sparkSession
    of = F.col(vector)
    rows = df.where(usable(of)).select(F.col(key).cast("long").alias("vec_id"), scaled(of).alias("x"))
    rows = stage(rows.withColumn("digest", F.xxhash64("x")), "scaled")
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    width = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if width is None:
        return spark.createDataFrame([], schema)
    width, total = width["length"], width["n"]
    rows = rows.where(F.size("x") == width)
    copies = F.count(F.lit(1))
    distinct = stage(rows.groupBy("x").agg(copies.alias("copies")).withColumn("weight", F.col("copies") if weights == "counts" else F.lit(1).cast("long")), "distinct")

    n = int(distinct.agg(F.sum("weight")).first()[0])
    sums = [int(v) + n * OFFSET for v in _added(distinct.mapInArrow(_sums(width), "parts array<decimal(38,0)>"))]
    centre = [round(s / n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    products = [int(v) for v in _added(distinct.mapInArrow(_products(width, centre), "parts array<decimal(38,0)>"))]
    axes, shares = _components(products, rest, n, width, most)
    found = len(shares)
    if not found:
        return spark.createDataFrame([], schema)

    once = "x array<long>, copies long, weight long, deviation decimal(38,0), whitened array<double>"
    whitened = stage(distinct.mapInArrow(_whitened(width, n, sums, axes), once).withColumn("digest", F.xxhash64("x")), "whitened")
    mean = whitened.select("weight", F.posexplode("whitened").alias("at", "w")).groupBy("at").agg((F.sum(F.col("w") * F.col("weight")) / n).alias("mean"))
    mean = [row["mean"] for row in sorted(mean.collect(), key=lambda row: row["at"])]
    spread = np.array(_added(whitened.mapInArrow(_spread(found, mean), "parts array<double>"))).reshape(found, found) / n
    error = float(np.abs(spread - np.eye(found)).max())

    each = lookup(rows, whitened.drop("weight"), ["digest", "x"], "copies", total)
    each = each.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.element_at(F.lit(shares.tolist()), F.col("at") + 1)
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
