"""Operators that need a total order: running totals, row numbers, blocks, last rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.session import stage

_PART = "_part"


def _running_sums(count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replace the last ``count`` columns, 64-bit, by their running sums along the task's rows, as decimals of 38 digits.

    Each number is summed as two limbs: its lower 32 bits and the rest. The
    sums of a batch's limbs cannot leave 64 bits, and what came before the
    batch is a whole number of any size, so nothing overflows before 38 digits.
    The function is local so that it travels with the job: executors need
    Arrow and numpy, not this package.
    """

    def summed(column: pa.Array, before: int) -> tuple[pa.Array, int]:
        import numpy as np

        values = column.to_numpy(zero_copy_only=False).astype(np.int64)
        low = np.cumsum(values & 0xFFFFFFFF) + (before & 0xFFFFFFFF)
        high = np.cumsum(values >> 32) + (low >> 32) + ((before >> 32) & 0xFFFFFFFF)
        top = (high >> 32) + (before >> 64)
        limbs = np.empty((len(values), 2), dtype=np.int64)  # two's complement of 128 bits, lower half first
        limbs[:, 0] = (high << 32) | (low & 0xFFFFFFFF)
        limbs[:, 1] = top
        total = (int(top[-1]) << 64) + ((int(high[-1]) & 0xFFFFFFFF) << 32) + (int(low[-1]) & 0xFFFFFFFF)
        if abs(total) >= 10**38:
            raise OverflowError("a running sum has more than 38 digits")
        return pa.Array.from_buffers(pa.decimal128(38, 0), len(values), [None, pa.py_buffer(limbs)]), total

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = [0] * count
        for batch in batches:
            if batch.num_rows:
                running = []
                for place, column in enumerate(batch.columns[-count:]):
                    array, carried[place] = summed(column, carried[place])
                    running.append(array)
                names = batch.schema.names
                yield pa.RecordBatch.from_arrays([*batch.columns[:-count], *running], names=names)

    return along


def running_total(
    df: DataFrame,
    order: list[str],
    step: Column,
    name: str,
    partitions: int | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``name``: the sum of the whole-number ``step`` over all rows up to this one."""
    return running_totals(df, order, {name: step}, partitions, keep)


def running_totals(
    df: DataFrame, order: list[str], steps: dict[str, Column], partitions: int | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Add for each of ``steps`` the sum of the whole number over all rows up to this one.

    An un-partitioned window would sort the whole input in one task. Here
    the rows are range-partitioned on the full order, summed along each
    partition, and written; what is left is one total per partition, whose
    running sum (a row per partition, so a bounded broadcast) is added to
    the rows. One shuffle. The order must be total, which also keeps the
    partitions even when a leading key holds most rows; where keys repeat,
    end the order with the arrival columns. Without ``partitions`` their
    number is the session's, lowered by adaptive execution on small inputs.
    ``keep`` names the columns the result needs, so that the others, such as
    the order itself, are not written.
    """
    own = [f"_step_{i}" for i in range(len(steps))]
    local_names, before_names = [f"{c}_local" for c in own], [f"{c}_before" for c in own]
    keyed = df.withColumns({c: F.coalesce(s.cast("bigint"), F.lit(0)) for c, s in zip(own, steps.values())})
    columns = [F.col(c) for c in order]
    ranged = keyed.repartitionByRange(partitions, *columns) if partitions else keyed.repartitionByRange(*columns)
    kept = [F.col(f"`{c}`") for c in keep or df.columns]
    part, copies = F.spark_partition_id().alias(_PART), [F.col(c).alias(n) for c, n in zip(own, local_names)]
    source = ranged.sortWithinPartitions(*columns).select(*kept, *own, part, *copies)
    wide = set(local_names)
    kinds = [(f.name, T.DecimalType(38, 0) if f.name in wide else f.dataType) for f in source.schema.fields]
    schema = T.StructType([T.StructField(name, kind, True) for name, kind in kinds])
    local = stage(source.mapInArrow(_running_sums(len(own)), schema), "running")

    # One row per partition, so the un-partitioned window and the broadcast
    # are bounded. Decimals: the totals may exceed 64 bits together.
    totals = local.groupBy(_PART).agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in own])
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast("decimal(38,0)").alias(n) for c, n in zip(own, before_names)]
    joined = local.join(F.broadcast(totals.select(_PART, *before)), _PART)
    added = {
        name: (F.col(n) + F.col(b)).cast("decimal(38,0)")
        for name, n, b in zip(steps, local_names, before_names)
    }
    return joined.withColumns(added).drop(_PART, *own, *local_names, *before_names)


def number_rows(df: DataFrame, order: list[str], name: str = "row_number", **options) -> DataFrame:
    """Number all rows from 1 in the given order."""
    return running_total(df, order, F.lit(1), name, **options).withColumn(name, F.col(name).cast("bigint"))


def blocks_of(df: DataFrame, order: list[str], size: int = 50, name: str = "batch", **options) -> DataFrame:
    """Assign each row to a block of ``size`` consecutive rows, counted from 0."""
    numbered = number_rows(df, order, "_number", **options)
    return numbered.withColumn(name, F.expr(f"(_number - 1) div {int(size)}")).drop("_number")


def first_rows(df: DataFrame, order: list[str], count: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(count)


def last_rows(df: DataFrame, order: list[str], count: int = 50) -> DataFrame:
    """The last rows in the given order; each task keeps at most ``count`` candidates."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(count)


def cumulative_error(
    errors: DataFrame, order: list[str], error: str = "error", name: str = "cumulative_error", keep: list[str] | None = None, **options
) -> DataFrame:
    """Running sum of an error column; a missing error adds nothing and has no sum of its own.

    Errors are added exactly to 12 decimal places, whole and fractional parts
    apart, so neither small nor large ones are lost and the result does not
    depend on how the rows are spread.
    """
    value = F.col(error)
    present = value.isNotNull() if dict(errors.dtypes)[error].startswith("decimal") else value.isNotNull() & ~F.isnan(value)
    exact = F.when(present, value.cast("decimal(38,12)"))
    whole = F.floor(exact)
    steps = {"_whole": whole, "_rest": (exact - whole) * F.lit(10**12)}
    summed = running_totals(errors.withColumn("_present", present), order, steps, keep=[*(keep or errors.columns), "_present"], **options)
    unit = f"{10**12}BD"
    carried = F.col("_whole").cast("decimal(24,0)") + F.expr(f"_rest div {unit}")  # no fraction is negative
    fraction = (F.expr(f"_rest % {unit}").cast("decimal(13,0)") / F.lit(10**12).cast("decimal(13,0)")).cast("decimal(13,12)")
    total = (carried.cast("decimal(24,0)") + fraction).cast("double")
    return summed.withColumn(name, F.when(F.col("_present"), total)).drop("_present", *steps)
