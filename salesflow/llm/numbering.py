"""Consecutive integers for distinct rows, without a task that sees all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.session import stage

#: Ranges a numbering is split into; each is ordered by its own task.
BUCKETS = 4096


def number(distinct: DataFrame, columns: list[str], name: str = "name", buckets: int = BUCKETS) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... in the order of (digest bucket, ``columns``).

    The rows must be distinct on ``columns``. The numbers depend on the set of
    rows alone, so a repeated task gives the same ones. The input is staged
    once; the only unpartitioned window sees one row per bucket.
    """
    staged = stage(distinct.withColumn("_bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets))), "numbering")
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*columns))
    return (
        staged.withColumn("_inside", inside)
        .join(offsets, "_bucket")
        .withColumn(name, F.col("_inside") + F.col("_base"))
        .drop("_bucket", "_inside", "_base")
    )
