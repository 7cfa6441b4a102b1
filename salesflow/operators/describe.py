"""Summary statistics with exact, interpolated quartiles, computed without gathering a column anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.operators.ordered import running_total

QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value) rows; missing values are left out, as they count for nothing."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns
    ]
    return df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull() & ~F.isnan("value"))


def _at_rank(rank: Column) -> Column:
    """The value whose run of equal copies covers the 0-based ``rank``."""
    return F.max(F.when((F.col("start") <= rank) & (rank < F.col("end")), F.col("value")))


def describe(df: DataFrame, columns: list[str], partitions: int | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column as (column_name, statistic, value) rows.

    Equal values are first combined to (value, copies), so a value that
    holds most rows is one row; a running total of the copies over the
    sorted values then places every value in the ranking, and each quartile
    is read off at its two neighbouring ranks. Built-in ``percentile``
    would hold all distinct values of a column in one task instead. The
    input is computed once: everything after the copies reads their table.
    """
    copies = _long(df, columns).groupBy("column_name", "value").agg(F.count("*").alias("copies"))
    ranked = running_total(copies, ["column_name", "value"], F.col("copies"), "reached", partitions)

    # One row per described column, so the window and the broadcast are bounded.
    sizes = ranked.groupBy("column_name").agg(
        F.sum("copies").alias("count"),
        (F.sum(F.col("value") * F.col("copies")) / F.sum("copies")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    before = Window.orderBy("column_name").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0)))

    end = (F.col("reached") - F.col("base")).cast("bigint")
    placed = (
        ranked.join(F.broadcast(base), "column_name")
        .withColumn("end", end)
        .withColumn("start", F.col("end") - F.col("copies"))
    )
    picked = [F.sum(F.col("copies") * F.pow(F.col("value") - F.col("mean"), 2)).alias("spread")]
    for label, share in QUARTILES.items():
        position = (F.col("count") - 1) * F.lit(share)
        picked.append(_at_rank(F.floor(position)).alias(f"{label} low"))
        picked.append(_at_rank(F.ceil(position)).alias(f"{label} high"))
    found = placed.groupBy("column_name", "count", "mean", "min", "max").agg(*picked)

    def quartile(label: str, share: float) -> Column:
        position = (F.col("count") - 1) * F.lit(share)
        low, high = F.col(f"`{label} low`"), F.col(f"`{label} high`")
        return low + (high - low) * (position - F.floor(position))

    statistics = {
        "count": F.col("count").cast("double"),
        "mean": F.col("mean"),
        "std": F.when(F.col("count") > 1, F.sqrt(F.col("spread") / (F.col("count") - 1))),
        "min": F.col("min"),
        **{label: quartile(label, share) for label, share in QUARTILES.items()},
        "max": F.col("max"),
    }
    rows = [F.struct(F.lit(k).alias("statistic"), v.alias("value")) for k, v in statistics.items()]
    # a column without any value has a count of zero and nothing else
    named = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    whole = named.join(found, "column_name", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    return whole.select("column_name", F.inline(F.array(*rows)))
