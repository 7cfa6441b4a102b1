"""Lookups by a key that may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this part of all rows is heavy; fewer keys than this can be.
HEAVY = 1000


def lookup(rows: DataFrame, table: DataFrame, on: list[str], weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to ``table``, which holds each key once and in ``weight`` how many of the ``total`` rows have it.

    Rows of heavy keys meet their one row of ``table`` where they are: less
    than ``HEAVY`` keys can be heavy, so that side is broadcast. The rest is
    joined by a shuffle in which no key has more than a ``HEAVY``-th of the
    rows. Both inputs are read twice and should be written tables.
    """
    heavy = F.col(weight) * HEAVY > total
    few = table.where(heavy)
    light = rows.join(F.broadcast(few.select(*on)), on, "left_anti").join(table.where(~heavy), on)
    return rows.join(F.broadcast(few), on).unionByName(light)
