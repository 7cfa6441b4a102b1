"""Every registered query with a SQL counterpart returns exactly the rows the SQL returns."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import mismatch

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf, name):
    assert mismatch(QUERIES[name], ORACLES[name], spark, sf) is None


@pytest.mark.parametrize("name", ["score_batch", "score_stream"])
def test_scored_rows(spark, sf, name):
    scored = QUERIES[name](spark, sf)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    total, prediction = (c for c in scored.columns if c.lower() in ("total", "prediction"))
    assert len(scored.columns) == 4
    assert scored.count() == lines
    assert scored.where(f"abs(`{total}` - `{prediction}`) >= 0.05").isEmpty()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
