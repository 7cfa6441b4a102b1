"""Run registered queries beside their SQL counterparts and compare whole results."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple], list[str]]:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir, f"{name}.parquet")
        if path.exists():
            files = f"{path}/*.parquet" if path.is_dir() else path
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    relation = connection.execute(sql)
    columns = [d[0] for d in relation.description]
    return columns, relation.fetchall(), [str(d[1]) for d in relation.description]


def normal(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def mismatch(query, sql: str, spark, sf_dir: str) -> str | None:
    """None if the result has the same columns and the same rows as the SQL, else what differs."""
    df = query(spark, sf_dir)
    columns, expected, _ = oracle_rows(sql, sf_dir)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    mine, theirs = normal(df.columns, df.collect()), normal(columns, expected)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(different)} rows differ, first {different[0]}" if different else None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries

    from salesflow.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    session = build_session(master="local[8]", spark_sql_shuffle_partitions="8")
    session.sparkContext.setLogLevel("ERROR")
    oracles = oracle_sql()
    bad = 0
    for key, run in queries().items():
        if only and key not in only:
            continue
        started = time.time()
        try:
            problem = mismatch(run, oracles[key], session, sf) if key in oracles else f"no SQL, {run(session, sf).count()} rows"
        except Exception as error:  # keep going: one report for all queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None and not problem.startswith("no SQL")
        print(f"{key:32s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print("failed:", bad)
