"""Run every query on Spark and on DuckDB and compare the rows: ``python tests/compare_with_sql.py [sf] [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as suite  # noqa: E402
from tidemark.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents pages embeddings".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(spark, db, name: str, sf_dir: str) -> str | None:
    """None when the query and its SQL agree, else what differs."""
    result = suite.queries()[name](spark, sf_dir)
    mine = rows_of(result.columns, result.collect())
    cursor = db.execute(suite.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(columns)}"
    theirs = rows_of(columns, cursor.fetchall())
    if mine == theirs and [list(map(type, r)) for r in mine] == [list(map(type, r)) for r in theirs]:
        return None
    odd = [pair for pair in zip(mine, theirs) if pair[0] != pair[1]][:2]
    return f"{len(mine)} rows against {len(theirs)}: {sorted(columns)} {odd}"


def main() -> int:
    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = build_session(master="local[8]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(sf_dir), 0
    for name in sys.argv[2:] or suite.oracle_sql():
        started = time.time()
        try:
            problem = difference(spark, db, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
