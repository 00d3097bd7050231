"""Facts with the version valid at their own time, against a search in sorted lists."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators.changes import at_own_time

START = datetime(2024, 1, 1)
LOG = "k string, v string, change_ts timestamp_ntz, seq int"
FACTS = "id int, k string, t timestamp_ntz"


def own_time(spark, facts, log, **options):
    rows = at_own_time(spark.createDataFrame(facts, FACTS), spark.createDataFrame(log, LOG), "k", "t", tie_break=["seq"], **options)
    return sorted((r.id, r.version.v if r.version else None) for r in rows.collect())


def plain(facts, log):
    found = []
    for i, k, t in facts:
        known = [(ts, seq, v) for key, v, ts, seq in log if key is not None and key == k and ts and t and ts <= t]
        found.append((i, max(known)[2] if known else None))
    return sorted(found, key=lambda r: r[0])


@pytest.mark.parametrize("cell", [timedelta(minutes=1), timedelta(hours=1), timedelta(days=2)])
def test_against_a_plain_search(spark, cell):
    rng = random.Random(7)

    def moment():
        return START + timedelta(seconds=rng.choice([rng.randrange(300), rng.randrange(0, 20) * 3600, rng.randrange(400000)]))

    log = [(f"k{rng.randrange(4)}", f"v{n}", moment(), n) for n in range(120)]
    facts = [(n, f"k{rng.randrange(6)}", moment()) for n in range(400)]
    assert own_time(spark, facts, log, cell=cell) == plain(facts, log)


def test_nulls_ties_and_bounds(spark):
    second = timedelta(seconds=1)
    log = [("a", "old", START, 1), ("a", "new", START, 2), ("a", None, START + second, 3), (None, "x", START, 1), ("a", "y", None, 9)]
    facts = [(1, "a", START), (2, "a", START - second), (3, None, START), (4, "a", None), (5, "b", START), (6, "a", START)]
    assert own_time(spark, facts, log) == [(1, "new"), (2, None), (3, None), (4, None), (5, None), (6, "new")]
    late = at_own_time(spark.createDataFrame([(1, "a", START + timedelta(days=9))], FACTS), spark.createDataFrame(log, LOG), "k", "t",
                       tie_break=["seq"]).first()
    assert late.version.seq == 3 and late.version.v is None  # a version with a NULL is still the last one


def test_empty_tables(spark):
    none = spark.createDataFrame([], LOG)
    assert own_time(spark, [(1, "a", START)], []) == [(1, None)]
    assert at_own_time(spark.createDataFrame([], FACTS), none, "k", "t").count() == 0


def test_no_window_orders_a_key(spark):
    """Windows go over cells of a key, or over the versions inside one cell; facts are in none."""
    facts, log = spark.createDataFrame([(1, "a", START)], FACTS), spark.createDataFrame([("a", "v", START, 1)], LOG)
    plan = at_own_time(facts, log, "k", "t")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and all("fact#" not in line for line in windows)
    assert all("_cell#" in line for line in windows)


def test_a_hot_key(spark):
    """A key with nearly all facts, spread over cells by their times."""
    facts = spark.range(60000).selectExpr(
        "CAST(id AS INT) AS id", "IF(id % 20 = 0, 'k' || id % 7, 'hot') AS k",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 7) AS t")
    log = spark.range(3000).selectExpr(
        "'hot' AS k", "CAST(id AS STRING) AS v", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 140) AS change_ts",
        "CAST(id AS INT) AS seq")
    rows = at_own_time(facts, log, "k", "t", tie_break=["seq"])
    assert rows.count() == 60000
    assert rows.where("k = 'hot' AND version.seq <> id DIV 20").count() == 0
    assert rows.where("k <> 'hot' AND version IS NOT NULL").count() == 0
