"""Distinct counts from rollups with sketches."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.plans import metrics

CUBE = "session_metrics"


def sessions(spark, rows, ids):
    return spark.range(rows).selectExpr(
        f"IF(id % 50 = 0, NULL, 's' || (id * 7919 % {ids})) AS session_id", "'u' AS user_id", "id % 3 = 0 AS converted",
        "date_add(DATE'2024-01-01', CAST(id % 60 AS INT)) AS session_date", "10 AS session_duration_seconds",
        "1 AS page_views", "0 AS add_to_carts", "0 AS purchases")


@pytest.mark.parametrize("ids", [50, 4001, 150001])
def test_estimates_of_merged_sketches_keep_the_bound(spark, ids):
    table = sessions(spark, 300000, ids)
    daily = metrics.pre_aggregate(table, CUBE, ["session_date", "converted"], "day", sketches=True)
    for dimensions, grain in ((["session_date"], "month"), (["converted"], None), ([], None)):
        exact = metrics.query(table, CUBE, ["total_sessions", "count"], dimensions, grain=grain)
        near = metrics.query_rollup(daily, CUBE, ["total_sessions", "count"], dimensions, grain=grain, approximate=True)
        expected = {tuple(r[d] for d in dimensions): r for r in exact.collect()}
        for r in near.collect():
            true = expected.pop(tuple(r[d] for d in dimensions))
            assert r["count"] == true["count"]
            assert abs(r.total_sessions - true.total_sessions) <= metrics.sketch_bound() * true.total_sessions
        assert not expected


def test_an_estimate_is_only_given_when_asked_for(spark):
    table = sessions(spark, 1000, 100)
    daily = metrics.pre_aggregate(table, CUBE, ["session_date"], "day", sketches=True)
    plain = metrics.pre_aggregate(table, CUBE, ["session_date"], "day")
    assert "total_sessions__sketch" in daily.columns and "total_sessions__sketch" not in plain.columns
    for rollup, approximate in ((daily, False), (plain, True)):
        with pytest.raises(ValueError):
            metrics.query_rollup(rollup, CUBE, ["total_sessions"], approximate=approximate)
    # The table answers where the rollup may not: the sketches given here are of no row.
    exact = metrics.answer(table, CUBE, ["total_sessions"], rollups=[daily.limit(0)])
    assert exact.first()[0] == table.select("session_id").distinct().where("session_id IS NOT NULL").count()
    near = metrics.answer(table.limit(0), CUBE, ["total_sessions"], rollups=[daily], approximate=True)
    assert abs(near.first()[0] - exact.first()[0]) <= 3


def test_filters_nulls_and_empty_rollups(spark):
    table = sessions(spark, 1000, 100).withColumn("session_id", F.when(F.col("converted"), F.col("session_id")))
    daily = metrics.pre_aggregate(table, CUBE, ["session_date", "converted"], "day", sketches=True)
    rows = {r.converted: r.total_sessions for r in metrics.query_rollup(
        daily, CUBE, ["total_sessions"], ["converted"], approximate=True).collect()}
    assert rows[False] == 0 and rows[True] > 0
    assert metrics.query_rollup(daily, CUBE, ["total_sessions"], where="converted", approximate=True).first()[0] == rows[True]
    assert metrics.query_rollup(daily.limit(0), CUBE, ["total_sessions"], approximate=True).first()[0] == 0
    assert metrics.query_rollup(daily.limit(0), CUBE, ["total_sessions"], ["session_date"], grain="day",
                                approximate=True).count() == 0
    assert daily.select("session_date").first()[0].date() >= date(2024, 1, 1)
