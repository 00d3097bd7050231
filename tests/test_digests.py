"""Comparison by digests against the comparison of all rows."""

import random

import pytest

from tidemark.operators.compare import compare, compare_by_digests, digests, unequal_buckets

SCHEMA = "k string, a string, b int, t timestamp_ntz"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_equals_the_comparison_of_all_rows(spark, buckets):
    rng = random.Random(buckets)
    rows = [(rng.choice(["x", "y", None, f"k{n}"]), rng.choice(["p", None]), rng.randrange(3), None) for n in range(300)]
    other = [*rows[5:], *rows[20:23], ("new", None, None, None), rows[7]]
    rng.shuffle(other)
    left, right = table(spark, rows), table(spark, other)
    found = compare_by_digests("t", left, right, ["k"], buckets)
    assert found.drop("unequal_buckets").collect() == compare("t", left, right).collect()
    assert 1 <= found.first().unequal_buckets <= min(buckets, 10)


def test_one_change_is_one_bucket(spark):
    rows = [(f"k{n}", "a", n, None) for n in range(5000)]
    left, right = table(spark, rows), table(spark, [*rows[:4999], ("k4999", "b", 4999, None)])
    unequal, equal = unequal_buckets(digests(left, ["k"]), digests(right, ["k"]))
    assert len(unequal) == 1 and 4990 <= equal < 5000
    row = compare_by_digests("t", left, right, ["k"]).first()
    assert tuple(row) == ("t", 5000, 5000, 1, 1, 1)


@pytest.mark.parametrize("left, right", [
    ([("k", None, 1, None)], [("k", "", 1, None)]),
    ([("k", "a", None, None)], [("k", "a", 0, None)]),
    ([("k", "a", 1, None)], [("k", "a", 1, None)] * 2),
    ([("k", "a", 1, None)], []),
    ([("k", "a", 1, None), ("k", "b", 2, None)], [("k", "a", 2, None), ("k", "b", 1, None)]),
])
def test_small_differences_show(spark, left, right):
    for one, two in ((left, right), (right, left)):
        one, two = table(spark, one), table(spark, two)
        found = compare_by_digests("t", one, two, ["k"], 1)
        assert found.first().unequal_buckets == 1
        assert found.drop("unequal_buckets").collect() == compare("t", one, two).collect()


def test_equal_and_empty_tables_are_not_compared_by_row(spark):
    rows = table(spark, [("k", "a", 1, None)] * 3)
    assert tuple(compare_by_digests("t", rows, rows.select("t", "b", "a", "k"), ["k"]).first()) == ("t", 3, 3, 0, 0, 0)
    assert tuple(compare_by_digests("t", rows.limit(0), rows.limit(0), ["k"]).first()) == ("t", 0, 0, 0, 0, 0)


def test_a_hot_bucket_adds_up(spark):
    many = spark.range(200000).selectExpr("'hot' AS k", "CAST(id AS STRING) AS a", "1 AS b", "CAST(NULL AS TIMESTAMP_NTZ) AS t")
    assert unequal_buckets(digests(many, ["k"]), digests(many.repartition(7), ["k"])) == ([], 200000)
