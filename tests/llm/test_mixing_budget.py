"""Budgets that leave the marginals at their targets."""

import pytest
from hard_rows import prose
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.mixing import marginals, mix


@pytest.fixture(scope="module")
def hot(spark):
    """A source with four fifths of the tokens, a language with three quarters."""
    made = [(i, prose(i % 50, 100), "en" if i % 4 else "de", "hot" if i % 5 else f"s{i % 3}", 1) for i in range(6000)]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long")


def test_shares_meet_targets_without_a_budget(hot):
    got = marginals(mix(hot, budget=None)).toPandas()
    assert (got["expected"] - got["target"]).abs().max() < 0.0102
    assert (got["drawn"] - got["target"]).abs().max() < 0.03
    assert (got["share"] - got["target"]).abs().max() > 0.06
    assert sorted(got["dimension"].unique()) == ["lang", "source", "topic"]


def test_stage_draws_the_asked_mix(spark, hot):
    target = {r["value"]: r["target"] for r in marginals(mix(hot)).where("dimension = 'source'").collect()}
    drawn = corpus_pipeline.mixture(spark, hot, "").groupBy("source").agg(F.count(F.lit(1)).alias("n")).toPandas()
    shares = dict(zip(drawn["source"], drawn["n"] / drawn["n"].sum()))
    assert shares == pytest.approx(target, abs=0.03)


def test_nothing_to_mix(spark):
    empty = spark.createDataFrame([(1, "", "en", "s")], "doc_id long, text string, lang string, source string")
    assert [r["sampled"] for r in mix(empty, budget=None).collect()] == [False]
