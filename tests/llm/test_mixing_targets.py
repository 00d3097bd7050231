"""Raking to a tolerance, and targets that can't be met."""

import pytest

from tidemark.llm.mixing import DIMENSIONS, marginals, mix, rake, residual

SCHEMA = "doc_id long, text string, lang string, source string"


def docs(spark, cells):
    rows = [(i, "word " * n, lang, source) for i, (source, lang, n) in enumerate(cells)]
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_that_contradict_each_other_raise(spark):
    # All of a is en and all of b is de: their shares can't differ.
    table = docs(spark, [("a", "en", 300), ("a", "en", 200), ("b", "de", 400)])
    with pytest.raises(ValueError, match="can't be met together"):
        mix(table, targets={"source": {"a": 0.6, "b": 0.4}, "lang": {"en": 0.5, "de": 0.5}})
    out = mix(table, targets={"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.5, "de": 0.5}}, budget=None)
    shares = {(r["dimension"], r["value"]): r for r in marginals(out, {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.5, "de": 0.5}}).collect()}
    assert shares["source", "a"]["asked"] == 0.5 and shares["source", "a"]["target"] == pytest.approx(0.5, rel=1e-10)


def test_a_target_without_tokens_raises(spark):
    with pytest.raises(ValueError, match="no tokens of source 'c'"):
        mix(docs(spark, [("a", "en", 30)]), targets={"source": {"a": 0.5, "c": 0.5}})
    assert mix(docs(spark, [("a", "en", 0)]), targets={"source": {"a": 0.5, "c": 0.5}}).count() == 1  # no tokens at all


def test_structural_zeros_are_met_where_they_can_be(spark):
    cells = spark.createDataFrame([("a", "en", "long", 900), ("a", "de", "long", 50), ("b", "en", "short", 400), ("b", "fr", "long", 70),
                                   ("c", "de", "short", 9000), ("c", "en", "long", 3)], "source string, lang string, topic string, tokens long")
    raked = rake(cells, {"source": {"a": 0.3, "b": 0.3, "c": 0.4}, "lang": {"en": 0.55, "de": 0.35, "fr": 0.1},
                         "topic": {"short": 0.5, "long": 0.5}}, 0.7, tolerance=0.03)
    assert residual(raked) <= 0.03 and raked.count() == 6
    sums = {d: {r[0]: r[1] for r in raked.groupBy(d).agg({"weight": "sum"}).collect()} for d in DIMENSIONS}
    assert sums["source"] == pytest.approx({"a": 0.3, "b": 0.3, "c": 0.4}, rel=0.03)
    assert sums["lang"] == pytest.approx({"en": 0.55, "de": 0.35, "fr": 0.1}, rel=0.03)


def test_a_target_of_nothing(spark):
    table = docs(spark, [("a", "en", 300), ("b", "de", 400), ("b", "en", 80)])
    with pytest.raises(ValueError):
        mix(table, targets={"source": {"a": 1.0, "b": 0.0}, "lang": {"en": 0.5, "de": 0.5}})
