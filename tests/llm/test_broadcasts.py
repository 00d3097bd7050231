"""Rows that a generator makes are never broadcast: Spark takes them for as few as the rows they are made of."""

import random

from test_near_copies import SCHEMA, words

from tidemark.llm import near_copies, simhash
from tidemark.llm.common import saved, shared


def test_rows_of_shared_keys(spark):
    rows = [(1, 7, "a"), (1, 7, "b"), (1, 8, "c"), (2, 7, "d"), (None, 7, "e"), (None, 7, "f"), (3, 9, "g"), (3, 9, "g"), (3, 9, "h")]
    out = shared(spark.createDataFrame(rows, "x long, y long, z string"), "x", "y").collect()
    assert sorted((r["x"], r["y"], r["z"], r["count"]) for r in out) == [
        (1, 7, "a", 2), (1, 7, "b", 2), (3, 9, "g", 3), (3, 9, "g", 3), (3, 9, "h", 3)]


def test_buckets_and_bands_are_not_broadcast(spark, monkeypatch):
    plans = {}

    def planned(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return saved(df, name)

    for module in (simhash, near_copies):
        monkeypatch.setattr(module, "saved", planned)
    rng = random.Random(6)
    texts = [words(rng, 40) for _ in range(30)]
    texts += [[*t[:-1], "other"] for t in texts[:10]]
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    kept = near_copies.near_copies(docs, fingerprints=True).where("keep")
    assert {r["doc_id"] for r in kept.collect()} == set(range(30))
    for name in ("simhash-buckets", "near-members"):
        assert "SortMergeJoin" in plans[name] and "Broadcast" not in plans[name], name


def test_values_near_crowded_fingerprints_are_not_broadcast(spark):
    fps = [a << 20 | 1 << b for a in range(2) for b in range(19)] + [1 << 20 | 3 << b for b in range(18)]
    links = simhash.links(spark.createDataFrame([(f,) for f in set(fps)], "fp long"))
    assert "Broadcast" not in links._jdf.queryExecution().executedPlan().toString()
    assert not links.isEmpty()
