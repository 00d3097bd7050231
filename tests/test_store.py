"""Tables of many batches: merges in levels, repeated batches, failures half-way."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators.keyed import last_per_key
from tidemark.plans import replay
from tidemark.streaming import sinks, store


def runs_of(path):
    return sorted(p.name for p in Path(path).iterdir() if p.name.startswith("run-"))


def test_a_thousand_batches_need_few_runs():
    runs, written = (), 0
    for version in range(1, 1001):
        runs = (*runs, store.Run(f"run-{version:09d}-0", 0))
        for same, merged in store.merges(runs, version):
            assert len(same) == store.FANOUT and {r.level for r in same} == {merged.level - 1}
            runs = (*(r for r in runs if r not in same), merged)
            written += 1
        assert len(runs) <= (store.FANOUT - 1) * 4
    assert len(runs) == 1 + 7 + 5  # 1000 in octal is 1750
    assert written == 125 + 15 + 1


def test_many_batches(spark, tmp_path):
    rng, path, expected = random.Random(4), str(tmp_path / "t"), {}

    def merge(rows):
        return last_per_key(rows, ["k"], ["t", store.VERSION])

    for n in range(40):
        rows = [(f"k{rng.randrange(12)}", rng.randrange(6), n) for _ in range(5)]
        batch = last_per_key(spark.createDataFrame(rows, "k string, t int, v int"), ["k"], ["t"]).coalesce(1)
        for k, t, v in (tuple(r) for r in batch.collect()):
            expected[k] = max(expected.get(k, (-1, -1)), (t, v))
        assert store.commit(batch, path, f"q-{n:06d}", merge, ["k"], fanout=3)
    assert {r.k: (r.t, r.v) for r in merge(store.read(spark, path)).collect()} == expected
    head = store.load(spark, path)
    assert head.version == 40 and len(head.runs) <= 2 * 4 and head.done == {"q": 39}
    assert set(runs_of(path)) == {r.name for r in head.runs} | set(head.old)  # nothing else is kept
    assert not store.commit(spark.createDataFrame([("k0", 99, 99)], "k string, t int, v int"), path, "q-000039", merge)
    one = merge(store.read(spark, path)).where("k = 'k3'")
    assert one.count() == 1 and "EqualTo(k,k3)" in one._jdf.queryExecution().toString()


def test_a_commit_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")

    def put(k, n):
        sinks.upsert_batch(spark.createDataFrame([(k, n)], "k string, t int"), path, ["k"], ["t"], sinks.batch_label("c", n))

    def rows():
        return {tuple(r) for r in sinks.read_serving(spark, path, ["k"], ["t"]).collect()}

    for n in range(7):
        put(f"k{n % 3}", n)
    before = rows()
    monkeypatch.setattr(store, "replace_text_file", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        put("k0", 7)  # the eighth batch merges, and is lost before the head is replaced
    monkeypatch.undo()
    assert rows() == before
    put("k0", 7)
    assert rows() == before - {("k0", 6)} | {("k0", 7)} and len(store.load(spark, path).runs) == 1
    put("k0", 7)
    assert store.load(spark, path).version == 8


def test_columns_that_come_later(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_batch(spark.createDataFrame([("a", 1)], "k string, t int"), path, ["k"], ["t"], "q-0")
    sinks.upsert_batch(spark.createDataFrame([("b", 1, "x")], "k string, t int, c string"), path, ["k"], ["t"], "q-1")
    assert {tuple(r) for r in sinks.read_serving(spark, path, ["k"], ["t"]).select("k", "c").collect()} == {("a", None), ("b", "x")}


def test_no_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        store.read(spark, str(tmp_path / "none"))
    empty = spark.createDataFrame([], "k string, t int")
    assert sinks.read_serving(spark, str(tmp_path / "none"), ["k"], ["t"], empty.schema).collect() == []
    sinks.upsert_batch(empty, str(tmp_path / "t"), ["k"], ["t"], "q-0")
    assert sinks.read_serving(spark, str(tmp_path / "t"), ["k"], ["t"]).collect() == []
    sinks.compact_serving(spark, str(tmp_path / "t"), str(tmp_path / "u"), ["k"], ["t"])
    with pytest.raises(FileExistsError):
        sinks.compact_serving(spark, str(tmp_path / "t"), str(tmp_path / "u"), ["k"], ["t"])


def test_states_that_add_up(spark, tmp_path):
    path = str(tmp_path / "t")

    def add(rows):
        return rows.groupBy("k").agg(F.sum("n").alias("n"))

    for n in range(20):
        store.commit(spark.createDataFrame([("a", n), ("b", 1)], "k string, n long"), path, f"q-{n}", add, fanout=3)
    assert {tuple(r) for r in add(store.read(spark, path)).collect()} == {("a", 190), ("b", 20)}
    assert json.loads(Path(path, store.HEAD).read_text())["done"] == {"q": 19}


def test_a_rebuild_that_dies_leaves_the_tables(spark, tmp_path, monkeypatch):
    def logs(n):
        events = [json.dumps({"event_id": f"{i}", "event_type": "page_view", "user_id": "U", "session_id": f"S{i % 3}", "product_id": "P",
                              "timestamp": f"2024-01-01 0{i % 5}:00:00.000", "metadata": {}}) for i in range(n)]
        changes = [json.dumps({"entity_type": kind, "timestamp": "2024-01-01 00:00:00.000", key: f"{i}"})
                   for kind, key in (("category", "category_id"), ("user", "user_id"), ("product", "product_id"), ("order", "order_id"),
                                     ("order_item", "order_item_id")) for i in range(n)]
        return (spark.createDataFrame([(v,) for v in x], "value string") for x in ([*events, "garbage"], [*changes, "{}"]))

    root, at = str(tmp_path), F.col("event_timestamp")
    with pytest.raises(FileNotFoundError):
        replay.read_version(spark, root)
    first = replay.reprocess(*logs(4), root, ingestion_ts=at)
    assert replay.live(spark, root) == first

    def counts():
        return {t: df.count() for t, df in replay.read_version(spark, root).items()}

    before = counts()
    assert len(before) == 21 and before["serving.orders"] == before["lake.users"] == before["bronze.raw_events"] == 4
    assert before["bronze.rejected_text"] == before["lake.rejected_changes"] == 1
    whole = sinks.upsert_batch

    def dying(df, path, *more):
        if path.endswith("/products"):
            raise OSError("lost")
        whole(df, path, *more)

    monkeypatch.setattr(sinks, "upsert_batch", dying)
    with pytest.raises(OSError, match="lost"):
        replay.reprocess(*logs(9), root, ingestion_ts=at)
    monkeypatch.undo()
    assert replay.live(spark, root) == first and counts() == before
    seen = []

    def accept(diff):
        seen.append({r.table: (r.only_left, r.only_right) for r in diff.collect()})
        return len(seen) > 1

    assert replay.reprocess(*logs(6), root, accept, ingestion_ts=at) == first and counts() == before
    second = replay.reprocess(*logs(6), root, accept, ingestion_ts=at)
    assert second != first and replay.live(spark, root) == second and counts()["serving.order_items"] == 6
    assert seen[0] == seen[1] and len(seen[0]) == 21 and seen[0]["lake.orders"] == (0, 2) and seen[0]["bronze.rejected_text"] == (0, 0)
