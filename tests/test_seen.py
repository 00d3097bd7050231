"""Copies that come days later: the index of seen ids against a plain count, failures half-way, expiry."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.session import streaming_session
from tidemark.sources.logs import read_text
from tidemark.streaming import jobs, seen, sinks, store

START = datetime(2024, 1, 1, 12)
DAYS = 3


def put(spark, make_events, path, number, rows):
    """One batch through the index; returns the (id, time) let through."""
    events = make_events([(i, "page_view", "u", "s", None, t) for i, t in rows])
    within = seen.span(events)
    marked = seen.mark_copies(events, seen.read(spark, path), DAYS, within).cache()
    kept = seen.first_events(marked, events.columns).unionByName(seen.incomparable(events))
    result = sorted((r.event_id or "", str(r.event_timestamp)) for r in kept.collect())
    left = {(r.event_id, str(r.event_date)): r.copies for r in seen.copies(marked).collect()}
    seen.remember(marked, path, sinks.batch_label("c", number), DAYS, within)
    marked.unpersist()
    return result, left


def plain(known, rows):
    """The rule, read off one event after the other in order of time."""
    kept, new = [], set()
    for i, t in sorted(rows):
        day = t.date()
        if any(k == i and abs((d - day).days) <= DAYS for k, d in known) or any(
                k == i and (day - d).days <= DAYS for k, d in new):
            new.add((i, day))
            continue
        new.add((i, day))
        kept.append((i, str(t)))
    known |= new
    return sorted(kept)


def test_batches_against_a_plain_count(spark, make_events, tmp_path):
    rng, path, known = random.Random(5), str(tmp_path / "ids"), set()
    for n in range(12):
        rows = [(f"e{rng.randrange(9)}", START + timedelta(days=n * 2 + rng.randrange(4), hours=rng.randrange(9)))
                for _ in range(12)]
        result, left = put(spark, make_events, path, n, rows)
        assert result == plain(known, rows)
        assert sum(left.values()) == len(rows) - len(result)
    head = store.load(spark, path)
    assert head.version == 12 and len(head.runs) == 1 + 4


def test_ids_and_times_that_cannot_be_compared_stay(spark, make_events, tmp_path):
    path = str(tmp_path / "ids")
    odd = [(None, START), (None, START), ("a", None), ("a", None), ("a", START), ("a", START)]
    result, left = put(spark, make_events, path, 0, odd)
    assert [i for i, _ in result] == ["", "", "a", "a", "a"] and left == {("a", "2024-01-01"): 1}
    assert seen.span(make_events([(None, "page_view", "u", "s", None, START)])) is None


def test_an_earlier_copy_that_comes_later_is_a_copy(spark, make_events, tmp_path):
    path = str(tmp_path / "ids")
    assert put(spark, make_events, path, 0, [("a", START + timedelta(days=2))])[0]
    assert put(spark, make_events, path, 1, [("a", START)])[0] == []
    assert put(spark, make_events, path, 2, [("a", START - timedelta(days=DAYS + 1))])[0]


def test_a_hot_id_is_one_row_a_day(spark, make_events, tmp_path):
    path = str(tmp_path / "ids")
    rows = [("hot", START + timedelta(minutes=n % 5 * 1440 + n)) for n in range(2000)] + [("b", START)]
    result, left = put(spark, make_events, path, 0, rows)
    assert len(result) == 2 and sum(left.values()) == 1999
    assert seen.read(spark, path).count() <= 8


def test_old_days_are_forgotten_and_a_wrong_year_forgets_nothing(spark, make_events, tmp_path):
    path = str(tmp_path / "ids")
    for n in range(store.FANOUT):
        put(spark, make_events, path, n, [(f"e{n}", START + timedelta(days=n)), (f"f{n}", START + timedelta(days=n)),
                                          ("far", datetime(9999, 1, 1))])
    ids = {r.event_id for r in seen.read(spark, path).collect()}
    assert ids == {"far"} | {f"{k}{n}" for k in "ef" for n in range(1, 8)}


def test_only_days_around_the_batch_are_read(spark, make_events, tmp_path):
    path = str(tmp_path / "ids")
    put(spark, make_events, path, 0, [("a", START)])
    events = make_events([("b", "page_view", "u", "s", None, START)])
    plan = seen.mark_copies(events, seen.read(spark, path), DAYS, seen.span(events))._jdf.queryExecution().toString()
    day = (START - datetime(1970, 1, 1)).days
    assert f"GreaterThanOrEqual(day,{day - DAYS})" in plan and f"LessThanOrEqual(day,{day + DAYS})" in plan


@pytest.mark.parametrize("failing", ["first_events", "copies", "remember"])
def test_the_silver_job_repeats_a_batch_that_failed(spark, tmp_path, monkeypatch, failing):
    log, out = tmp_path / "log", str(tmp_path / "out")
    log.mkdir()
    session = streaming_session(spark)

    def write(name, days):
        (log / name).write_text("".join(
            f'{{"event_id":"e{n}","event_type":"purchase","user_id":"u","session_id":"s",'
            f'"timestamp":"2024-01-{1 + d:02d} 10:00:00.000"}}\n' for n, d in enumerate(days)))

    def run():
        jobs.start_validated(read_text(session, str(log), streaming=True), out, f"{out}/checkpoint", jobs.DRAIN,
                             timedelta(days=DAYS)).awaitTermination()

    write("a.txt", [0, 0, 0])
    run()
    write("b.txt", [0, 2, 9, 9])
    with monkeypatch.context() as patch:
        def fail(*args):
            raise OSError("stopped")
        patch.setattr(seen, failing, fail)
        with pytest.raises(Exception, match="stopped"):
            run()
    run()
    good = spark.read.parquet(f"{out}/silver/validated_events")
    assert sorted((r.event_id, r.event_timestamp.day) for r in good.collect()) == [
        ("e0", 1), ("e1", 1), ("e2", 1), ("e2", 10), ("e3", 10)]
    assert spark.read.parquet(f"{out}/silver/repeated_events").agg(F.sum("copies")).first()[0] == 2
    # The checkpoint forgets that the last batch was done; the index has it, so nothing is written twice.
    for name in ("1", ".1.crc"):
        (tmp_path / "out/checkpoint/commits" / name).unlink()
    run()
    assert spark.read.parquet(f"{out}/silver/validated_events").count() == 5
