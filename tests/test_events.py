from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators.events import (
    dedupe_events, enrich_events, rejected_events, strict_values, untimed_events, valid_events, validated_events,
)

NOW = datetime(2024, 3, 15, 12)


@pytest.fixture
def events(make_events):
    def row(i, kind="page_view", user="U1", session="S1", ts=NOW):
        return (i, kind, user, session, "P1", ts)

    return make_events([
        row("ok"), row(None), row("no type", kind=None), row("odd type", kind="signup"),
        row("no user", user=None), row("no session", session=None), row("blank user", user="  "),
        row("upper", kind=" PAGE_VIEW"), row("future", ts=NOW + timedelta(microseconds=1)),
        row("old", ts=NOW - timedelta(days=8)), row("edge", ts=NOW - timedelta(days=7)), row("no time", ts=None),
    ])


def ids(df):
    return {r.event_id for r in df.collect()}


def test_default_rules_are_nulls_and_types(events):
    assert ids(valid_events(events)) == {"ok", "blank user", "future", "old", "edge", "no time"}


def test_time_rules_need_as_of(events):
    assert ids(valid_events(events, as_of=NOW)) == {"ok", "blank user", "edge"}


def test_strict_rules_clean_first(events):
    assert ids(valid_events(strict_values(events))) == {"ok", "upper", "future", "old", "edge", "no time"}


@pytest.mark.parametrize("as_of", [None, NOW])
def test_rejected_is_the_complement(events, as_of):
    good, bad = valid_events(events, as_of), rejected_events(events, as_of)
    assert good.count() + bad.count() == events.count()
    assert not ids(good) & ids(bad)
    assert all(r.reject_reasons for r in bad.collect())


def test_reasons(events):
    reasons = {r.event_id: r.reject_reasons for r in rejected_events(events, as_of=NOW).collect()}
    assert reasons["no type"] == ["event_type unknown"]
    assert reasons["old"] == ["event_timestamp too old"]
    assert reasons["no time"] == ["event_timestamp in the future", "event_timestamp too old"]


def test_enrichment(spark, events):
    with_metadata = events.withColumn("metadata", F.lit('{"page":"/a","referrer":["x"]}'))
    row = enrich_events(with_metadata, ingestion_ts=F.lit(None).cast("timestamp_ntz")).first()
    assert (row.page_url, row.referrer, row.ingestion_ts) == ("/a", None, None)
    stamped = validated_events(with_metadata).first().ingestion_ts
    assert abs(stamped - datetime.now(timezone.utc).replace(tzinfo=None)) < timedelta(minutes=5)


def test_dedupe_keeps_the_earliest_and_all_without_id(make_events):
    rows = [("a", "page_view", "U1", "S1", "P1", NOW + timedelta(seconds=s)) for s in (3, 1, 2)]
    rows += [(None, "page_view", "U1", "S1", "P1", NOW)] * 2
    kept = dedupe_events(make_events(rows)).collect()
    assert len(kept) == 3
    assert [r.event_timestamp for r in kept if r.event_id == "a"] == [NOW + timedelta(seconds=1)]


def test_untimed(events):
    assert ids(untimed_events(events)) == {"no time"}
