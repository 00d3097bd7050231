from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators.sessions import GAP, serving_sessions, session_metrics, user_sessions

START = datetime(2024, 1, 1)
US = timedelta(microseconds=1)


def event(at, kind="page_view", session="S1", user="U1", i="e"):
    return (i, kind, user, session, "P1", at)


def brute_force(rows, gap=GAP, end=True):
    by_key = defaultdict(list)
    for _, kind, user, session, _, at in rows:
        if at is not None:
            by_key[session, user].append((at, kind))
    found = []
    for (session, user), events in by_key.items():
        events.sort(key=lambda e: e[0])
        runs = [[events[0]]]
        for e in events[1:]:
            if e[0] - runs[-1][-1][0] <= gap:
                runs[-1].append(e)
            else:
                runs.append([e])
        for run in runs:
            first, last = run[0][0], run[-1][0] + (gap if end else timedelta(0))
            kinds = [k for _, k in run]
            counts = [kinds.count(k) for k in ("page_view", "add_to_cart", "purchase")]
            found.append((session, user, first, last, (last - first) // timedelta(seconds=1), len(run), *counts,
                          counts[2] > 0, first.date()))
    return sorted(found, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_the_gap_itself_still_joins(make_events):
    rows = []
    for name, pause in {"short": GAP - US, "exact": GAP, "long": GAP + US}.items():
        rows += [event(START, session=name), event(START + pause, session=name)]
    sizes = defaultdict(int)
    for r in session_metrics(make_events(rows)).collect():
        sizes[r.session_id] += 1
    assert dict(sizes) == {"short": 1, "exact": 1, "long": 2}


def test_keys_null_times_and_unknown_types(make_events):
    rows = [
        event(START), event(START + timedelta(minutes=1), kind="signup"), event(None),
        event(START, user="U2"), event(START + timedelta(minutes=29), kind="purchase", user="U2"),
        event(START, session=None),
    ]
    df = session_metrics(make_events(rows))
    assert collected(df) == brute_force(rows)
    per_user = session_metrics(make_events(rows), keys=["user_id"])
    assert {(r.user_id, r.event_count) for r in per_user.collect()} == {("U1", 3), ("U2", 2)}


def test_end_at_last_event(make_events):
    rows = [event(START), event(START + timedelta(minutes=5, microseconds=999999))]
    assert collected(session_metrics(make_events(rows), end="last_event")) == brute_force(rows, end=False)
    with pytest.raises(ValueError):
        session_metrics(make_events(rows), end="other")


def test_filters_on_the_bounds_select_whole_sessions(make_events):
    rows = [event(START), event(START + timedelta(minutes=20))]
    df = session_metrics(make_events(rows))
    assert df.where(F.col("session_end") <= F.lit("2024-01-01 00:40:00").cast("timestamp_ntz")).count() == 0
    assert df.where(F.col("session_start") >= F.lit("2024-01-01 00:10:00").cast("timestamp_ntz")).count() == 0
    assert df.where(F.col("session_end") == F.lit("2024-01-01 00:50:00").cast("timestamp_ntz")).first().event_count == 2


def test_any_session_zone(new_york, make_events):
    night = datetime(2024, 3, 10, 1, 45)
    rows = [event(night + timedelta(minutes=m)) for m in (0, 20, 40, 90)]
    assert collected(session_metrics(make_events(rows))) == brute_force(rows)


EVENTS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c"]), st.sampled_from(["U1", "U2"]),
        st.sampled_from(["page_view", "add_to_cart", "purchase", "signup"]),
        st.integers(-3 * 10**6, 3 * 10**6) | st.sampled_from([k * 600_000 for k in range(-8, 9)]),
    ),
    min_size=1, max_size=60,
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(drawn=EVENTS, base=st.sampled_from([datetime(2024, 1, 1), datetime(1970, 1, 1)]))
def test_same_as_brute_force_in_any_order(make_events, drawn, base):
    gap = timedelta(milliseconds=600)
    rows = [event(base + timedelta(microseconds=us), kind, s, u) for s, u, kind, us in drawn]
    result = session_metrics(make_events(rows).repartition(3), gap=gap)
    assert collected(result) == brute_force(rows, gap)


def test_a_key_with_most_rows_reaches_the_ordering_as_cells(spark):
    """One key with a third of the rows, all within a few gaps."""
    n = 30_000
    events = spark.range(n).select(
        F.lit("e").alias("event_id"), F.lit("page_view").alias("event_type"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("U"), F.col("id"))).alias("user_id"),
        F.lit("S").alias("session_id"), F.lit("P").alias("product_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.expr("INTERVAL '1' SECOND") * (F.col("id") % 7200)).alias("event_timestamp"),
    )
    result = session_metrics(events)
    assert result.agg(F.sum("event_count")).first()[0] == n
    hot = result.where("user_id = 'hot'").collect()
    assert len(hot) == 1 and hot[0].event_count == n // 3
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("partial_min(event_timestamp")


def test_views(make_events):
    df = session_metrics(make_events([event(START)]))
    assert user_sessions(df).columns == [
        "session_id", "user_id", "session_start", "session_end", "event_count", "session_date"]
    narrow = dict(serving_sessions(df).dtypes)
    assert narrow["event_count"] == narrow["purchases"] == "int"
