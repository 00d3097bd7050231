"""Funnel, user totals, entity changes, hierarchy and comparison."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes as entity
from tidemark.operators.compare import compare, difference
from tidemark.operators.funnel import coarser_funnel, product_funnel, serving_funnel
from tidemark.operators.hierarchy import category_roots
from tidemark.operators.keyed import first_per_key, last_per_key
from tidemark.operators.sessions import session_metrics
from tidemark.operators.skew import salted_join
from tidemark.operators.users import merge_states, user_360, user_state
from tidemark.plans import reports
from tidemark.sources.logs import parse_changes

START = datetime(2024, 1, 1)


@pytest.fixture
def clicks(make_events):
    rng = random.Random(3)
    kinds = ["page_view", "add_to_cart", "purchase", "signup"]
    return make_events([
        (str(i), rng.choice(kinds), f"U{rng.randrange(6)}", f"S{rng.randrange(3)}", rng.choice(["P1", "P2", None]),
         START + timedelta(seconds=rng.randrange(3 * 86400)))
        for i in range(400)
    ])


def test_windows_are_half_open(make_events):
    on_the_minute = START + timedelta(minutes=1)
    rows = [(str(i), "page_view", "U", "S", "P1", t) for i, t in enumerate(
        [START, on_the_minute - timedelta(microseconds=1), on_the_minute])]
    got = {(r.window_start, r.window_end, r.page_views) for r in product_funnel(make_events(rows)).collect()}
    assert got == {(START, on_the_minute, 2), (on_the_minute, on_the_minute + timedelta(minutes=1), 1)}


def test_null_product_stays_in_the_lake_and_out_of_serving(make_events):
    rows = [("1", "signup", "U", "S", None, START), ("2", "page_view", "U", "S", "P1", START),
            ("3", "page_view", "U", "S", "P1", None)]
    funnel = product_funnel(make_events(rows))
    assert {(r.product_id, r.page_views, r.purchases) for r in funnel.collect()} == {(None, 0, 0), ("P1", 1, 0)}
    assert [r.product_id for r in serving_funnel(funnel).collect()] == ["P1"]


def test_coarser_funnel_equals_direct(clicks):
    minute, hour = timedelta(minutes=1), timedelta(hours=1)
    again = coarser_funnel(product_funnel(clicks), minute, hour)
    assert difference(again, product_funnel(clicks, hour)).count() == 0
    with pytest.raises(ValueError):
        coarser_funnel(again, hour, timedelta(minutes=90))


def test_merged_user_state_equals_full(clicks):
    sessions = session_metrics(clicks)
    early = F.col("session_date") < F.lit(date(2024, 1, 2))
    merged = merge_states(user_state(sessions.where(early)), user_state(sessions.where(~early)))
    full = user_360(user_state(sessions))
    assert difference(user_360(merged), full).count() == 0
    row = full.orderBy("user_id").first()
    mine = [s for s in sessions.collect() if s.user_id == row.user_id]
    assert row.total_sessions == len(mine) and row.total_events == sum(s.event_count for s in mine)
    assert row.avg_session_duration_seconds == sum(s.session_duration_seconds for s in mine) / len(mine)
    assert row.is_converted == any(s.converted for s in mine)


def test_extremes_per_key_do_not_depend_on_order(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), (None, 5, "m"), (None, 4, "l")]
    for seed in range(3):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k string, t int, v string").repartition(3)
        assert {tuple(r) for r in last_per_key(df, ["k"], ["t"]).collect()} == {
            ("a", 2, "z"), ("b", None, "n"), (None, 5, "m")}
        assert {tuple(r) for r in first_per_key(df, ["k"], ["t"]).collect()} == {
            ("a", 1, "x"), ("b", None, "n"), (None, 4, "l")}


CHANGES = [
    '{"entity_type":"category","timestamp":"2024-01-01 00:00:00.000","category_id":"C1","cat_name":"Home"}',
    '{"entity_type":"user","timestamp":"2024-01-01 00:00:00.000","user_id":"U1","user_name":"Ann","user_email":"a@x",'
    '"user_city":"Oslo","registered_date":"2023-05-01","user_status":"active","updated_at":"2024-01-01 00:00:00.000"}',
    '{"entity_type":"user","timestamp":"2024-01-02 00:00:00.000","user_id":"U1","user_city":"Rome","registered_date":"x"}',
    '{"entity_type":"product","timestamp":"2024-01-01 00:00:00.000","product_id":"P1","price":9.99,"category_id":"C1"}',
    '{"entity_type":"product","timestamp":"2024-01-01 00:00:00.000","product_id":"P2","price":"cheap"}',
    '{"entity_type":"order","timestamp":"2024-01-03 00:00:00.000","order_id":"O1","order_user_id":"U1",'
    '"order_total":19.98,"order_created_at":"2024-01-03 00:00:00.000","order_date":"2024-01-03"}',
    '{"entity_type":"order_item","timestamp":"2024-01-03 00:00:00.000","order_item_id":"I1","order_item_order_id":"O1",'
    '"product_id":"P1","quantity":2,"unit_price":9.99,"line_total":19.98,"order_date":"2024-01-03"}',
    '{"entity_type":"other","user_id":"U9"}',
]


def test_routes(spark):
    parsed = parse_changes(spark.createDataFrame([(c,) for c in CHANGES], "value string"))
    users = entity.route(parsed, "user", keep=[entity.CHANGED])
    assert users.count() == 2 and "name" in users.columns
    latest = entity.current(users, "user_id").first()
    assert (latest.city, latest.registered_date) == ("Rome", None)
    before = entity.as_of(users, "user_id", datetime(2024, 1, 1, 12)).first()
    assert (before.city, before.registered_date) == ("Oslo", date(2023, 5, 1))
    assert {r.price for r in entity.route(parsed, "product").collect()} == {Decimal("9.99"), None}
    assert entity.route(parsed, "order").first().total == Decimal("19.98")
    item = entity.route(parsed, "order_item").first()
    assert (item.order_id, item.quantity, item.line_total) == ("O1", 2, Decimal("19.98"))
    assert [tuple(r) for r in entity.route(parsed, "category").collect()] == [("C1", "Home", None)]
    assert "updated_at" not in entity.serving_columns(users, "user").columns


def test_history_across_cells_and_ties(spark):
    rng = random.Random(5)
    rows = []
    for key in ("a", "b"):
        for seq in range(60):
            rows.append((key, START + timedelta(minutes=15 * rng.randrange(40)), seq, f"v{seq}"))
    rows += [("once", START, 0, "v0"), (None, START, 0, "v0"), ("untimed", None, 0, "v0")]
    log = spark.createDataFrame(rows, "k string, change_ts timestamp_ntz, seq int, v string")
    got = entity.history(log, "k", tie_break=["seq"]).collect()

    expected = {}
    for k, ts, seq, v in rows:
        if k and ts and (k, ts) not in expected or (k and ts and expected[k, ts][0] < seq):
            expected[k, ts] = (seq, v)
    times = {k: sorted(t for kk, t in expected if kk == k) for k in ("a", "b", "once")}
    assert len(got) == len(expected)
    for r in got:
        later = [t for t in times[r.k] if t > r.valid_from]
        assert (r.seq, r.v) == expected[r.k, r.valid_from]
        assert r.valid_to == (later[0] if later else None)
        assert r.is_current == (not later)


def test_hierarchy(spark):
    rows = [("r", "Root", None), ("c", "Child", "r"), ("g", "Grandchild", "c"), ("lost", "Lost", "nowhere"),
            ("x", "X", "y"), ("y", "Y", "x")]
    rows += [("under", "U", "lost"), ("self", "S", "self"), ("to x", "T", "x"), (None, "N", "r")]
    rows += [(f"d{i}", "D", f"d{i - 1}" if i else "g") for i in range(20)]
    df = spark.createDataFrame(rows, "category_id string, name string, parent_category_id string")
    found = {r.category_id: (r.root_category_id, r.depth, r.resolved) for r in category_roots(df).collect()}
    assert found == {
        "r": ("r", 1, True), "c": ("r", 2, True), "g": ("r", 3, True),
        **{f"d{i}": ("r", 4 + i, True) for i in range(20)},
        **{k: (None, None, False) for k in ("lost", "under", "x", "y", "self", "to x", None)},
    }
    assert category_roots(df.limit(0)).count() == 0


def test_revenue_of_deep_and_lost_categories(spark):
    categories = spark.createDataFrame(
        [("a", "A", None), ("b", "B", "a"), ("c", "C", "b"), ("d", "D", "nowhere")],
        "category_id string, name string, parent_category_id string")
    products = spark.createDataFrame([("p1", "b"), ("p2", "c"), ("p3", "d")], "product_id string, category_id string")
    orders = spark.createDataFrame([("o", date(2024, 1, 1), Decimal("60.00"))],
                                   "order_id string, order_date date, total decimal(10,2)")
    items = spark.createDataFrame([("o", f"p{i}", 1, Decimal(f"{i}0.00")) for i in (1, 2, 3)],
                                  "order_id string, product_id string, quantity int, line_total decimal(10,2)")
    out = reports.revenue_by_root_category(items, orders, products, categories, date(2024, 1, 2)).collect()
    assert {r.category: float(r.total_revenue) for r in out} == {"A": 30.0, None: 30.0}


def test_salted_join_equals_join(spark):
    large = spark.range(500).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"), "id")
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(6)], "k bigint, v string")
    salted = salted_join(large, lookup, "k", spread_by=["id"], salts=4)
    assert difference(salted.select("k", "id", "v"), large.join(lookup, "k").select("k", "id", "v")).count() == 0


def test_compare_counts_copies(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "i int, s string")
    right = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "i int, s string")
    assert tuple(compare("t", left, right).first()) == ("t", 3, 3, 1, 1)
    assert {(r.i, r.surplus) for r in difference(left, right).collect()} == {(1, 1), (3, -1)}
    assert tuple(compare("t", left, left).first()) == ("t", 3, 3, 0, 0)
    assert tuple(compare("t", left.limit(0), right.limit(0)).first()) == ("t", 0, 0, 0, 0)
