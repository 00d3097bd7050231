"""Contracts, rules, reports and metrics on small tables."""

import hmac
import json
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tidemark import contracts
from tidemark.operators import quality
from tidemark.plans import metrics, reports
from tidemark.sources.logs import contract_options

NOW = datetime(2024, 1, 31)


def test_contract_schema_and_tags():
    c = contracts.load("gold.session_metrics")
    assert c.schema["session_start"].dataType == T.TimestampNTZType()
    assert c.schema["session_id"].metadata == {"required": True, "tags": ["governance:primary_key"]}
    assert c.partition_by == ("session_date",) and c.primary_key == ["session_id"]
    assert contracts.load("entities.orders").schema["total"].dataType == T.DecimalType(10, 2)
    with pytest.raises(FileNotFoundError):
        contracts.load("gold.nothing")


def test_contract_lookups():
    c = contracts.load("bronze.raw_events")
    assert c.server("kafka")["topic"] == "raw-events"
    assert c.property("watermark.delay") == "5 seconds" and c.property("none", "x") == "x"
    for missing in (lambda: c.server("ftp"), lambda: c.property("none")):
        with pytest.raises(KeyError):
            missing()


def test_partition_columns_follow_their_position():
    c = contracts.Contract.from_dict({"id": "a.b", "schema": [
        {"name": "x", "type": "INT", "partitionKeyPosition": 2}, {"name": "y", "type": "INT", "partitionKeyPosition": 1}]})
    assert c.partition_by == ("y", "x")


def test_contract_files(tmp_path):
    spec = {"id": "a.b", "schema": [{"name": "x", "type": "INT", "required": True}]}
    (tmp_path / "c.json").write_text(json.dumps(spec))
    (tmp_path / "c.yaml").write_text("id: a.b\nschema:\n  - {name: x, type: INT, required: true}\n")
    loaded = contracts.load_file(tmp_path / "c.json")
    assert loaded.required == ["x"]
    pytest.importorskip("yaml")
    assert contracts.load_file(tmp_path / "c.yaml").schema == loaded.schema


def test_breaking_changes():
    old = contracts.load("gold.user_360")

    def changed(columns, **more):
        return contracts.Contract(id=old.id, columns=tuple(columns), **more)

    optional = {"name": "segment", "type": "STRING"}
    assert contracts.breaking_changes(old, changed([*old.columns, optional])) == []
    problems = contracts.breaking_changes(old, changed(
        [{**old.columns[0], "type": "INT"}, *old.columns[2:], {**optional, "required": True}], partition_by=("user_id",)))
    assert len(problems) == 4


def test_bootstrap_creates_tables_once(spark, tmp_path):
    for _ in range(2):
        names = contracts.bootstrap(spark, str(tmp_path))
    assert len(names) == 11
    table = spark.table("gold.session_metrics")
    assert [f.name for f in table.schema] == contracts.load("gold.session_metrics").names
    assert table.count() == 0


def test_conform_and_mask(spark):
    c = contracts.load("entities.users")
    df = spark.createDataFrame([("U1", "Ann")], "user_id string, name string")
    full = contracts.conform(df, c)
    assert full.columns == c.names and full.first().city is None
    for secret in (b"key", b"k" * 100):
        masked = contracts.mask(df, c, secret).first()
        assert masked.user_id == hmac.new(secret, b"U1", "sha256").hexdigest() and masked.name != "Ann"
    with pytest.raises(ValueError):
        contracts.mask(df, c, b"")


NESTED = {
    "id": "urn:x:raw", "servers": [{"type": "kafka", "topic": "t", "config": {
        "properties.group.id": "g", "scan.startup.mode.default": "latest-offset",
        "scan.startup.mode.backfill": "earliest-offset", "json.ignore-parse-errors": "true"}}],
    "schema": [{"name": "raw", "physicalType": "table", "properties": [
        {"name": "id", "physicalType": "STRING", "required": True, "unique": True},
        {"name": "kind", "physicalType": "STRING", "quality": [{"type": "enum", "values": ["a"]}]},
        {"name": "at", "physicalType": "TIMESTAMP(6)", "required": True},
        {"name": "day", "physicalType": "DATE", "partitionKeyPosition": 1}]}],
    "customProperties": [{"property": "owner", "value": "team's"}],
    "quality": [{"type": "custom", "description": "day IS NOT NULL"}, {"type": "freshness", "interval": "5m"}],
}


def test_nested_layout(spark, tmp_path):
    c = contracts.Contract.from_dict(NESTED)
    assert [f.dataType.simpleString() for f in c.schema] == ["string", "string", "timestamp_ntz", "date"]
    assert c.partition_by == ("day",) and c.required == ["id", "at"]
    options = contract_options(c, "b:1")
    assert options == {"kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "latest", "kafka.group.id": "g"}
    assert contract_options(c, "b:1", True)["startingOffsets"] == "earliest"
    rows = [("1", "a", NOW, NOW.date()), ("1", "b", NOW, None)]
    checked = quality.check(spark.createDataFrame(rows, c.schema), c)
    found = {(r.rule, r.subject): r.violations for r in checked.collect()}
    assert found == {("required", "id"): 0, ("required", "at"): 0, ("enumeration", "kind"): 1,
                     ("custom", "day IS NOT NULL"): 1, ("freshness", "at"): None, ("uniqueness", "id"): 1}
    contracts.bootstrap(spark, str(tmp_path), {"bronze.nested": c})
    assert "contract.owner=team's" in spark.sql("DESCRIBE TABLE EXTENDED bronze.nested").where("col_name = 'Table Properties'").first().data_type


@pytest.mark.parametrize("rule", [{"type": "odd"}, {"type": "custom"}])
def test_rules_that_cannot_be_evaluated_raise(spark, rule):
    c = contracts.Contract.from_dict({"id": "x", "schema": [{"name": "i", "type": "INT"}], "quality": [rule]})
    with pytest.raises(ValueError):
        quality.check(spark.range(1).selectExpr("1 AS i"), c)


def test_rules_find_every_kind_of_violation(spark):
    c = contracts.load("bronze.raw_events")
    rows = [("a", "page_view", "U", "S", NOW), ("a", "odd", None, "S", NOW), (None, None, "U", "S", None),
            (None, "purchase", "U", "S", NOW)]
    df = contracts.conform(spark.createDataFrame(
        rows, "event_id string, event_type string, user_id string, session_id string, event_timestamp timestamp_ntz"), c)
    df = df.withColumn("event_date", F.to_date("event_timestamp"))
    late = quality.check(df, c, NOW + timedelta(minutes=6))
    found = {(r.rule, r.subject): r.violations for r in late.collect()}
    assert found["required", "event_id"] == found["notNull", "event_id"] == 2
    assert found["required", "user_id"] == 1 and found["required", "event_timestamp"] == 1
    assert found["enumeration", "event_type"] == 1
    assert found["uniqueness", "event_id"] == 1
    assert found["rowCount", "*"] == 0 and found["freshness", "event_timestamp"] == 1
    fresh = {(r.rule, r.subject): r.passed for r in quality.check(df, c, NOW).collect()}
    assert fresh["freshness", "event_timestamp"] and not fresh["uniqueness", "event_id"]


def test_rules_on_an_empty_table(spark):
    c = contracts.load("bronze.raw_events")
    empty = spark.createDataFrame([], c.schema)
    found = {(r.rule, r.subject): r.violations for r in quality.check(empty, c, NOW).collect()}
    assert found["rowCount", "*"] == 1 and found["uniqueness", "event_id"] == 0
    assert found["freshness", "event_timestamp"] == 1


def test_custom_rules(spark):
    c = contracts.load("gold.product_funnel_1m")
    df = spark.createDataFrame([("P", NOW, NOW, 1, 0, 0), ("P", NOW, NOW + timedelta(minutes=1), 1, 0, 0)], c.schema)
    found = {(r.rule, r.subject): r.violations for r in quality.check(df, c).collect()}
    assert found["custom", "window_not_empty"] == 1


def test_orphans_and_reconciliation(spark):
    child = spark.createDataFrame([("x",), ("x",), ("p",), (None,)], "fk string")
    parent = spark.createDataFrame([("p",)], "id string")
    assert [tuple(r) for r in quality.orphans(child, "fk", parent, "id").collect()] == [("x", 2)]
    assert tuple(quality.integrity([("r", child, "fk", parent, "id")]).first()) == ("r", 1, 2)
    assert tuple(quality.integrity([("r", parent, "id", parent, "id")]).first()) == ("r", 0, 0)
    orders = spark.createDataFrame(
        [("same", Decimal("3.00")), ("less", Decimal("5.00")), ("none", Decimal("1.00"))],
        "order_id string, total decimal(10,2)")
    items = spark.createDataFrame(
        [("same", Decimal("1.00")), ("same", Decimal("2.00")), ("less", Decimal("4.00")), ("lost", Decimal("1.00"))],
        "order_id string, line_total decimal(10,2)")
    found = {r.order_id: r.status for r in quality.reconcile_orders(orders, items).collect()}
    assert found == {"less": "mismatch", "none": "no items", "lost": "no order"}


@pytest.fixture
def shop(spark):
    money = "decimal(10,2)"
    categories = spark.createDataFrame(
        [("C", "Top", None), ("C1", "One", "C"), ("C2", "Two", "C")],
        "category_id string, name string, parent_category_id string")
    products = spark.createDataFrame([("P1", "C1"), ("P2", "C2")], "product_id string, category_id string")
    orders = spark.createDataFrame(
        [("O1", "U1", Decimal("10.00"), date(2024, 1, 30)), ("O2", "U1", Decimal("20.01"), date(2024, 1, 1)),
         ("O3", "U2", Decimal("99.00"), date(2023, 12, 31))],
        f"order_id string, user_id string, total {money}, order_date date")
    items = spark.createDataFrame(
        [("O1", "P1", 1, Decimal("4.00")), ("O1", "P1", 2, Decimal("5.00")), ("O1", "P2", 1, Decimal("1.00")),
         ("O2", "P1", 1, Decimal("20.01")), ("O3", "P1", 9, Decimal("99.00"))],
        f"order_id string, product_id string, quantity int, line_total {money}")
    users = spark.createDataFrame(
        [("U1", "Oslo", date(2024, 1, 5)), ("U2", "Oslo", date(2023, 12, 5)), ("U3", "Rome", date(2024, 1, 6))],
        "user_id string, city string, registered_date date")
    return items, orders, products, categories, users


def test_revenue_counts_the_order_total_once_per_line(shop):
    items, orders, products, categories, _ = shop
    rows = reports.revenue_by_category(items, orders, products, categories, NOW.date()).collect()
    # One: lines of O1 (twice) and O2, so the average is (10 + 10 + 20.01) / 3.
    assert [tuple(r) for r in rows] == [
        ("One", 2, 4, Decimal("29.01"), Decimal("13.34")), ("Two", 1, 1, Decimal("1.00"), Decimal("10.00"))]
    top = reports.revenue_by_root_category(items, orders, products, categories, NOW.date()).collect()
    assert [(r.category, r.total_orders, r.total_revenue) for r in top] == [("Top", 2, Decimal("30.01"))]


def test_cities_and_cohorts(shop):
    _, orders, _, _, users = shop
    assert reports.avg_order_value_by_city(orders, users, NOW.date()).count() == 0
    row = reports.avg_order_value_by_city(orders, users, NOW.date(), min_orders=2).first().asDict()
    assert row == {"city": "Oslo", "total_orders": 2, "unique_buyers": 1, "avg_order_value": Decimal("15.01"),
                   "total_revenue": Decimal("30.01"), "revenue_per_buyer": Decimal("30.01")}
    cohorts = reports.user_cohorts(users, orders, NOW.date()).collect()
    assert [(r.cohort_month, r.cohort_size, r.total_orders) for r in cohorts] == [
        (date(2024, 1, 1), 1, 2), (date(2023, 12, 1), 1, 1)]


def test_top_products_break_ties_and_need_views(spark):
    rows = [(f"P{i}", NOW - timedelta(hours=1), 10, 5, 1) for i in range(12)]
    rows += [("few", NOW, 9, 9, 9), ("old", NOW - timedelta(hours=25), 99, 9, 99), ("P3", NOW, 10, 0, 9)]
    funnel = spark.createDataFrame(
        rows, "product_id string, window_start timestamp_ntz, page_views bigint, add_to_carts bigint, purchases bigint")
    got = reports.top_converting_products(funnel, NOW).collect()
    assert [r.product_id for r in got] == ["P3", "P0", "P1", "P10", "P11", "P2", "P4", "P5", "P6", "P7"]
    assert got[0].conversion_rate_pct == Decimal("50.00") and got[0].add_to_cart_rate_pct == Decimal("25.00")


SESSIONS = ("session_id string, user_id string, session_start timestamp_ntz, session_duration_seconds bigint, "
            "page_views bigint, add_to_carts bigint, purchases bigint, converted boolean, session_date date")


@pytest.fixture
def sessions(spark):
    def row(sid, at, seconds, views, carts, buys):
        return (sid, "U", at, seconds, views, carts, buys, buys > 0, at.date())

    return spark.createDataFrame([
        row("a", NOW, 10, 3, 1, 1), row("a", NOW + timedelta(minutes=59), 21, 0, 0, 0),
        row("b", NOW + timedelta(days=1), 5, 2, 0, 0)], SESSIONS)


def test_session_reports(sessions):
    hours = reports.hourly_event_volume(sessions).collect()
    assert [(r.hour_bucket, r.total_events, r.unique_sessions) for r in hours] == [
        (NOW + timedelta(days=1), 2, 1), (NOW, 5, 1)]
    row = reports.session_funnel(sessions).first()
    assert (row.total_sessions, row.sessions_with_pageview, row.view_to_cart_pct) == (3, 2, Decimal("50.00"))
    empty = reports.session_funnel(sessions.limit(0)).first()
    assert (empty.total_sessions, empty.overall_conversion_pct) == (0, None)


def test_metrics(sessions):
    rows = metrics.query(sessions, "session_metrics", ["conversion_rate", "total_sessions", "count"],
                         ["session_date"], grain="month").collect()
    assert {(r.session_date, r.conversion_rate, r.total_sessions, r["count"]) for r in rows} == {
        (datetime(2024, 1, 1), 0.5, 1, 2), (datetime(2024, 2, 1), 0.0, 1, 1)}
    only = metrics.query(sessions, "session_metrics", ["count"], where="converted").first()
    assert only["count"] == 1
    for wrong in (lambda: metrics.query(sessions, "session_metrics", ["nope"]),
                  lambda: metrics.query(sessions, "session_metrics", ["count"], ["nope"])):
        with pytest.raises(KeyError):
            wrong()


def test_rollup_answers_like_the_table(sessions):
    daily = metrics.pre_aggregate(sessions, "session_metrics", ["session_date", "converted"], "day")
    wanted = ["count", "avg_session_duration_seconds", "conversion_rate", "total_page_views"]
    direct = metrics.query(sessions, "session_metrics", wanted).first()
    assert metrics.query_rollup(daily, "session_metrics", wanted).first() == direct
    with pytest.raises(ValueError):
        metrics.query_rollup(daily, "session_metrics", ["total_sessions"])
    with pytest.raises(KeyError):
        metrics.query_rollup(daily, "session_metrics", ["count"], ["user_id"])
