"""Domain tables derived from the generic star-schema and event tables.

The click log, the change log and the entity tables are projections of the
given Parquet tables, so every query grows with them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


# Stand-ins for now: the ends of the event and the order data.
EVENTS_AS_OF = datetime(2024, 1, 31)
ORDERS_AS_OF = date(2001, 8, 1)
CHANGE_KINDS = ("category", "user", "product", "order", "order_item")

_EVENT_TYPE = "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' ELSE event_type END"
_LEAF_CATEGORY = "'C-' || p_type || '-' || p_brand"
_REGISTERED = "date_add(DATE'1999-08-02', CAST(c_custkey * 37 % 730 AS INT))"


def _payload_time(ts: str) -> str:
    """Timestamp text of the logs: millisecond precision."""
    text = f"CAST({ts} AS STRING)"
    return f"rpad(CASE WHEN instr({text}, '.') > 0 THEN {text} ELSE {text} || '.' END, 23, '0')"


def log_time(ts: str) -> Column:
    """The time an event of the logs gets in its text."""
    return F.expr(_payload_time(ts))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream, be it one file or a folder of files."""
    schema = _table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/[e]vents.parquet")


def click_events(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    """Typed click events, as a columnar bronze table would hold them, without metadata."""
    events = _table(spark, sf_dir, "events") if source is None else source
    return events.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        f"{_EVENT_TYPE} AS event_type",
        "'U' || user_id AS user_id",
        "'S' || user_id AS session_id",
        "'P' || get_json_object(props, '$.k') AS product_id",
        "ts AS event_timestamp",
    )


def click_log(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    """The raw click log: one JSON text per event.

    A generator makes the text, so it is written once per row: a filter on it
    would otherwise write it again.
    """
    events = _table(spark, sf_dir, "events") if source is None else source
    named = events.selectExpr(
        "event_id", "user_id", "value", f"{_EVENT_TYPE} AS kind",
        "'P' || get_json_object(props, '$.k') AS product", f"{_payload_time('ts')} AS time",
    )
    return named.selectExpr("""explode(array(to_json(named_struct(
        'event_id', CAST(event_id AS STRING), 'event_type', kind,
        'user_id', 'U' || user_id, 'session_id', 'S' || user_id, 'product_id', product, 'timestamp', time,
        'metadata', named_struct(
            'page', CASE WHEN kind = 'page_view' THEN '/products/' || product END,
            'referrer', CASE WHEN kind = 'page_view' AND user_id % 5 > 1
                        THEN 'https://ref.example/' || (user_id % 7) END,
            'quantity', CASE WHEN kind = 'add_to_cart' THEN CAST(event_id % 5 + 1 AS INT) END,
            'price', CASE WHEN kind = 'add_to_cart' THEN value END,
            'order_id', CASE WHEN kind = 'purchase' THEN 'ORD-' || event_id END,
            'total', CASE WHEN kind = 'purchase' THEN value END))))) AS value""")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types as roots, the brands of a type below it."""
    part = _table(spark, sf_dir, "part").select("p_type", "p_brand").distinct()
    roots = part.selectExpr(
        "'C-' || p_type AS category_id", "p_type AS name", "CAST(NULL AS STRING) AS parent_category_id"
    ).distinct()
    leaves = part.selectExpr(
        f"{_LEAF_CATEGORY} AS category_id", "p_brand || ' ' || p_type AS name", "'C-' || p_type AS parent_category_id"
    )
    return roots.unionByName(leaves)


def sales_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of four levels: region, nation, segment of a nation, customer.

    The parent of nation 0 is missing, and nations 1 and 2 are each other's parent.
    """
    nation = _table(spark, sf_dir, "nation").selectExpr(
        "'N-' || n_nationkey AS category_id", "n_name AS name",
        "CASE n_nationkey WHEN 0 THEN 'R-none' WHEN 1 THEN 'N-2' WHEN 2 THEN 'N-1' ELSE 'R-' || n_regionkey END"
        " AS parent_category_id")
    region = _table(spark, sf_dir, "region").selectExpr(
        "'R-' || r_regionkey AS category_id", "r_name AS name", "CAST(NULL AS STRING) AS parent_category_id")
    customer = _table(spark, sf_dir, "customer")
    segment = "'S-' || c_nationkey || '-' || c_mktsegment"
    segments = customer.selectExpr(
        f"{segment} AS category_id", "c_mktsegment AS name", "'N-' || c_nationkey AS parent_category_id").distinct()
    people = customer.selectExpr(
        "'C-' || c_custkey AS category_id", "c_name AS name", f"{segment} AS parent_category_id")
    return region.unionByName(nation).unionByName(segments).unionByName(people)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "'U' || c_custkey AS user_id", "c_name AS name", "'u' || c_custkey || '@example.com' AS email",
        "n_name AS city", f"{_REGISTERED} AS registered_date",
        "CASE WHEN c_acctbal < 0 THEN 'inactive' ELSE 'active' END AS status",
        f"CAST({_REGISTERED} AS TIMESTAMP_NTZ) AS updated_at",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr(
        "'P' || p_partkey AS product_id", "p_name AS name", f"{_LEAF_CATEGORY} AS category_id",
        "CAST(p_retailprice AS DECIMAL(10,2)) AS price", "'active' AS status",
        "TIMESTAMP_NTZ'1995-01-01 00:00:00' AS created_at",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "'O' || o_orderkey AS order_id", "'U' || o_custkey AS user_id",
        "CAST(o_totalprice AS DECIMAL(10,2)) AS total",
        "CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'open' END AS status",
        "CAST(o_orderdate AS TIMESTAMP_NTZ) AS created_at", "to_date(o_orderdate) AS order_date",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines. Their ids repeat, as the line numbers they are made of do."""
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "'OI-' || l_orderkey || '-' || l_linenumber AS order_item_id",
        "'O' || l_orderkey AS order_id", "'P' || l_partkey AS product_id", "CAST(l_quantity AS INT) AS quantity",
        "CAST(CAST(l_extendedprice AS DECIMAL(10,2)) / CAST(l_quantity AS DECIMAL(10,0)) AS DECIMAL(10,2))"
        " AS unit_price",
        "CAST(l_extendedprice AS DECIMAL(10,2)) AS line_total", "to_date(l_shipdate) AS order_date",
    )


def change_log(spark: SparkSession, sf_dir: str, kinds: Sequence[str] = CHANGE_KINDS) -> DataFrame:
    """The wide entity log: one JSON text per entity row, each written once. Of five kinds, or of those asked for alone."""
    start = _payload_time("TIMESTAMP_NTZ'1995-01-01 00:00:00'")

    def text(kind: str) -> DataFrame:
        table, changed, fields = {
            "category": (
                categories, start, "'category_id', category_id, 'cat_name', name, 'parent_category_id', parent_category_id"),
            "user": (
                users, _payload_time("updated_at"),
                "'user_id', user_id, 'user_name', name, 'user_email', email, 'user_city', city, "
                f"'registered_date', registered_date, 'user_status', status, 'updated_at', {_payload_time('updated_at')}"),
            "product": (
                products, start,
                "'product_id', product_id, 'product_name', name, 'category_id', category_id, 'price', price, "
                f"'product_status', status, 'created_at', {_payload_time('created_at')}"),
            "order": (
                orders, _payload_time("created_at"),
                "'order_id', order_id, 'order_user_id', user_id, 'order_total', total, 'order_status', status, "
                f"'order_created_at', {_payload_time('created_at')}, 'order_date', order_date"),
            "order_item": (
                order_items, _payload_time("CAST(order_date AS TIMESTAMP_NTZ)"),
                "'order_item_id', order_item_id, 'order_item_order_id', order_id, 'product_id', product_id, "
                "'quantity', quantity, 'unit_price', unit_price, 'line_total', line_total, 'order_date', order_date"),
        }[kind]
        record = f"named_struct('entity_type', '{kind}', 'timestamp', {changed}, {fields})"
        return table(spark, sf_dir).selectExpr(f"explode(array(to_json({record}))) AS value")

    return reduce(DataFrame.unionByName, map(text, kinds))


def user_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log of users: a full row at registration and one per order placed.

    The status follows the order's; ``change_seq`` orders changes of one day.
    """
    people = users(spark, sf_dir)
    registered = people.selectExpr(
        "user_id", "name", "email", "city", "status", "updated_at AS change_ts", "CAST(-1 AS BIGINT) AS change_seq"
    )
    placed = _table(spark, sf_dir, "orders").selectExpr(
        "'U' || o_custkey AS user_id",
        "CASE WHEN o_orderstatus = 'F' THEN 'inactive' ELSE 'active' END AS status",
        "CAST(o_orderdate AS TIMESTAMP_NTZ) AS change_ts", "o_orderkey AS change_seq",
    )
    profile = people.select("user_id", "name", "email", "city")
    return registered.unionByName(placed.join(profile, "user_id"))
