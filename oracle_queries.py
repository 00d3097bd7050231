"""The suite's queries as DuckDB SQL, written independently of the Spark code.

Money is computed in whole cents, so that rounding half up is exact.
"""

from __future__ import annotations

# The typed events keep microseconds, the text of the log milliseconds.
EVENTS = """ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_type,
         'U' || user_id AS user_id, 'S' || user_id AS session_id,
         'P' || regexp_extract(props, '"k": *([0-9]+)', 1) AS product_id,
         ts AS event_timestamp,
         event_id AS id, user_id AS uid, value
  FROM events)"""

LOGGED = EVENTS.replace("ts AS event_timestamp", "date_trunc('millisecond', ts) AS event_timestamp")

BRONZE = LOGGED + """, br AS (
  SELECT event_id, event_type, user_id, session_id, product_id, event_timestamp,
         CASE event_type
           WHEN 'page_view' THEN '{"page":"/products/' || product_id || '"'
                || CASE WHEN uid % 5 > 1 THEN ',"referrer":"https://ref.example/' || (uid % 7) || '"' ELSE '' END || '}'
           WHEN 'add_to_cart' THEN '{"quantity":' || (id % 5 + 1) || ',"price":' || CAST(value AS VARCHAR) || '}'
           WHEN 'purchase' THEN '{"order_id":"ORD-' || event_id || '","total":' || CAST(value AS VARCHAR) || '}'
           ELSE '{}' END AS metadata,
         CAST(event_timestamp AS DATE) AS event_date,
         CASE WHEN event_type = 'page_view' THEN '/products/' || product_id END AS page_url,
         CASE WHEN event_type = 'page_view' AND uid % 5 > 1 THEN 'https://ref.example/' || (uid % 7) END AS referrer,
         event_timestamp + INTERVAL 1 SECOND AS ingestion_ts
  FROM ev), si AS (
  SELECT * FROM br WHERE event_type IN ('page_view', 'add_to_cart', 'purchase'))"""


def sessions(minutes: int = 30, keys: str = "session_id, user_id", end: str = "gap", events: str = EVENTS) -> str:
    tail = f" + INTERVAL {minutes} MINUTE" if end == "gap" else ""
    return events + f""", opened AS (
  SELECT *, CASE WHEN epoch_us(event_timestamp) - epoch_us(lag(event_timestamp) OVER (
         PARTITION BY {keys} ORDER BY event_timestamp)) <= {minutes * 60_000_000} THEN 0 ELSE 1 END AS opens
  FROM ev), runs AS (
  SELECT *, sum(opens) OVER (PARTITION BY {keys} ORDER BY event_timestamp, opens DESC
         ROWS UNBOUNDED PRECEDING) AS run
  FROM opened), grouped AS (
  SELECT {keys}, min(event_timestamp) AS session_start, max(event_timestamp){tail} AS session_end,
         count(*) AS event_count,
         count(*) FILTER (event_type = 'page_view') AS page_views,
         count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts,
         count(*) FILTER (event_type = 'purchase') AS purchases
  FROM runs GROUP BY {keys}, run), sm AS (
  SELECT {keys}, session_start, session_end,
         CAST((epoch_us(session_end) - epoch_us(session_start)) // 1000000 AS BIGINT) AS session_duration_seconds,
         event_count, page_views, add_to_carts, purchases, purchases > 0 AS converted,
         CAST(session_start AS DATE) AS session_date
  FROM grouped)"""


def funnel(size: str = "minute") -> str:
    return EVENTS + f""", fu AS (
  SELECT product_id, date_trunc('{size}', event_timestamp) AS window_start,
         date_trunc('{size}', event_timestamp) + INTERVAL 1 {size.upper()} AS window_end,
         count(*) FILTER (event_type = 'page_view') AS page_views,
         count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts,
         count(*) FILTER (event_type = 'purchase') AS purchases
  FROM ev GROUP BY ALL)"""


USERS_360 = sessions() + """, u360 AS (
  SELECT user_id, count(*) AS total_sessions, CAST(sum(event_count) AS BIGINT) AS total_events,
         CAST(sum(page_views) AS BIGINT) AS total_page_views, CAST(sum(add_to_carts) AS BIGINT) AS total_add_to_carts,
         CAST(sum(purchases) AS BIGINT) AS total_purchases,
         CAST(sum(session_duration_seconds) AS DOUBLE) / count(*) AS avg_session_duration_seconds,
         min(session_date) AS first_activity_date, max(session_date) AS last_activity_date,
         bool_or(converted) AS is_converted
  FROM sm GROUP BY user_id)"""

_ONCE = """SELECT event_id, event_type, user_id, session_id, product_id, event_timestamp FROM ev
      UNION ALL SELECT NULL, event_type, user_id, session_id, product_id, event_timestamp FROM ev
      WHERE event_type = 'add_to_cart'"""

SHOP = """us AS (
  SELECT 'U' || c_custkey AS user_id, c_name AS name, 'u' || c_custkey || '@example.com' AS email, n_name AS city,
         DATE '1999-08-02' + CAST(c_custkey * 37 % 730 AS INTEGER) AS registered_date,
         CASE WHEN c_acctbal < 0 THEN 'inactive' ELSE 'active' END AS status,
         CAST(DATE '1999-08-02' + CAST(c_custkey * 37 % 730 AS INTEGER) AS TIMESTAMP) AS updated_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey), ca AS (
  SELECT DISTINCT 'C-' || p_type AS category_id, p_type AS name, CAST(NULL AS VARCHAR) AS parent_category_id FROM part
  UNION ALL
  SELECT DISTINCT 'C-' || p_type || '-' || p_brand, p_brand || ' ' || p_type, 'C-' || p_type FROM part), pr AS (
  SELECT 'P' || p_partkey AS product_id, p_name AS name, 'C-' || p_type || '-' || p_brand AS category_id,
         p_retailprice AS price, 'active' AS status, TIMESTAMP '1995-01-01 00:00:00' AS created_at
  FROM part), od AS (
  SELECT 'O' || o_orderkey AS order_id, 'U' || o_custkey AS user_id,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'open' END AS status,
         o_orderdate AS created_at, CAST(o_orderdate AS DATE) AS order_date
  FROM orders), it AS (
  SELECT 'OI-' || l_orderkey || '-' || l_linenumber AS order_item_id, 'O' || l_orderkey AS order_id,
         'P' || l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         CAST(l_shipdate AS DATE) AS order_date
  FROM lineitem)"""

VERSIONS = SHOP + """, ver AS (
  SELECT user_id, name, email, city, status, updated_at AS change_ts, CAST(-1 AS BIGINT) AS change_seq FROM us
  UNION ALL
  SELECT us.user_id, name, email, city, CASE WHEN o_orderstatus = 'F' THEN 'inactive' ELSE 'active' END,
         o_orderdate, o_orderkey
  FROM orders JOIN us ON us.user_id = 'U' || o_custkey)"""


def half_up(part: str, whole: str, scale: int = 100) -> str:
    """part / whole rounded half up to 1/scale, from integers."""
    return (f"CASE WHEN {whole} <> 0 THEN CAST(((2 * {scale} * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole}))"
            f" AS DOUBLE) / {scale} END")


def percent(part: str, whole: str) -> str:
    return half_up(f"100 * ({part})", f"({whole})")


def average_price(cents: str, n: str) -> str:
    """Average of an amount in cents, in currency units rounded to cents."""
    return f"CASE WHEN {n} <> 0 THEN CAST(((2 * CAST({cents} AS HUGEINT) + {n}) // (2 * {n})) AS DOUBLE) / 100 END"


def categories_sold(days: int, label: str) -> str:
    return SHOP + f""", sold AS (
  SELECT {label} AS category, od.order_id, it.quantity, it.cents, od.cents AS order_cents
  FROM it JOIN od ON od.order_id = it.order_id JOIN pr ON pr.product_id = it.product_id
  JOIN ca ON ca.category_id = pr.category_id LEFT JOIN ca top ON top.category_id = ca.parent_category_id
  WHERE od.order_date >= DATE '2001-08-01' - {days})
SELECT category, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_items_sold,
       CAST(sum(cents) AS DOUBLE) / 100 AS total_revenue,
       {average_price('sum(order_cents)', 'count(*)')} AS avg_order_value
FROM sold GROUP BY category"""


def _pad(mark: int) -> str:
    """The suite's masking secret, filled up to a block and combined with the mark."""
    return bytes(b ^ mark for b in b"secret of the suite".ljust(64, b"\0")).hex()


def rules(table: str, source: str, checks: list[tuple[str, str, str]], prefix: str) -> str:
    parts = [
        f"SELECT '{table}' AS \"table\", '{rule}' AS rule, '{subject}' AS subject, v AS violations, v = 0 AS passed "
        f"FROM (SELECT CAST({count} AS BIGINT) AS v FROM {source})"
        for rule, subject, count in checks
    ]
    return f"WITH {prefix} " + " UNION ALL ".join(parts)


def _nulls(rule: str, columns: str) -> list[tuple[str, str, str]]:
    return [(rule, c, f"count(*) FILTER ({c} IS NULL)") for c in columns.split()]


_UNKNOWN_TYPE = ("enumeration", "event_type",
                 "count(*) FILTER (event_type NOT IN ('page_view', 'add_to_cart', 'purchase'))")
_COPIES = ("uniqueness", "event_id", "count(event_id) - count(DISTINCT event_id)")
_FUNNEL_COUNTS = "page_views add_to_carts purchases"

_ORPHANS = [
    ("categories.parent", "ca", "parent_category_id", "ca", "category_id"),
    ("products.category", "pr", "category_id", "ca", "category_id"),
    ("orders.user", "od", "user_id", "us", "user_id"),
    ("orders.active_user", "od", "user_id", "act", "user_id"),
    ("items.order", "it", "order_id", "od", "order_id"),
    ("items.product", "it", "product_id", "pr", "product_id"),
    ("events.user", "ev", "user_id", "us", "user_id"),
    ("events.active_user", "ev", "user_id", "act", "user_id"),
]


def _orphan(name: str, child: str, fk: str, parent: str, key: str) -> str:
    return (f"SELECT '{name}' AS relation, count(DISTINCT c.{fk}) AS orphan_keys, count(*) AS orphan_rows "
            f"FROM {child} c WHERE c.{fk} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{fk})")


_SM = ("session_id, user_id, session_start, session_end, session_duration_seconds, event_count, page_views, "
       "add_to_carts, purchases, converted, session_date")
_LAST_SESSION = """SELECT session_id, user_id, session_date, session_start, session_end, session_duration_seconds,
  CAST(event_count AS INTEGER) AS event_count, CAST(page_views AS INTEGER) AS page_views,
  CAST(add_to_carts AS INTEGER) AS add_to_carts, CAST(purchases AS INTEGER) AS purchases, converted
FROM sm {where} QUALIFY row_number() OVER (
  PARTITION BY session_id ORDER BY session_end DESC, session_start DESC, user_id DESC) = 1"""
_RANGES = """ra AS (SELECT * FROM (VALUES ('weeks', TIMESTAMP '2024-01-03 07:13:00', TIMESTAMP '2024-01-29 22:41:00'),
  ('night', TIMESTAMP '2024-01-09 23:31:00', TIMESTAMP '2024-01-10 00:31:00'),
  ('all', TIMESTAMP '1960-01-01 00:00:00', TIMESTAMP '2040-01-01 00:00:00')) AS v(range, low, high))
  SELECT range, product_id, CAST(sum(page_views) AS BIGINT) AS page_views, CAST(sum(add_to_carts) AS BIGINT) AS add_to_carts,
    CAST(sum(purchases) AS BIGINT) AS purchases FROM {windows}
  JOIN ra ON window_start >= low AND window_start < high GROUP BY 1, 2"""
_CLOSED = "WHERE {end} <= (SELECT date_trunc('millisecond', max(event_timestamp) - INTERVAL 5 SECOND) FROM ev)"
_BRONZE_COLUMNS = "event_id, event_type, user_id, session_id, product_id, event_timestamp, metadata, event_date"
_REJECTED = """SELECT event_id, event_type, 'event_type unknown' AS reasons FROM br
WHERE event_type NOT IN ('page_view', 'add_to_cart', 'purchase')"""
_ROLLUP_SUMS = """count(*) AS count, CAST(sum(page_views) AS BIGINT) AS total_page_views,
  CAST(sum(add_to_carts) AS BIGINT) AS total_add_to_carts, CAST(sum(purchases) AS BIGINT) AS total_purchases"""
_BUYERS = f"""count(DISTINCT od.order_id) AS total_orders,
  {average_price('sum(od.cents)', 'count(*)')} AS avg_order_value,
  CAST(sum(od.cents) AS DOUBLE) / 100 AS total_revenue"""


def _tables(*names_and_counts: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, n AS left_rows, n AS right_rows, CAST(0 AS BIGINT) AS only_left, "
        f"CAST(0 AS BIGINT) AS only_right FROM (SELECT count(*) AS n FROM {source})"
        for name, source in names_and_counts
    )


ORACLES: dict[str, str] = {
    "bronze_event_table": f"WITH {BRONZE} SELECT {_BRONZE_COLUMNS} FROM br",
    "unparseable_records": f"""WITH {EVENTS} SELECT
      substring('{{"event_id":"' || event_id || '","event_type":"error","user_id"', 1, 30) AS value,
      'unparseable' AS reason FROM ev WHERE event_type = 'error'""",
    "validated_event_table": f"WITH {BRONZE} SELECT * FROM si",
    "validated_strict": f"""WITH {EVENTS} SELECT event_id, event_type, user_id FROM ev
      WHERE event_type IN ('page_view', 'add_to_cart', 'purchase') AND user_id NOT LIKE '%0'""",
    "rejected_event_table": f"WITH {BRONZE} {_REJECTED}",
    "event_time_bounds": f"""WITH {EVENTS} SELECT event_id, event_type, event_timestamp FROM ev
      WHERE event_type IN ('page_view', 'add_to_cart', 'purchase')
      AND event_timestamp BETWEEN TIMESTAMP '2024-01-24 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00'""",
    "deduplicated_events": f"""WITH {EVENTS}
      SELECT event_id, event_type, user_id, session_id, product_id, event_timestamp FROM ev""",
    "user_session_table": f"""WITH {sessions()}
      SELECT session_id, user_id, session_start, session_end, event_count, session_date FROM sm""",
    "user_sessions_6h": f"""WITH {sessions(360)}
      SELECT session_id, user_id, session_start, session_end, event_count, session_date FROM sm""",
    "session_metric_table": f"WITH {sessions()} SELECT {_SM} FROM sm",
    "session_metrics_last_event": f"WITH {sessions(360, end='last_event')} SELECT {_SM} FROM sm",
    "session_metrics_per_user": f"WITH {sessions(120, keys='user_id')} SELECT * FROM sm",
    "sessions_ending_before": f"""WITH {sessions(360)} SELECT {_SM} FROM sm
      WHERE session_end <= TIMESTAMP '2024-01-16 00:00:00'""",
    "serving_session_table": f"WITH {sessions()} {_LAST_SESSION.format(where='')}",
    "product_funnel_1m": f"WITH {funnel()} SELECT * FROM fu",
    "product_funnel_1h": f"WITH {funnel('hour')} SELECT * FROM fu",
    "funnel_rollup_1d": f"WITH {funnel('day')} SELECT * FROM fu",
    "serving_funnel_table": f"WITH {funnel()} SELECT * FROM fu WHERE product_id IS NOT NULL",
    "user_360_table": f"WITH {USERS_360} SELECT * FROM u360",
    "user_360_incremental": f"WITH {USERS_360} SELECT * FROM u360",
    "cdc_categories": f"WITH {SHOP} SELECT * FROM ca",
    "cdc_users": f"WITH {SHOP} SELECT * FROM us",
    "cdc_products": f"WITH {SHOP} SELECT * FROM pr",
    "cdc_orders": f"""WITH {SHOP} SELECT order_id, user_id, CAST(cents AS DOUBLE) / 100 AS total, status,
      created_at, order_date FROM od""",
    "cdc_order_items": f"""WITH {SHOP} SELECT order_item_id, order_id, product_id, quantity,
      {average_price('cents', 'quantity')} AS unit_price, CAST(cents AS DOUBLE) / 100 AS line_total, order_date
      FROM it""",
    "serving_order_items": f"""WITH {SHOP} SELECT order_item_id, order_id, product_id, quantity,
      {average_price('cents', 'quantity')} AS unit_price, CAST(cents AS DOUBLE) / 100 AS line_total, order_date
      FROM it QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY order_date DESC, order_id DESC,
      product_id DESC, quantity DESC, {average_price('cents', 'quantity')} DESC, cents DESC) = 1""",
    "dim_current": f"""WITH {VERSIONS} SELECT * FROM ver QUALIFY row_number() OVER (
      PARTITION BY user_id ORDER BY change_ts DESC, change_seq DESC) = 1""",
    "dim_as_of": f"""WITH {VERSIONS} SELECT * FROM ver WHERE change_ts <= TIMESTAMP '1998-01-01 00:00:00'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY change_ts DESC, change_seq DESC) = 1""",
    "dim_history": f"""WITH {VERSIONS}, one AS (
      SELECT * FROM ver QUALIFY row_number() OVER (PARTITION BY user_id, change_ts ORDER BY change_seq DESC) = 1)
      SELECT user_id, city, status, change_seq, change_ts AS valid_from,
        lead(change_ts) OVER w AS valid_to, lead(change_ts) OVER w IS NULL AS is_current
      FROM one WINDOW w AS (PARTITION BY user_id ORDER BY change_ts)""",
    "orders_with_user_as_of": f"""WITH {VERSIONS}, one AS (
      SELECT * FROM ver QUALIFY row_number() OVER (PARTITION BY user_id, change_ts ORDER BY change_seq DESC) = 1)
      SELECT od.order_id, od.user_id, od.created_at, one.status AS user_status, one.change_ts AS status_since, one.change_seq
      FROM od ASOF LEFT JOIN one ON od.user_id = one.user_id AND od.created_at >= one.change_ts""",
    "events_with_user_as_of": f"""WITH {EVENTS}, one AS (
      SELECT user_id, product_id, event_timestamp FROM ev WHERE event_type = 'purchase'
      QUALIFY row_number() OVER (PARTITION BY user_id, event_timestamp ORDER BY event_id DESC) = 1)
      SELECT ev.event_id, ev.user_id, ev.event_timestamp, one.product_id AS last_product, one.event_timestamp AS bought_at
      FROM ev ASOF LEFT JOIN one ON ev.user_id = one.user_id AND ev.event_timestamp >= one.event_timestamp""",
    "category_tree_deep": """WITH n AS (
      SELECT n_nationkey AS k, n_name AS name, 'R-' || n_regionkey AS region, n_nationkey > 2 AS ok FROM nation)
      SELECT 'R-' || r_regionkey AS category_id, r_name AS name, CAST(NULL AS VARCHAR) AS parent_category_id,
        'R-' || r_regionkey AS root_category_id, 1 AS depth, true AS resolved FROM region
      UNION ALL SELECT 'N-' || k, name, CASE k WHEN 0 THEN 'R-none' WHEN 1 THEN 'N-2' WHEN 2 THEN 'N-1' ELSE region END,
        CASE WHEN ok THEN region END, CASE WHEN ok THEN 2 END, ok FROM n
      UNION ALL SELECT DISTINCT 'S-' || k || '-' || c_mktsegment, c_mktsegment, 'N-' || k,
        CASE WHEN ok THEN region END, CASE WHEN ok THEN 3 END, ok FROM customer JOIN n ON k = c_nationkey
      UNION ALL SELECT 'C-' || c_custkey, c_name, 'S-' || k || '-' || c_mktsegment,
        CASE WHEN ok THEN region END, CASE WHEN ok THEN 4 END, ok FROM customer JOIN n ON k = c_nationkey""",
    "changes_rejected": f"""WITH {SHOP} SELECT 'unparseable' AS reason, count(*) AS changes FROM us
      UNION ALL SELECT 'unknown entity', count(*) FROM ca""",
    "deduplicated_untimed": f"WITH {EVENTS} {_ONCE}",
    "stream_deduplicated": f"WITH {EVENTS} {_ONCE}",
    "stream_deduplicated_late": f"""WITH {BRONZE} SELECT event_id, event_type, user_id, product_id, event_timestamp FROM si
      UNION ALL SELECT event_id, event_type, user_id, product_id, event_timestamp + INTERVAL 10 DAY FROM si
      WHERE CAST(event_id AS BIGINT) % 5 = 2""",
    "funnel_any_range": f"WITH {funnel()}, {_RANGES.format(windows='fu')}",
    "stream_funnel_any_range": f"WITH {funnel()}, cl AS (SELECT * FROM fu {_CLOSED.format(end='window_end')}), {_RANGES.format(windows='cl')}",
    "replay_diff_buckets": f"""WITH {BRONZE} SELECT v.name AS table_name, n AS left_rows, n AS right_rows,
      CAST(v.odd AS BIGINT) AS only_left, CAST(v.odd AS BIGINT) AS only_right, v.odd AS unequal_buckets
      FROM (SELECT count(*) AS n FROM si), (VALUES ('same', 0), ('changed', 1)) AS v(name, odd)""",
    "stream_unreadable": f"""WITH {EVENTS} SELECT
      substring('{{"event_id":"' || event_id || '","event_type":"error","user_id"', 1, 30) AS value,
      'unparseable' AS reason FROM ev WHERE event_type = 'error'""",
    "stream_user_360": "WITH " + sessions(events=LOGGED) + USERS_360[len(sessions()):].replace(
        "FROM sm GROUP", f"FROM (SELECT * FROM sm {_CLOSED.format(end='session_end')}) GROUP") + " SELECT * FROM u360",
    "stream_serving_orders": f"""WITH {SHOP} SELECT order_id, user_id, CAST(cents AS DOUBLE) / 100 AS total, status,
      created_at, order_date FROM od""",
    "stream_serving_order_items": f"""WITH {SHOP} SELECT order_item_id, order_id, product_id, quantity,
      {average_price('cents', 'quantity')} AS unit_price, CAST(cents AS DOUBLE) / 100 AS line_total, order_date
      FROM it QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY order_date DESC, cents DESC, order_id DESC,
      product_id DESC, quantity DESC) = 1""",
    "serving_after_compaction": f"""WITH {VERSIONS} SELECT * FROM ver QUALIFY row_number() OVER (
      PARTITION BY user_id ORDER BY change_ts DESC, change_seq DESC) = 1""",
    "stream_lake_categories": f"WITH {SHOP} SELECT * FROM ca",
    "stream_lake_users": f"WITH {SHOP} SELECT * FROM us",
    "stream_lake_products": f"WITH {SHOP} SELECT * FROM pr",
    "stream_lake_orders": f"""WITH {SHOP} SELECT order_id, user_id, CAST(cents AS DOUBLE) / 100 AS total, status,
      created_at, order_date FROM od""",
    "stream_lake_order_items": f"""WITH {SHOP} SELECT order_item_id, order_id, product_id, quantity,
      {average_price('cents', 'quantity')} AS unit_price, CAST(cents AS DOUBLE) / 100 AS line_total, order_date
      FROM it""",
    "stream_validated": f"WITH {BRONZE} SELECT * EXCLUDE (ingestion_ts) FROM si",
    "stream_user_sessions": f"""WITH {sessions()} SELECT session_id, user_id, session_start, session_end, event_count, session_date
      FROM sm {_CLOSED.format(end='session_end')}""",
    "stream_sessions_from_log": f"WITH {sessions(events=LOGGED)} SELECT {_SM} FROM sm {_CLOSED.format(end='session_end')}",
    "stream_funnel_from_log": f"WITH {funnel()} SELECT * FROM fu {_CLOSED.format(end='window_end')}",
    "stream_serving_categories": f"WITH {SHOP} SELECT * FROM ca",
    "stream_serving_users": f"WITH {SHOP} SELECT * EXCLUDE (updated_at) FROM us",
    "stream_serving_products": f"WITH {SHOP} SELECT * EXCLUDE (created_at) FROM pr",
    "quality_declared": f"""WITH {sessions()} SELECT 'declared' AS "table", 'rowCount' AS rule, '*' AS subject,
        CAST(count(*) = 0 AS BIGINT) AS violations, count(*) > 0 AS passed FROM sm
      UNION ALL SELECT 'declared', 'freshness', 'session_start', NULL, NULL
      UNION ALL SELECT 'declared', 'custom', 'session_end >= session_start', count(*) FILTER (session_end < session_start),
        count(*) FILTER (session_end < session_start) = 0 FROM sm
      UNION ALL SELECT 'declared', 'custom', 'event_count > 1', count(*) FILTER (event_count <= 1),
        count(*) FILTER (event_count <= 1) = 0 FROM sm""",
    "category_tree": f"""WITH {SHOP} SELECT category_id, name, parent_category_id,
      coalesce(parent_category_id, category_id) AS root_category_id,
      CASE WHEN parent_category_id IS NULL THEN 1 ELSE 2 END AS depth, true AS resolved FROM ca""",
    "top_converting_products": f"""WITH {funnel()}, t AS (
      SELECT product_id, CAST(sum(page_views) AS BIGINT) AS total_page_views,
        CAST(sum(add_to_carts) AS BIGINT) AS total_add_to_carts, CAST(sum(purchases) AS BIGINT) AS total_purchases
      FROM fu WHERE window_start >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY product_id HAVING sum(page_views) >= 10)
      SELECT *, {percent('total_purchases', 'total_page_views')} AS conversion_rate_pct,
        {percent('total_add_to_carts', 'total_page_views')} AS add_to_cart_rate_pct
      FROM t ORDER BY conversion_rate_pct DESC NULLS FIRST, product_id LIMIT 10""",
    "hourly_event_volume": f"""WITH {sessions()} SELECT date_trunc('hour', session_start) AS hour_bucket,
      CAST(sum(page_views) AS BIGINT) AS page_views, CAST(sum(add_to_carts) AS BIGINT) AS add_to_carts,
      CAST(sum(purchases) AS BIGINT) AS purchases, count(DISTINCT session_id) AS unique_sessions,
      CAST(sum(page_views + add_to_carts + purchases) AS BIGINT) AS total_events
      FROM sm GROUP BY 1 ORDER BY 1 DESC LIMIT 48""",
    "revenue_by_category": f"WITH {categories_sold(30, 'ca.name')}",
    "revenue_by_root_category": f"WITH {categories_sold(365, 'coalesce(top.name, ca.name)')}",
    "avg_order_value_by_city": f"""WITH {SHOP} SELECT city, {_BUYERS},
      count(DISTINCT us.user_id) AS unique_buyers,
      {average_price('sum(od.cents)', 'count(DISTINCT us.user_id)')} AS revenue_per_buyer
      FROM od JOIN us ON us.user_id = od.user_id WHERE order_date >= DATE '2001-08-01' - 30
      GROUP BY city HAVING count(DISTINCT od.order_id) >= 5
      ORDER BY total_revenue DESC NULLS FIRST, city LIMIT 15""",
    "user_cohorts": f"""WITH {SHOP} SELECT CAST(date_trunc('month', registered_date) AS DATE) AS cohort_month,
      {_BUYERS}, count(DISTINCT us.user_id) AS cohort_size,
      {average_price('sum(od.cents)', 'count(DISTINCT us.user_id)')} AS revenue_per_user
      FROM us JOIN od ON od.user_id = us.user_id WHERE registered_date >= DATE '2001-08-01' - 365 GROUP BY 1""",
    "session_funnel": f"""WITH {sessions()}, f AS (SELECT count(*) AS total_sessions,
        count(*) FILTER (page_views > 0) AS sessions_with_pageview,
        count(*) FILTER (add_to_carts > 0) AS sessions_with_add_to_cart,
        count(*) FILTER (purchases > 0) AS sessions_with_purchase FROM sm)
      SELECT *, {percent('sessions_with_add_to_cart', 'sessions_with_pageview')} AS view_to_cart_pct,
        {percent('sessions_with_purchase', 'sessions_with_add_to_cart')} AS cart_to_purchase_pct,
        {percent('sessions_with_purchase', 'sessions_with_pageview')} AS overall_conversion_pct FROM f""",
    "federated_join": f"""WITH {sessions()}, {SHOP} SELECT city, count(DISTINCT sm.user_id) AS active_users,
      count(*) AS total_sessions, CAST(sum(purchases) AS BIGINT) AS total_purchases
      FROM sm JOIN us ON us.user_id = sm.user_id GROUP BY city""",
    "metric_session_by_date": f"""WITH {sessions()} SELECT CAST(session_date AS TIMESTAMP) AS session_date,
      {_ROLLUP_SUMS}, count(DISTINCT session_id) AS total_sessions,
      CAST(sum(session_duration_seconds) AS DOUBLE) / count(*) AS avg_session_duration_seconds,
      count(*) FILTER (converted) AS converted_sessions,
      CAST(count(*) FILTER (converted) AS DOUBLE) / count(*) AS conversion_rate FROM sm GROUP BY 1""",
    "metric_conversion_rate": f"""WITH {sessions()} SELECT converted,
      CAST(count(*) FILTER (converted) AS DOUBLE) / count(*) AS conversion_rate, count(*) AS count
      FROM sm WHERE page_views > 0 GROUP BY converted""",
    "metric_sessions_by_week": f"""WITH {sessions()} SELECT CAST(date_trunc('week', session_start) AS TIMESTAMP)
      AS session_start, count(DISTINCT session_id) AS total_sessions,
      CAST(sum(page_views) AS BIGINT) AS total_page_views FROM sm GROUP BY 1""",
    "metric_funnel_by_product": f"WITH {funnel()} SELECT product_id, {_ROLLUP_SUMS} FROM fu GROUP BY product_id",
    "metric_user360": f"""WITH {USERS_360} SELECT is_converted, count(*) AS count,
      CAST(sum(total_sessions) AS BIGINT) AS total_sessions, CAST(sum(total_events) AS BIGINT) AS total_events,
      CAST(sum(total_purchases) AS BIGINT) AS total_purchases,
      round(avg(avg_session_duration_seconds), 6) AS avg_session_duration_seconds FROM u360 GROUP BY is_converted""",
    "preagg_daily": f"""WITH {sessions()} SELECT CAST(session_date AS TIMESTAMP) AS session_date, converted,
      {_ROLLUP_SUMS}, CAST(sum(session_duration_seconds) AS BIGINT) AS avg_session_duration_seconds__sum,
      count(*) AS avg_session_duration_seconds__count, count(*) FILTER (converted) AS converted_sessions
      FROM sm GROUP BY 1, 2""",
    "preagg_distinct_within_bound": f"""WITH {sessions()}, g AS (
      SELECT 'week' AS grain, date_trunc('week', session_date) AS session_date, converted, session_id FROM sm UNION ALL
      SELECT 'month', date_trunc('month', session_date), converted, session_id FROM sm UNION ALL
      SELECT 'year', date_trunc('year', session_date), converted, session_id FROM sm)
      SELECT grain, CAST(session_date AS TIMESTAMP) AS session_date, converted, count(DISTINCT session_id) AS total_sessions,
        true AS within_bound FROM g GROUP BY 1, 2, 3""",
    "preagg_hit": f"""WITH {sessions()} SELECT converted, count(*) AS count, CAST(sum(purchases) AS BIGINT)
      AS total_purchases FROM sm WHERE converted GROUP BY 1""",
    "preagg_miss": f"""WITH {sessions()} SELECT CAST(date_trunc('month', session_date) AS TIMESTAMP) AS session_date,
      count(*) AS count, count(DISTINCT session_id) AS total_sessions FROM sm GROUP BY 1""",
    "preagg_month_from_day": f"""WITH {sessions()} SELECT CAST(date_trunc('month', session_date) AS TIMESTAMP)
      AS session_date, count(*) AS count, CAST(sum(page_views) AS BIGINT) AS total_page_views FROM sm GROUP BY 1""",
    "preagg_weekly_from_daily": f"""WITH {sessions()} SELECT CAST(date_trunc('week', session_date) AS TIMESTAMP)
      AS session_date, count(*) AS count, CAST(sum(purchases) AS BIGINT) AS total_purchases,
      CAST(count(*) FILTER (converted) AS DOUBLE) / count(*) AS conversion_rate,
      CAST(sum(session_duration_seconds) AS DOUBLE) / count(*) AS avg_session_duration_seconds
      FROM sm GROUP BY 1""",
    "quality_events": rules("bronze.raw_events", "br", [
        *_nulls("required", "event_id event_type user_id session_id event_timestamp event_date"),
        *_nulls("notNull", "event_id"), _UNKNOWN_TYPE,
        ("rowCount", "*", "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END"),
        ("freshness", "event_timestamp",
         "CASE WHEN max(event_timestamp) >= TIMESTAMP '2024-01-30 23:55:00' THEN 0 ELSE 1 END"),
        _COPIES], BRONZE),
    "quality_validated": rules("silver.validated_events", "si", [
        *_nulls("required", "event_id event_type user_id session_id event_timestamp event_date ingestion_ts"),
        *_nulls("notNull", "event_id event_type user_id session_id event_timestamp"), _UNKNOWN_TYPE,
        ("freshness", "event_timestamp",
         "CASE WHEN max(event_timestamp) >= TIMESTAMP '2024-01-30 23:50:00' THEN 0 ELSE 1 END"),
        _COPIES], BRONZE),
    "quality_sessions": rules("gold.session_metrics", "sm", [
        *_nulls("required", _SM.replace(",", "")), *_nulls("notNull", "session_id user_id"),
        ("custom", "duration_not_negative", "count(*) FILTER (session_duration_seconds < 0)")], sessions()),
    "quality_user_sessions": rules("silver.user_sessions", "sm", [
        *_nulls("required", "session_id user_id session_start session_end event_count session_date"),
        *_nulls("notNull", "session_id user_id session_start"),
        ("custom", "ends_after_start", "count(*) FILTER (session_end < session_start)")], sessions()),
    "quality_funnel": rules("gold.product_funnel_1m", "fu", [
        *_nulls("required", "product_id window_start window_end " + _FUNNEL_COUNTS),
        *_nulls("notNull", "product_id window_start"),
        ("custom", "window_not_empty", "count(*) FILTER (window_end <= window_start)")], funnel()),
    "quality_user_360": rules("gold.user_360", "u360", [
        *_nulls("required", "user_id total_sessions total_events total_page_views total_add_to_carts total_purchases "
                            "avg_session_duration_seconds first_activity_date last_activity_date is_converted"),
        *_nulls("notNull", "user_id total_sessions"),
        ("custom", "last_after_first", "count(*) FILTER (last_activity_date < first_activity_date)")], USERS_360),
    "fk_orphans": f"WITH {EVENTS}, {SHOP}, act AS (SELECT * FROM us WHERE status = 'active') "
                  + " UNION ALL ".join(_orphan(*o) for o in _ORPHANS),
    "order_reconciliation": f"""WITH {SHOP}, li AS (SELECT order_id, sum(cents) AS cents FROM it GROUP BY order_id)
      SELECT coalesce(od.order_id, li.order_id) AS order_id, CAST(od.cents AS DOUBLE) / 100 AS order_total,
        CAST(li.cents AS DOUBLE) / 100 AS items_total,
        CASE WHEN od.order_id IS NULL THEN 'no order' WHEN li.order_id IS NULL THEN 'no items' ELSE 'mismatch' END
        AS status
      FROM od FULL JOIN li ON od.order_id = li.order_id WHERE od.cents IS DISTINCT FROM li.cents""",
    "masked_sessions": f"""WITH {sessions()} SELECT session_id, sha256(unhex('{_pad(0x5C)}') ||
      unhex(sha256(unhex('{_pad(0x36)}') || encode(user_id)))) AS user_id, session_start, event_count FROM sm""",
    "schema_evolution": f"""WITH {EVENTS} SELECT CAST(event_timestamp AS DATE) AS event_date, count(*) AS events,
      count(*) FILTER (event_timestamp >= TIMESTAMP '2024-01-16 00:00:00') AS with_campaign,
      count(DISTINCT CASE WHEN event_timestamp >= TIMESTAMP '2024-01-16 00:00:00' THEN right(user_id, 1) END)
        AS campaigns
      FROM ev GROUP BY 1""",
    "event_log_as_of": f"""WITH {BRONZE} SELECT event_id, event_type, ingestion_ts, page_url, referrer FROM si
      WHERE ingestion_ts <= TIMESTAMP '2024-01-16 00:00:00'""",
    "event_log_growth": f"""WITH {BRONZE}, n AS (SELECT
        count(*) FILTER (ingestion_ts <= TIMESTAMP '2024-01-16 00:00:00') AS rows_before,
        count(*) FILTER (ingestion_ts <= TIMESTAMP '2024-01-31 00:00:00') AS rows_after FROM si)
      SELECT *, rows_after - rows_before AS rows_added FROM n""",
    "replay_diff": f"WITH {sessions(events=LOGGED)}, fu AS (SELECT DISTINCT product_id, date_trunc('minute', event_timestamp) "
                   "FROM ev), si AS (SELECT 1 FROM ev WHERE event_type IN ('page_view', 'add_to_cart', 'purchase')), "
                   "u360 AS (SELECT DISTINCT user_id FROM sm) " + _tables(
        ("bronze.raw_events", "ev"), ("silver.validated_events", "si"), ("silver.user_sessions", "sm"),
        ("gold.session_metrics", "sm"), ("gold.product_funnel_1m", "fu"), ("gold.user_360", "u360")),
    "reprocess_diff": f"WITH {sessions(events=LOGGED)}, {SHOP}, fu AS (SELECT DISTINCT product_id, date_trunc('minute', event_timestamp) "
                      "FROM ev), valid AS (SELECT 1 FROM ev WHERE event_type IN ('page_view', 'add_to_cart', 'purchase')), "
                      "invalid AS (SELECT 1 FROM ev WHERE event_type NOT IN ('page_view', 'add_to_cart', 'purchase')), none AS (SELECT 1 WHERE false), "
                      "served AS (SELECT DISTINCT session_id FROM sm), u360 AS (SELECT DISTINCT user_id FROM sm), "
                      "shown AS (SELECT 1 FROM fu WHERE product_id IS NOT NULL) " + _tables(
        ("bronze.raw_events", "ev"), ("silver.validated_events", "valid"), ("silver.user_sessions", "sm"),
        ("gold.session_metrics", "sm"), ("gold.product_funnel_1m", "fu"), ("gold.user_360", "u360"),
        ("bronze.rejected_text", "none"), ("silver.rejected_events", "invalid"), ("lake.rejected_changes", "none"),
        ("lake.categories", "ca"), ("lake.products", "pr"), ("serving.session_metrics", "served"), ("serving.product_funnel_1m", "shown"),
        ("serving.categories", "ca"), ("serving.products", "pr")),
    "stream_bronze": f"WITH {BRONZE} SELECT {_BRONZE_COLUMNS} FROM br",
    "stream_rejected": f"WITH {BRONZE} {_REJECTED}",
    "stream_sessions": f"WITH {sessions()} SELECT {_SM} FROM sm {_CLOSED.format(end='session_end')}",
    "stream_serving_sessions": f"WITH {sessions(360)} "
                               + _LAST_SESSION.format(where=_CLOSED.format(end="session_end")),
    "stream_funnel": f"WITH {funnel()} SELECT * FROM fu {_CLOSED.format(end='window_end')}",
    "stream_batch_diff": f"WITH {sessions(360)}, closed AS (SELECT 1 FROM sm {_CLOSED.format(end='session_end')}) "
                         + _tables(("session_metrics", "closed")),
}
