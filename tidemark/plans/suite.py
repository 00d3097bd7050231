"""Named queries over the given tables, one per operator or report."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import contracts
from ..functions.time import moment
from ..operators import changes as entity
from ..operators import quality
from ..operators.compare import compare, compare_by_digests, digests
from ..operators.events import (
    bronze_events, dedupe_events, rejected_events, strict_values, valid_events, validated_events,
)
from ..operators.funnel import coarser_funnel, product_funnel, serving_funnel
from ..operators.hierarchy import category_roots
from ..operators.keyed import last_per_key
from ..operators.sessions import serving_sessions, session_metrics, user_sessions
from ..operators.users import merge_states, user_360, user_state
from ..session import streaming_session, work_path
from ..sources import warehouse as wh
from ..sources.logs import parse_changes, parse_events, read_text, rejected_changes, rejected_text
from ..sources.tables import read_lake
from ..streaming import jobs, sinks
from . import metrics, replay, reports

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MINUTE, HOUR, DAY = timedelta(minutes=1), timedelta(hours=1), timedelta(days=1)
DIM_AS_OF = datetime(1998, 1, 1)
LOG_SPLIT = datetime(2024, 1, 16)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE, for readers without a decimal type."""
    return df.select([
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema
    ])


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
    return fn


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_events(parse_events(wh.click_log(spark, sf_dir)))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated events that were processed one second after they happened."""
    arrived = F.col("event_timestamp") + F.expr("INTERVAL '1' SECOND")
    return validated_events(_bronze(spark, sf_dir), ingestion_ts=arrived)


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_metrics(wh.click_events(spark, sf_dir))


def _funnel(spark: SparkSession, sf_dir: str, size: timedelta = MINUTE) -> DataFrame:
    return product_funnel(wh.click_events(spark, sf_dir), size)


# --- events -------------------------------------------------------------------


@query
def bronze_event_table(spark, sf_dir):
    return _bronze(spark, sf_dir)


@query
def unparseable_records(spark, sf_dir):
    """Error events arrive cut off after thirty characters."""
    log = wh.click_log(spark, sf_dir)
    cut = F.when(F.col("value").contains('"event_type":"error"'), F.substring("value", 1, 30))
    return rejected_text(log.select(F.coalesce(cut, F.col("value")).alias("value")))


@query
def validated_event_table(spark, sf_dir):
    return _silver(spark, sf_dir)


@query
def validated_strict(spark, sf_dir):
    """Ids padded with blanks and upper-cased types pass once they are cleaned."""
    noisy = wh.click_events(spark, sf_dir).withColumns({
        "event_type": F.upper("event_type"),
        "user_id": F.when(F.col("user_id").endswith("0"), F.lit("  ")).otherwise(F.concat("user_id", F.lit(" "))),
    })
    return valid_events(strict_values(noisy)).select("event_id", "event_type", "user_id")


@query
def rejected_event_table(spark, sf_dir):
    rejected = rejected_events(_bronze(spark, sf_dir))
    return rejected.select("event_id", "event_type", F.array_join("reject_reasons", "; ").alias("reasons"))


@query
def event_time_bounds(spark, sf_dir):
    recent = valid_events(wh.click_events(spark, sf_dir), as_of=wh.EVENTS_AS_OF)
    return recent.select("event_id", "event_type", "event_timestamp")


@query
def deduplicated_events(spark, sf_dir):
    """The log with every purchase delivered a second time, later."""
    events = wh.click_events(spark, sf_dir)
    again = events.where(F.col("event_type") == "purchase").withColumn(
        "event_timestamp", F.col("event_timestamp") + F.expr("INTERVAL '3' SECOND")
    )
    return dedupe_events(events.unionByName(again))


def _odd_copies(events: DataFrame, untimed: bool) -> DataFrame:
    """Every event, each cart event once more without an id, each purchase once more as it is or without its time."""
    return events.selectExpr(
        "*", "explode(CASE WHEN event_type IN ('add_to_cart', 'purchase') THEN array(0, 1) ELSE array(0) END) AS copy"
    ).selectExpr(
        "CASE WHEN copy = 1 AND event_type = 'add_to_cart' THEN NULL ELSE event_id END AS event_id",
        "event_type", "user_id", "session_id", "product_id",
        f"CASE WHEN {untimed} AND copy = 1 AND event_type = 'purchase' THEN NULL ELSE event_timestamp END AS event_timestamp",
    )


@query
def deduplicated_untimed(spark, sf_dir):
    """A copy without a time never replaces the event, and events without an id all stay."""
    return dedupe_events(_odd_copies(wh.click_events(spark, sf_dir), untimed=True))


# --- sessions, funnel, users --------------------------------------------------


@query
def user_session_table(spark, sf_dir):
    return user_sessions(_sessions(spark, sf_dir))


@query
def user_sessions_6h(spark, sf_dir):
    return user_sessions(session_metrics(wh.click_events(spark, sf_dir), gap=6 * HOUR))


@query
def session_metric_table(spark, sf_dir):
    return _sessions(spark, sf_dir)


@query
def session_metrics_last_event(spark, sf_dir):
    return session_metrics(wh.click_events(spark, sf_dir), gap=6 * HOUR, end="last_event")


@query
def session_metrics_per_user(spark, sf_dir):
    return session_metrics(wh.click_events(spark, sf_dir), keys=["user_id"], gap=2 * HOUR)


@query
def sessions_ending_before(spark, sf_dir):
    """A filter on session bounds selects whole sessions."""
    sessions = session_metrics(wh.click_events(spark, sf_dir), gap=6 * HOUR)
    return sessions.where(F.col("session_end") <= moment(LOG_SPLIT))


@query
def serving_session_table(spark, sf_dir):
    return last_per_key(serving_sessions(_sessions(spark, sf_dir)), ["session_id"], jobs.SESSION_ORDER)


@query
def product_funnel_1m(spark, sf_dir):
    return _funnel(spark, sf_dir)


@query
def product_funnel_1h(spark, sf_dir):
    return _funnel(spark, sf_dir, HOUR)


@query
def funnel_rollup_1d(spark, sf_dir):
    return coarser_funnel(_funnel(spark, sf_dir), MINUTE, DAY)


@query
def serving_funnel_table(spark, sf_dir):
    funnel = serving_funnel(_funnel(spark, sf_dir))
    return last_per_key(funnel, ["product_id", "window_start"], ["window_end"])


@query
def user_360_table(spark, sf_dir):
    return user_360(user_state(_sessions(spark, sf_dir)))


@query
def user_360_incremental(spark, sf_dir):
    """The state of the first half of the log, merged with the sessions of the second."""
    sessions = _sessions(spark, sf_dir)
    early = F.col("session_date") < F.lit(LOG_SPLIT.date())
    return user_360(merge_states(user_state(sessions.where(early)), user_state(sessions.where(~early))))


# --- entity changes -----------------------------------------------------------


def _route_query(kind: str, name: str) -> None:
    def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
        return entity.route(parse_changes(wh.change_log(spark, sf_dir), entities=[kind]), kind)

    routed.__name__ = name
    query(routed)


_route_query("category", "cdc_categories")
_route_query("user", "cdc_users")
_route_query("product", "cdc_products")
_route_query("order", "cdc_orders")
_route_query("order_item", "cdc_order_items")


@query
def serving_order_items(spark, sf_dir):
    """One row per line id, the last by order date."""
    items = entity.route(parse_changes(wh.change_log(spark, sf_dir), entities=["order_item"]), "order_item")
    return last_per_key(items, ["order_item_id"], ["order_date"])


@query
def dim_current(spark, sf_dir):
    return entity.current(wh.user_versions(spark, sf_dir), "user_id", ("change_ts", "change_seq"))


@query
def dim_as_of(spark, sf_dir):
    log = wh.user_versions(spark, sf_dir)
    return entity.as_of(log, "user_id", DIM_AS_OF, ("change_ts", "change_seq"))


@query
def dim_history(spark, sf_dir):
    log = wh.user_versions(spark, sf_dir)
    ranges = entity.history(log, "user_id", tie_break=["change_seq"])
    return ranges.select("user_id", "city", "status", "change_seq", "valid_from", "valid_to", "is_current")


@query
def orders_with_user_as_of(spark, sf_dir):
    """Orders with the user's status at their own time; cells of a month hold several changes of a user."""
    orders = wh.orders(spark, sf_dir).select("order_id", "user_id", "created_at")
    log = wh.user_versions(spark, sf_dir).select("user_id", "status", "change_ts", "change_seq")
    dated = entity.at_own_time(orders, log, "user_id", "created_at", tie_break=["change_seq"], cell=30 * DAY)
    return dated.select("order_id", "user_id", "created_at", F.col("version.status").alias("user_status"),
                        F.col("version.change_ts").alias("status_since"), F.col("version.change_seq").alias("change_seq"))


@query
def events_with_user_as_of(spark, sf_dir):
    """Events with the last one of the same user that bought something, before or at the same time."""
    events = wh.click_events(spark, sf_dir)
    bought = events.where("event_type = 'purchase'").select("user_id", "product_id", "event_timestamp", "event_id")
    dated = entity.at_own_time(events.select("event_id", "user_id", "event_timestamp"), bought, "user_id", "event_timestamp",
                               changed="event_timestamp", tie_break=["event_id"], cell=DAY)
    return dated.select("event_id", "user_id", "event_timestamp", F.col("version.product_id").alias("last_product"),
                        F.col("version.event_timestamp").alias("bought_at"))


@query
def category_tree(spark, sf_dir):
    return category_roots(wh.categories(spark, sf_dir))


@query
def category_tree_deep(spark, sf_dir):
    return category_roots(wh.sales_areas(spark, sf_dir))


@query
def changes_rejected(spark, sf_dir):
    """Users arrive cut off, and categories under an unknown name."""
    log = wh.change_log(spark, sf_dir)
    text = F.col("value")
    spoilt = F.when(text.contains('"entity_type":"user"'), F.substring(text, 1, 40)).when(
        text.contains('"entity_type":"category"'), F.replace(text, F.lit('"category"'), F.lit('"vendor"'))).otherwise(text)
    return rejected_changes(log.select(spoilt.alias("value"))).groupBy("reason").agg(F.count("*").alias("changes"))


# --- reports ------------------------------------------------------------------


@query
def top_converting_products(spark, sf_dir):
    return reports.top_converting_products(_funnel(spark, sf_dir), wh.EVENTS_AS_OF, lookback=30 * DAY)


@query
def hourly_event_volume(spark, sf_dir):
    return reports.hourly_event_volume(_sessions(spark, sf_dir))


def _shop(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return (wh.order_items(spark, sf_dir), wh.orders(spark, sf_dir),
            wh.products(spark, sf_dir), wh.categories(spark, sf_dir))


@query
def revenue_by_category(spark, sf_dir):
    return reports.revenue_by_category(*_shop(spark, sf_dir), wh.ORDERS_AS_OF)


@query
def revenue_by_root_category(spark, sf_dir):
    return reports.revenue_by_root_category(*_shop(spark, sf_dir), wh.ORDERS_AS_OF, lookback=365 * DAY)


@query
def avg_order_value_by_city(spark, sf_dir):
    return reports.avg_order_value_by_city(wh.orders(spark, sf_dir), wh.users(spark, sf_dir), wh.ORDERS_AS_OF)


@query
def user_cohorts(spark, sf_dir):
    return reports.user_cohorts(wh.users(spark, sf_dir), wh.orders(spark, sf_dir), wh.ORDERS_AS_OF)


@query
def session_funnel(spark, sf_dir):
    return reports.session_funnel(_sessions(spark, sf_dir))


@query
def federated_join(spark, sf_dir):
    """Lake sessions with the users of a serving store filled by the upsert sink."""
    path = work_path(spark, "serving-users")
    order = ("change_ts", "change_seq")
    sinks.upsert_batch(wh.user_versions(spark, sf_dir), path, ["user_id"], order, "load-0")
    serving = sinks.read_serving(spark, path, ["user_id"], order)
    return reports.sessions_by_city(_sessions(spark, sf_dir), serving)


# --- metrics ------------------------------------------------------------------


@query
def metric_session_by_date(spark, sf_dir):
    wanted = ["count", "total_sessions", "avg_session_duration_seconds", "total_page_views",
              "total_add_to_carts", "total_purchases", "converted_sessions", "conversion_rate"]
    return metrics.query(_sessions(spark, sf_dir), "session_metrics", wanted, ["session_date"], grain="day")


@query
def metric_conversion_rate(spark, sf_dir):
    return metrics.query(
        _sessions(spark, sf_dir), "session_metrics", ["conversion_rate", "count"], ["converted"],
        where=F.col("page_views") > 0,
    )


@query
def metric_sessions_by_week(spark, sf_dir):
    return metrics.query(
        _sessions(spark, sf_dir), "session_metrics", ["total_sessions", "total_page_views"],
        ["session_start"], grain="week",
    )


@query
def metric_funnel_by_product(spark, sf_dir):
    wanted = ["count", "total_page_views", "total_add_to_carts", "total_purchases"]
    return metrics.query(_funnel(spark, sf_dir), "product_funnel_1m", wanted, ["product_id"])


@query
def metric_user360(spark, sf_dir):
    gold = user_360(user_state(_sessions(spark, sf_dir)))
    wanted = ["count", "total_sessions", "total_events", "total_purchases", "avg_session_duration_seconds"]
    result = metrics.query(gold, "user_360", wanted, ["is_converted"])
    return result.withColumn("avg_session_duration_seconds", F.round("avg_session_duration_seconds", 6))


@query
def preagg_daily(spark, sf_dir):
    return metrics.pre_aggregate(_sessions(spark, sf_dir), "session_metrics", ["session_date", "converted"], "day")


@query
def preagg_weekly_from_daily(spark, sf_dir):
    daily = metrics.pre_aggregate(_sessions(spark, sf_dir), "session_metrics", ["session_date", "converted"], "day")
    wanted = ["count", "total_purchases", "conversion_rate", "avg_session_duration_seconds"]
    return metrics.query_rollup(daily, "session_metrics", wanted, ["session_date"], grain="week")


def _stored_daily(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sessions, and their stored totals by day and outcome."""
    sessions = _sessions(spark, sf_dir)
    daily = metrics.pre_aggregate(sessions, "session_metrics", ["session_date", "converted"], "day")
    path = metrics.store_rollup(daily, work_path(spark, "rollups"), "session_metrics", "daily")
    return sessions, spark.read.parquet(path)


@query
def preagg_hit(spark, sf_dir):
    """Answered from the stored totals; the gold table given here is empty."""
    sessions, daily = _stored_daily(spark, sf_dir)
    return metrics.answer(sessions.limit(0), "session_metrics", ["count", "total_purchases"], ["converted"],
                          where="converted", rollups=[daily])


@query
def preagg_miss(spark, sf_dir):
    """Distinct counts cannot be made of totals, so the gold table answers."""
    sessions, daily = _stored_daily(spark, sf_dir)
    return metrics.answer(sessions, "session_metrics", ["count", "total_sessions"], ["session_date"], grain="month",
                          rollups=[daily.limit(0)])


@query
def preagg_month_from_day(spark, sf_dir):
    sessions, daily = _stored_daily(spark, sf_dir)
    return metrics.answer(sessions.limit(0), "session_metrics", ["count", "total_page_views"], ["session_date"],
                          grain="month", rollups=[daily])


def _sketched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sessions, and their stored totals by day and outcome, with sketches of the ids."""
    sessions = _sessions(spark, sf_dir)
    daily = metrics.pre_aggregate(sessions, "session_metrics", ["session_date", "converted"], "day", sketches=True)
    path = metrics.store_rollup(daily, work_path(spark, "rollups"), "session_metrics", "sketched")
    return sessions, spark.read.parquet(path)


@query
def preagg_distinct_within_bound(spark, sf_dir):
    """Distinct sessions by week, month or year and outcome, exact, and whether the stored sketches come near enough."""
    sessions, daily = _sketched(spark, sf_dir)
    dimensions, found = ["session_date", "converted"], []
    for grain in ("week", "month", "year"):
        exact = metrics.query(sessions, "session_metrics", ["total_sessions"], dimensions, grain=grain)
        near = metrics.answer(sessions.limit(0), "session_metrics", ["total_sessions"], dimensions, grain=grain,
                              rollups=[daily], approximate=True).withColumnRenamed("total_sessions", "estimate")
        off = F.abs(F.col("estimate") - F.col("total_sessions")) / F.col("total_sessions")
        found.append(exact.join(near, dimensions, "left").select(
            F.lit(grain).alias("grain"), *dimensions, "total_sessions",
            F.coalesce(off <= metrics.sketch_bound(), F.lit(False)).alias("within_bound")))
    return found[0].unionByName(found[1]).unionByName(found[2])


# --- contracts and quality ----------------------------------------------------


@query
def quality_events(spark, sf_dir):
    return quality.check(_bronze(spark, sf_dir), contracts.load("bronze.raw_events"), wh.EVENTS_AS_OF)


@query
def quality_validated(spark, sf_dir):
    return quality.check(_silver(spark, sf_dir), contracts.load("silver.validated_events"), wh.EVENTS_AS_OF)


@query
def quality_sessions(spark, sf_dir):
    return quality.check(_sessions(spark, sf_dir), contracts.load("gold.session_metrics"))


@query
def quality_user_sessions(spark, sf_dir):
    return quality.check(user_sessions(_sessions(spark, sf_dir)), contracts.load("silver.user_sessions"))


@query
def quality_funnel(spark, sf_dir):
    return quality.check(_funnel(spark, sf_dir), contracts.load("gold.product_funnel_1m"))


@query
def quality_user_360(spark, sf_dir):
    gold = user_360(user_state(_sessions(spark, sf_dir)))
    return quality.check(gold, contracts.load("gold.user_360"))


@query
def fk_orphans(spark, sf_dir):
    """The declared foreign keys, and orders against active users only, which do have orphans."""
    items, orders, products, categories = _shop(spark, sf_dir)
    users, events = wh.users(spark, sf_dir), wh.click_events(spark, sf_dir)
    active = users.where(F.col("status") == "active")
    return quality.integrity([
        ("categories.parent", categories, "parent_category_id", categories, "category_id"),
        ("products.category", products, "category_id", categories, "category_id"),
        ("orders.user", orders, "user_id", users, "user_id"),
        ("orders.active_user", orders, "user_id", active, "user_id"),
        ("items.order", items, "order_id", orders, "order_id"),
        ("items.product", items, "product_id", products, "product_id"),
        ("events.user", events, "user_id", users, "user_id"),
        ("events.active_user", events, "user_id", active, "user_id"),
    ])


@query
def order_reconciliation(spark, sf_dir):
    return quality.reconcile_orders(wh.orders(spark, sf_dir), wh.order_items(spark, sf_dir))


@query
def quality_declared(spark, sf_dir):
    """Rules as other contracts write them: conditions as descriptions, freshness without a column or a time."""
    declared = contracts.Contract.from_dict({
        "id": "declared", "schema": contracts.load("gold.session_metrics").columns,
        "quality": [
            {"type": "rowCount", "mustBeGreaterThan": 0}, {"type": "freshness", "interval": "5m"},
            {"type": "custom", "description": "session_end >= session_start"},
            {"type": "custom", "description": "event_count > 1"},
        ],
    })
    return quality.check(_sessions(spark, sf_dir), declared).where("rule <> 'required'")


@query
def masked_sessions(spark, sf_dir):
    return contracts.mask(_sessions(spark, sf_dir), contracts.load("gold.session_metrics"), b"secret of the suite").select(
        "session_id", "user_id", "session_start", "event_count"
    )


# --- table versions and replay ------------------------------------------------


@query
def schema_evolution(spark, sf_dir):
    """Files written before a column was added read it as NULL."""
    path = work_path(spark, "evolving")
    events = wh.click_events(spark, sf_dir).withColumn("event_date", F.to_date("event_timestamp"))
    later = F.col("event_date") >= F.lit(LOG_SPLIT.date())
    campaign = F.concat(F.lit("C"), F.substring("user_id", -1, 1))
    sinks.append_batch(events.where(~later), path, "v1", ["event_date"])
    sinks.append_batch(events.where(later).withColumn("campaign_id", campaign), path, "v2", ["event_date"])
    base = contracts.load("bronze.raw_events")
    evolved = contracts.Contract(
        id=base.id, columns=(*base.columns, {"name": "campaign_id", "type": "STRING"}),
        partition_by=base.partition_by,
    )
    if contracts.breaking_changes(base, evolved):
        raise ValueError("an added optional column must be compatible")
    return read_lake(spark, path, evolved).groupBy("event_date").agg(
        F.count("*").alias("events"),
        F.count("campaign_id").alias("with_campaign"),
        F.count_distinct("campaign_id").alias("campaigns"),
    )


@query
def event_log_as_of(spark, sf_dir):
    log = replay.log_as_of(_silver(spark, sf_dir), LOG_SPLIT)
    return log.select("event_id", "event_type", "ingestion_ts", "page_url", "referrer")


@query
def event_log_growth(spark, sf_dir):
    return replay.growth(_silver(spark, sf_dir), LOG_SPLIT, wh.EVENTS_AS_OF)


def _stored(log: DataFrame, name: str) -> DataFrame:
    """A log that several passes read: its text is made once."""
    path = work_path(log.sparkSession, name)
    log.write.parquet(path)
    return log.sparkSession.read.schema(log.schema).parquet(path)


@query
def replay_diff(spark, sf_dir):
    """Two rebuilds of all layered tables from the raw log."""
    log = _stored(wh.click_log(spark, sf_dir), "click-log")
    arrived = F.col("event_timestamp") + F.expr("INTERVAL '1' SECOND")
    first = replay.rebuild(log, work_path(spark, "lake"), arrived)
    second = replay.rebuild(log, work_path(spark, "lake"), arrived)
    diff = replay.compare_tables(replay.read_tables(spark, first), replay.read_tables(spark, second))
    return diff.withColumnRenamed("table", "table_name")


@query
def replay_diff_buckets(spark, sf_dir):
    """The stored silver table against a copy with one changed event, and against itself, by digests stored with each."""
    silver, tables, sums = _silver(spark, sf_dir), [], []
    least = silver.agg(F.min("event_id")).first()[0]
    changed = silver.withColumn("product_id", F.when(F.col("event_id") == least, F.lit("changed")).otherwise(F.col("product_id")))
    for rows in (silver, changed):
        path = work_path(spark, "compared")
        sinks.write_table(rows, f"{path}/rows")
        tables.append(spark.read.parquet(f"{path}/rows"))
        sinks.write_table(digests(tables[-1], ["event_id"]), f"{path}/digests")
        sums.append(spark.read.parquet(f"{path}/digests"))
    diffs = [compare_by_digests(name, tables[0], tables[i], ["event_id"], left_digests=sums[0], right_digests=sums[i])
             for i, name in enumerate(("same", "changed"))]
    return diffs[0].unionByName(diffs[1]).withColumnRenamed("table", "table_name")


@query
def reprocess_diff(spark, sf_dir):
    """The tables of events, categories and products, rebuilt from both logs, against the version that was live before."""
    root, found = work_path(spark, "versions"), []
    arrived = F.col("event_timestamp") + F.expr("INTERVAL '1' SECOND")
    clicks, changes = _stored(wh.click_log(spark, sf_dir), "click-log"), _stored(wh.change_log(spark, sf_dir), "change-log")
    for _ in range(2):
        replay.reprocess(clicks, changes, root,
                         lambda diff: found.append(diff) is None, ("category", "product"), ingestion_ts=arrived)
    return found[0].withColumnRenamed("table", "table_name")


# --- streams ------------------------------------------------------------------


def _drain(job: Callable[..., object], spark: SparkSession, source: DataFrame, **options) -> str:
    """Run a job over all there is; returns the root of its tables."""
    root = work_path(spark, job.__name__)
    running = job(source, root, f"{root}/checkpoint", trigger=jobs.DRAIN, **options)
    running.awaitTermination()
    return root


def _stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = streaming_session(spark)
    return wh.click_log(session, sf_dir, wh.events_stream(session, sf_dir))


def _stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = streaming_session(spark)
    return wh.click_events(session, sf_dir, wh.events_stream(session, sf_dir))


@query
def stream_bronze(spark, sf_dir):
    root = _drain(jobs.start_bronze, spark, _stream_log(spark, sf_dir))
    return read_lake(spark, f"{root}/bronze/raw_events", contracts.load("bronze.raw_events"))


@query
def stream_deduplicated(spark, sf_dir):
    """The streamed equal of ``deduplicated_untimed``, whose copies all have a time."""
    root = _drain(jobs.start_deduplicated, spark, _odd_copies(_stream_events(spark, sf_dir), untimed=False))
    return spark.read.parquet(f"{root}/silver/unique_events").drop(sinks.BATCH)


@query
def stream_deduplicated_late(spark, sf_dir):
    """The silver job, restarted for each of four parts of the log.

    Of each five events one comes again a part later, one again with a time two days later, and one with a time ten days
    later, which is longer than ids are remembered.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path, root, session = work_path(spark, "log"), work_path(spark, "unique"), streaming_session(spark)
    kind = F.pmod("event_id", F.lit(5))
    again = F.when(kind == 1, F.array(F.lit(0), F.lit(2))).when(kind == 2, F.array(F.lit(0), F.lit(10))).otherwise(F.array(F.lit(0)))
    moved = events.withColumn("days", F.explode(again))
    moved = moved.withColumn("ts", F.col("ts") + F.expr("make_dt_interval(days)")).drop("days")
    bounds = [datetime(2023, 1, 1), datetime(2024, 1, 11), datetime(2024, 1, 21), datetime(2030, 1, 1), datetime(2030, 1, 2)]
    for i in range(4):
        own = moved.where((F.col("ts") >= moment(bounds[i])) & (F.col("ts") < moment(bounds[i + 1])))
        if i:
            own = own.unionByName(events.where(
                (kind == 0) & (F.col("ts") >= moment(bounds[i - 1])) & (F.col("ts") < moment(bounds[i]))))
        wh.click_log(spark, sf_dir, own).write.text(f"{path}/{i}")
        log = read_text(session, f"{path}/*", streaming=True)
        jobs.start_validated(log, root, f"{root}/checkpoint", jobs.DRAIN, remember=7 * DAY).awaitTermination()
    good = read_lake(spark, f"{root}/silver/validated_events", contracts.load("silver.validated_events"))
    return good.select("event_id", "event_type", "user_id", "product_id", "event_timestamp")


@query
def stream_unreadable(spark, sf_dir):
    """Error events arrive cut off; the bronze job keeps their text."""
    cut = F.when(F.col("value").contains('"event_type":"error"'), F.substring("value", 1, 30))
    log = _stream_log(spark, sf_dir).select(F.coalesce(cut, F.col("value")).alias("value"))
    root = _drain(jobs.start_bronze, spark, log)
    return spark.read.parquet(f"{root}/bronze/rejected_text").drop(sinks.BATCH)


def _serving_query(kind: str) -> None:
    table, key, _ = entity.TABLES[kind]

    def served(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Half of the changes, the other half, and a third of all once more, as a stream of several batches."""
        log, part = wh.change_log(spark, sf_dir, [kind]), F.xxhash64("value")
        path = work_path(spark, "changes")
        for i, some in enumerate((part % 2 == 0, part % 2 != 0, part % 3 == 0)):
            log.where(some).write.text(f"{path}/{i}")
        session = streaming_session(spark)
        source = read_text(session, f"{path}/*", streaming=True, maxFilesPerTrigger="4")
        root = _drain(jobs.start_changes, spark, source, entities=[kind], lake=False)
        return sinks.read_serving(spark, f"{root}/serving/{table}", [key], [entity.CHANGED]).drop(entity.CHANGED)

    served.__name__ = f"stream_serving_{table}"
    query(served)


for _kind in ("category", "user", "product", "order"):
    _serving_query(_kind)


@query
def stream_serving_order_items(spark, sf_dir):
    """Line ids repeat on one date, so the log has positions, as a topic does; three batches, one of them old changes."""
    position = F.round(F.get_json_object("value", "$.line_total").cast("decimal(20,2)") * 100).cast("long")
    log = wh.change_log(spark, sf_dir, ["order_item"]).select(
        "value", F.lit(0).alias("log_partition"), position.alias("log_offset"))
    path, part, session = work_path(spark, "changes"), F.xxhash64("value"), streaming_session(spark)
    for i, some in enumerate((part % 2 == 0, part % 2 != 0, part % 3 == 0)):
        log.where(some).write.parquet(f"{path}/{i}")
    source = session.readStream.schema(log.schema).option("maxFilesPerTrigger", "4").parquet(f"{path}/*")
    root = _drain(jobs.start_changes, spark, source, entities=["order_item"], lake=False)
    order = [entity.CHANGED, *jobs.POSITION]
    return sinks.read_serving(spark, f"{root}/serving/order_items", ["order_item_id"], order).drop(*order)


@query
def serving_after_compaction(spark, sf_dir):
    """Two dozen batches of all versions of the users, in no order of time, merged in levels while they are written."""
    versions, path = wh.user_versions(spark, sf_dir), work_path(spark, "serving")
    batch = F.pmod(F.xxhash64("user_id", "change_ts", "change_seq"), F.lit(24))
    for i in range(24):
        sinks.upsert_batch(versions.where(batch == i), path, ["user_id"], ["change_ts", "change_seq"], sinks.batch_label("load", i))
    return sinks.read_serving(spark, path, ["user_id"], ["change_ts", "change_seq"]).select(versions.columns)


def _lake_query(kind: str) -> None:
    table, _, _ = entity.TABLES[kind]

    def logged(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Two halves of the log, in several batches of the file sink; every version stays. The text is many times the table, so it is compressed."""
        log, path = wh.change_log(spark, sf_dir, [kind]), work_path(spark, "changes")
        for i in range(2):
            log.where(F.pmod(F.xxhash64("value"), F.lit(2)) == i).write.text(f"{path}/{i}", compression="gzip")
        source = read_text(streaming_session(spark), f"{path}/*", streaming=True, maxFilesPerTrigger="8")
        root = _drain(jobs.start_lake, spark, source, entities=[kind])
        names = [name for name, _ in entity.ROUTES[kind].values()]
        return read_lake(spark, f"{root}/lake/{table}", contracts.load(f"entities.{table}")).select(names)

    logged.__name__ = f"stream_lake_{table}"
    query(logged)


for _kind in entity.TABLES:
    _lake_query(_kind)


@query
def stream_validated(spark, sf_dir):
    root = _drain(jobs.start_validated, spark, _stream_log(spark, sf_dir))
    good = read_lake(spark, f"{root}/silver/validated_events", contracts.load("silver.validated_events"))
    return good.drop("ingestion_ts")  # the time of the run


@query
def stream_user_sessions(spark, sf_dir):
    root = _drain(jobs.start_sessions, spark, _stream_events(spark, sf_dir))
    return read_lake(spark, f"{root}/silver/user_sessions", contracts.load("silver.user_sessions"))


def _drain_thrice(job: Callable[..., object], spark: SparkSession, sf_dir: str, **options) -> str:
    """Run a job on the text log as three parts of it arrive, each time from the checkpoint of the run before."""
    events, session = spark.read.parquet(f"{sf_dir}/events.parquet"), streaming_session(spark)
    path, root = work_path(spark, "log"), work_path(spark, "restarted")
    at = wh.log_time("ts")
    for i, part in enumerate((at < "2024-01-11", (at >= "2024-01-11") & (at < "2024-01-21"), at >= "2024-01-21")):
        wh.click_log(spark, sf_dir, events.where(part)).write.text(f"{path}/{i}")
        arrived = jobs.window_events(read_text(session, f"{path}/*", streaming=True))
        job(arrived, root, f"{root}/checkpoint", trigger=jobs.DRAIN, **options).awaitTermination()
    return root


@query
def stream_sessions_from_log(spark, sf_dir):
    root = _drain_thrice(jobs.start_sessions, spark, sf_dir)
    return read_lake(spark, f"{root}/gold/session_metrics", contracts.load("gold.session_metrics"))


@query
def stream_funnel_from_log(spark, sf_dir):
    root = _drain_thrice(jobs.start_funnel, spark, sf_dir)
    return read_lake(spark, f"{root}/gold/product_funnel_1m", contracts.load("gold.product_funnel_1m"))


#: Ranges that no single grain makes up: hours and minutes over days, one hour across midnight, all, and none.
RANGES = {
    "weeks": (datetime(2024, 1, 3, 7, 13), datetime(2024, 1, 29, 22, 41)), "night": (datetime(2024, 1, 9, 23, 31), datetime(2024, 1, 10, 0, 31)),
    "all": (datetime(1960, 1, 1), datetime(2040, 1, 1)), "none": (datetime(2024, 1, 5), datetime(2024, 1, 5)),
}


def _between(spark: SparkSession, path: str) -> DataFrame:
    parts = [jobs.read_funnel_between(spark, path, *bounds).withColumn("range", F.lit(name)) for name, bounds in RANGES.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def funnel_any_range(spark, sf_dir):
    """Four ranges from cells that were stored in ten batches of windows, and merged."""
    windows, path = _funnel(spark, sf_dir), work_path(spark, "cells")
    part = F.pmod(F.xxhash64("product_id", "window_start"), F.lit(10))
    for i in range(10):
        jobs.add_cells(windows.where(part == i), path, sinks.batch_label("load", i))
    return _between(spark, path)


@query
def stream_funnel_any_range(spark, sf_dir):
    return _between(spark, f"{_drain_thrice(jobs.start_funnel, spark, sf_dir, cells=True)}/gold/product_funnel_cells")


@query
def stream_user_360(spark, sf_dir):
    """User totals of the closed sessions, from the share of each batch."""
    return jobs.read_user_360(spark, _drain_thrice(jobs.start_sessions, spark, sf_dir))


@query
def stream_rejected(spark, sf_dir):
    root = _drain(jobs.start_validated, spark, _stream_log(spark, sf_dir))
    rejected = spark.read.parquet(f"{root}/silver/rejected_events")
    return rejected.select("event_id", "event_type", F.array_join("reject_reasons", "; ").alias("reasons"))


@query
def stream_sessions(spark, sf_dir):
    root = _drain(jobs.start_sessions, spark, _stream_events(spark, sf_dir))
    return read_lake(spark, f"{root}/gold/session_metrics", contracts.load("gold.session_metrics"))


@query
def stream_serving_sessions(spark, sf_dir):
    root = _drain(jobs.start_sessions, spark, _stream_events(spark, sf_dir), gap=6 * HOUR)
    return sinks.read_serving(spark, f"{root}/serving/session_metrics", ["session_id"], jobs.SESSION_ORDER)


@query
def stream_funnel(spark, sf_dir):
    root = _drain(jobs.start_funnel, spark, _stream_events(spark, sf_dir))
    return read_lake(spark, f"{root}/gold/product_funnel_1m", contracts.load("gold.product_funnel_1m"))


@query
def stream_batch_diff(spark, sf_dir):
    """Streamed sessions against the batch ones that are closed by the end of the log."""
    root = _drain(jobs.start_sessions, spark, _stream_events(spark, sf_dir), gap=6 * HOUR)
    gold = contracts.load("gold.session_metrics")
    streamed = read_lake(spark, f"{root}/gold/session_metrics", gold)
    events = wh.click_events(spark, sf_dir)
    # Watermarks have millisecond precision.
    newest = events.agg(F.max("event_timestamp").alias("_max")).selectExpr(
        "CAST(substr(CAST(_max - INTERVAL '5' SECOND AS STRING), 1, 23) AS TIMESTAMP_NTZ)"
    )
    batch = session_metrics(events, gap=6 * HOUR)
    closed = batch.where(F.col("session_end") <= newest.scalar())
    return compare("session_metrics", streamed, closed).withColumnRenamed("table", "table_name")
