"""Rebuilding every derived table from the raw log, and proving the result equal."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import contracts
from ..functions.time import moment
from ..operators import changes as entity
from ..operators.compare import compare
from ..operators.events import bronze_events, rejected_events, validated_events
from ..operators.funnel import WINDOW, product_funnel, serving_funnel
from ..operators.sessions import GAP, serving_sessions, session_metrics, user_sessions
from ..operators.users import user_360, user_state
from ..sources.logs import parse_changes, parse_events, rejected_changes, rejected_text
from ..sources.tables import read_lake
from ..streaming import jobs, sinks, store
from ..streaming.sinks import write_table

DERIVED = (
    "bronze.raw_events", "silver.validated_events", "silver.user_sessions",
    "gold.session_metrics", "gold.product_funnel_1m", "gold.user_360",
)


REJECTED = ("bronze.rejected_text", "silver.rejected_events", "lake.rejected_changes")
LIVE = "_live"
LOADED = "replay-0"
ENTITIES = tuple(entity.TABLES)
#: Keys and order of the serving tables of events; entities go by the order of their changes.
SERVING: dict[str, tuple[list[str], list[str]]] = {
    "session_metrics": (["session_id"], list(jobs.SESSION_ORDER)),
    "product_funnel_1m": (["product_id", "window_start"], ["window_end"]),
}


def table_path(root: str, table: str) -> str:
    return f"{root}/{table.replace('.', '/')}"


def rebuild(
    raw: DataFrame,
    root: str,
    ingestion_ts: Column | None = None,
    gap: timedelta = GAP,
    window: timedelta = WINDOW,
) -> dict[str, str]:
    """Replace all six layered tables and the two reject tables from a raw log.

    The log is parsed into bronze, and once more for the text that cannot be
    read. Later tables read the stored one before them, so a lost executor costs a re-read of files, not of the log.
    """
    spark = raw.sparkSession

    def save(table: str, df: DataFrame) -> DataFrame:
        contract = contracts.load(table)
        write_table(contracts.conform(df, contract), table_path(root, table), contract.partition_by)
        return read_lake(spark, table_path(root, table), contract)

    bronze = save("bronze.raw_events", bronze_events(parse_events(raw)))
    write_table(rejected_text(raw), table_path(root, "bronze.rejected_text"))
    save("silver.validated_events", validated_events(bronze, ingestion_ts))
    write_table(rejected_events(bronze), table_path(root, "silver.rejected_events"))
    sessions = save("gold.session_metrics", session_metrics(bronze, gap=gap))
    save("silver.user_sessions", user_sessions(sessions))
    save("gold.product_funnel_1m", product_funnel(bronze, window))
    refresh_user_360(spark, root)
    return {table: table_path(root, table) for table in DERIVED}


def refresh_user_360(spark: SparkSession, root: str) -> str:
    """Replace the user totals with those of all sessions stored so far."""
    sessions = read_lake(spark, table_path(root, "gold.session_metrics"), contracts.load("gold.session_metrics"))
    target = table_path(root, "gold.user_360")
    write_table(user_360(user_state(sessions)), target)
    return target


def prepare(clicks: DataFrame, changes: DataFrame, root: str, entities: Sequence[str] = ENTITIES, **options) -> str:
    """Rebuild everything from the logs of events and of changes as a new version of the tables; returns its name.

    All layered tables, the entities' logs, the three reject tables and the serving tables of sessions, funnel and
    entities. Nothing of it is
    read before ``switch`` names it, so a rebuild that fails half-way leaves the tables as they are. ``options`` are
    those of ``rebuild``.
    """
    spark, version = clicks.sparkSession, f"v-{uuid.uuid4().hex}"
    target = f"{root}/{version}"
    rebuild(clicks, target, **options)
    layered = read_tables(spark, {t: table_path(target, t) for t in DERIVED})
    gold = {"session_metrics": serving_sessions(layered["gold.session_metrics"]),
            "product_funnel_1m": serving_funnel(layered["gold.product_funnel_1m"])}
    for table, rows in gold.items():
        sinks.upsert_batch(rows, f"{target}/serving/{table}", *SERVING[table], LOADED, sinks.SERVING_DEFAULTS[table])
    position = [c for c in jobs.POSITION if c in changes.columns]
    write_table(rejected_changes(changes, position), f"{target}/lake/rejected_changes")
    for kind in entities:
        table, key, parts = entity.TABLES[kind]
        order = [entity.CHANGED, *position]
        versions = entity.route(parse_changes(changes, position, [kind]), kind, keep=order)
        write_table(versions, f"{target}/lake/{table}", parts)
        stored = spark.read.schema(versions.schema).parquet(f"{target}/lake/{table}").select(versions.columns)
        sinks.upsert_batch(entity.serving_columns(stored, kind), f"{target}/serving/{table}", [key], order, LOADED,
                           sinks.SERVING_DEFAULTS.get(table))
    return version


def switch(spark: SparkSession, root: str, version: str) -> None:
    """Make a version the one that is read, in one step. Earlier ones stay for readers that are under way."""
    store.replace_text_file(spark, f"{root}/{LIVE}", version)


def live(spark: SparkSession, root: str) -> str | None:
    """The version that is read."""
    return store.read_text_file(spark, f"{root}/{LIVE}")


def read_version(
    spark: SparkSession, root: str, version: str | None = None, entities: Sequence[str] = ENTITIES
) -> dict[str, DataFrame]:
    """All tables of a version, of the live one if none is named."""
    version = version or live(spark, root)
    if version is None:
        raise FileNotFoundError(f"no version is live at {root}")
    at = f"{root}/{version}"
    tables = read_tables(spark, {t: table_path(at, t) for t in DERIVED})
    for table in REJECTED:
        tables[table] = spark.read.parquet(table_path(at, table))
    for table, (keys, by) in SERVING.items():
        tables[f"serving.{table}"] = sinks.read_serving(spark, f"{at}/serving/{table}", keys, by)
    for table, key, _ in (entity.TABLES[kind] for kind in entities):
        log = tables[f"lake.{table}"] = spark.read.parquet(f"{at}/lake/{table}")
        order = [entity.CHANGED, *(c for c in jobs.POSITION if c in log.columns)]
        tables[f"serving.{table}"] = sinks.read_serving(spark, f"{at}/serving/{table}", [key], order)
    return tables


def reprocess(
    clicks: DataFrame,
    changes: DataFrame,
    root: str,
    accept: Callable[[DataFrame], bool] | None = None,
    entities: Sequence[str] = ENTITIES,
    **options,
) -> str:
    """Rebuild everything and switch to it; returns the version that is live then.

    With ``accept`` the switch waits for it: it gets the comparison of every table with the live one (see
    ``compare_tables``), and the tables stay as they are if it returns false. A first version has nothing to compare.
    """
    spark = clicks.sparkSession
    before, version = live(spark, root), prepare(clicks, changes, root, entities, **options)
    if accept and before:
        old, new = (read_version(spark, root, v, entities) for v in (before, version))
        if not accept(compare_tables(old, new)):
            return before
    switch(spark, root, version)
    return version


def read_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    return {t: read_lake(spark, p, contracts.load(t)) for t, p in paths.items()}


def compare_tables(left: Mapping[str, DataFrame], right: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table; a faithful replay has nothing on one side only."""
    return reduce(DataFrame.unionByName, [compare(t, left[t], right[t]) for t in left])


def log_as_of(log: DataFrame, at: datetime, column: str = "ingestion_ts") -> DataFrame:
    """The append-only log as it stood at ``at``."""
    return log.where(F.col(column) <= moment(at))


def growth(log: DataFrame, before: datetime, after: datetime, column: str = "ingestion_ts") -> DataFrame:
    """Row counts at two moments and what came between, in one pass."""
    at = [F.count_if(F.col(column) <= moment(m)) for m in (before, after)]
    return log.agg(at[0].alias("rows_before"), at[1].alias("rows_after")).withColumn(
        "rows_added", F.col("rows_after") - F.col("rows_before")
    )
