"""Gap sessions: runs of a key's events with no pause longer than the gap.

Bounds are the first event and the last event plus the gap. The struct that
``session_window`` returns never leaves this module: Spark pushes a filter on
its bounds below the merge of sessions, which changes the sessions.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.time import as_utc, cell_start, duration, whole_seconds
from .events import EVENT_TYPES, WATERMARK, with_event_time

KEYS = ("session_id", "user_id")
GAP = timedelta(minutes=30)
# Count column of each event type.
TYPE_COUNTS = dict(zip(EVENT_TYPES, ("page_views", "add_to_carts", "purchases")))
COUNTS = ("event_count", *TYPE_COUNTS.values())


def type_counts() -> list[Column]:
    return [F.expr(f"count_if(event_type = '{t}') AS {name}") for t, name in TYPE_COUNTS.items()]


def _batch_sessions(events: DataFrame, keys: Sequence[str], gap: timedelta) -> DataFrame:
    """Sessions from per-cell summaries.

    Events of one key in one gap-wide cell are less than a gap apart, so they
    share a session and may be summed before any ordering. That aggregate is
    combined in the map tasks, and leaves a key at most (time span / gap) rows
    to order, however many events it has.
    """
    timed = events.where("event_timestamp IS NOT NULL")
    cells = (
        timed.select(*keys, "event_type", "event_timestamp", cell_start("event_timestamp", gap).alias("_cell"))
        .groupBy(*keys, "_cell")
        .agg(F.min("event_timestamp").alias("_first"), F.max("event_timestamp").alias("_last"),
             F.count("*").alias("event_count"), *type_counts())
    )
    in_order = Window.partitionBy(*keys).orderBy("_cell")
    joins = F.col("_first") - F.lag("_last").over(in_order) <= F.lit(gap)
    numbered = cells.withColumn("_opens", F.when(joins, 0).otherwise(1)).withColumn(
        "_run", F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    totals = [F.expr(f"sum({c}) AS {c}") for c in COUNTS]
    runs = numbered.groupBy(*keys, "_run")
    return runs.agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), *totals)


def _stream_sessions(events: DataFrame, keys: Sequence[str], gap: timedelta, delay: str) -> DataFrame:
    """The same columns from a stream; a row appears once the watermark passes its end."""
    return (
        with_event_time(events, delay)
        .groupBy(*keys, F.session_window("event_time", duration(gap)).alias("_window"))
        .agg(as_utc(F.min("event_time")).alias("_first"), as_utc(F.max("event_time")).alias("_last"),
             F.count("*").alias("event_count"), *type_counts())
    )


def session_metrics(
    events: DataFrame,
    keys: Sequence[str] = KEYS,
    gap: timedelta = GAP,
    end: str = "gap",
    delay: str = WATERMARK,
) -> DataFrame:
    """Counts and outcome per session (every event type is counted, known or not).

    ``end="gap"`` closes a session one gap after its last event,
    ``end="last_event"`` at its last event.
    """
    if end not in ("gap", "last_event"):
        raise ValueError(f"end must be 'gap' or 'last_event', not {end!r}")
    if events.isStreaming:
        runs = _stream_sessions(events, keys, gap, delay)
    else:
        runs = _batch_sessions(events, keys, gap)
    closed = F.col("_last") + F.lit(gap) if end == "gap" else F.col("_last")
    bounded = runs.select(*keys, F.col("_first").alias("session_start"), closed.alias("session_end"), *COUNTS)
    return bounded.select(
        *keys, "session_start", "session_end",
        whole_seconds(F.col("session_start"), F.col("session_end")).alias("session_duration_seconds"),
        *COUNTS,
        F.expr("purchases > 0 AS converted"),
        F.expr("to_date(session_start) AS session_date"),
    )


def user_sessions(metrics: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Silver view of the sessions: their bounds and size."""
    return metrics.select(*keys, "session_start", "session_end", "event_count", "session_date")


def serving_sessions(metrics: DataFrame) -> DataFrame:
    """Columns and narrower counts of the serving table."""
    narrow = [F.expr(f"CAST({c} AS INT) AS {c}") for c in COUNTS]
    return metrics.select(
        "session_id", "user_id", "session_date", "session_start", "session_end",
        "session_duration_seconds", *narrow, "converted",
    )
