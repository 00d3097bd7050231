"""Copies of events that come days later, which no watermark can wait for: an index of the ids seen, on storage.

The index has one row for each id and day of event time, however many copies there were. It is a table of ``store``: batches
are merged in levels, merged runs are sorted by day and id, so a batch reads the days around its own and skips the rest by the
statistics of the files. A batch's ids meet the index as its small side; the index is not shuffled where they can be broadcast.
Days are whole numbers since 1970, so that any event time can be compared.
"""

from __future__ import annotations

from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from . import store

REMEMBER = timedelta(days=7)
KEY = ("event_id", "day")


class Span(NamedTuple):
    """Days of a batch: the first, the last, and the one in the middle of its events."""

    first: int
    last: int
    middle: int


def _day() -> Column:
    return F.unix_date(F.to_date("event_timestamp"))


def comparable(events: DataFrame) -> DataFrame:
    """Events with an id and a time; the others can't be told from copies and all stay."""
    return events.where(F.col("event_id").isNotNull() & F.col("event_timestamp").isNotNull())


def incomparable(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_id").isNull() | F.col("event_timestamp").isNull())


def span(events: DataFrame) -> Span | None:
    """The days of a batch; none without an event to compare."""
    day = _day()
    row = comparable(events).agg(F.min(day), F.max(day), F.percentile_approx(day, 0.5)).first()
    return None if row[0] is None else Span(*row)


def mark_copies(events: DataFrame, seen: DataFrame | None, days: int, within: Span) -> DataFrame:
    """One row for each id and day: the earliest event, the number of events, and whether it is a copy.

    It is a copy if its id was seen up to ``days`` earlier in this batch, or by the index on any day that is no more than
    ``days`` away, later ones included, as the batches may have come in another order. Copies count as seen, so an id that
    keeps coming stays known. A day's events of an id are reduced before they are sent, and no id is ordered by more than its days.
    """
    rest = [c for c in events.columns if c not in ("event_id", "event_timestamp")]
    daily = comparable(events).groupBy("event_id", _day().alias("day")).agg(
        F.min(F.struct("event_timestamp", *rest)).alias("event"), F.count("*").alias("copies"))
    before = F.lag("day").over(Window.partitionBy("event_id").orderBy("day"))
    daily = daily.withColumn("again", F.coalesce(F.col("day") - before <= days, F.lit(False)))
    if seen is None:
        return daily.withColumnRenamed("again", "is_copy")
    ids = daily.select("event_id").distinct()
    known = seen.where(F.col("day").between(within.first - days, within.last + days))
    known = known.join(ids, "event_id", "left_semi").select(F.col("event_id").alias("_id"), F.col("day").alias("_seen"))
    near = (F.col("event_id") == F.col("_id")) & (F.abs(F.col("day") - F.col("_seen")) <= days)
    touched = daily.select(*KEY).join(known, near, "left_semi").withColumn("_known", F.lit(True))
    marked = daily.join(touched, list(KEY), "left")
    return marked.withColumn("is_copy", F.col("again") | F.col("_known").isNotNull()).drop("again", "_known")


def first_events(marked: DataFrame, columns: list[str]) -> DataFrame:
    """The events that aren't copies, as they came."""
    return marked.where(~F.col("is_copy")).select([
        F.col(c) if c == "event_id" else F.col(f"event.{c}").alias(c) for c in columns
    ])


def copies(marked: DataFrame) -> DataFrame:
    """How many events of an id and a day were left out."""
    left_out = F.col("copies") - F.when(F.col("is_copy"), 0).otherwise(1)
    return marked.select("event_id", F.date_from_unix_date("day").alias("event_date"), left_out.alias("copies")).where("copies > 0")


def has(spark: SparkSession, path: str, label: str) -> bool:
    """Whether the index holds this batch, which means that all it let through had been written."""
    head, (query, number) = store.load(spark, path), store.batch_of(label)
    return head is not None and number <= head.done.get(query, -1)


def read(spark: SparkSession, path: str) -> DataFrame | None:
    return None if store.load(spark, path) is None else store.read(spark, path).select(*KEY)


def remember(marked: DataFrame, path: str, label: str, days: int, within: Span) -> bool:
    """Add a batch's ids to the index, after its events were written.

    Merges forget days more than twice ``days`` before the middle of the batch's events: single wrong times far ahead
    move the middle by nothing, and an event up to ``days`` late still finds all copies before it.
    """
    oldest = within.middle - 2 * days

    def merge(rows: DataFrame) -> DataFrame:
        recent = rows.where(F.col("day") >= oldest).groupBy(*KEY).agg(F.max(store.VERSION).alias(store.VERSION))
        return recent.repartitionByRange("day", "event_id").sortWithinPartitions("day", "event_id")

    return store.commit(marked.select(*KEY), path, label, merge)
