"""Bronze and silver click events."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.json import json_scalar
from ..functions.time import as_instant, as_utc, moment, parse_timestamp
from .keyed import first_per_key

# The event types of the funnel.
EVENT_TYPES = ("page_view", "add_to_cart", "purchase")
REQUIRED = ("event_id", "user_id", "session_id")
WATERMARK = "5 seconds"


def bronze_events(parsed: DataFrame, formats: tuple[str, ...] = ("millis",)) -> DataFrame:
    """Parsed log records with a typed event time and its date."""
    typed = parsed.withColumn("event_timestamp", parse_timestamp(F.col("timestamp"), formats))
    return typed.select(
        "event_id", "event_type", "user_id", "session_id", "product_id", "event_timestamp",
        F.col("metadata").cast("string").alias("metadata"),
        F.to_date("event_timestamp").alias("event_date"),
    )


def strict_values(events: DataFrame) -> DataFrame:
    """Trim ids and lower-case the type; an empty id becomes NULL, so validation drops it."""
    trimmed = {c: F.nullif(F.trim(c), F.lit("")) for c in REQUIRED}
    return events.withColumns({**trimmed, "event_type": F.lower(F.trim("event_type"))})


def _rules(as_of: datetime | None, max_age: timedelta) -> dict[str, Column]:
    """Validity rules by the reason given when one fails."""
    rules = {f"{c} missing": F.col(c).isNotNull() for c in REQUIRED}
    rules["event_type unknown"] = F.col("event_type").isin(*EVENT_TYPES)
    if as_of is not None:
        ts = F.col("event_timestamp")
        rules["event_timestamp in the future"] = ts <= moment(as_of)
        rules["event_timestamp too old"] = ts >= moment(as_of - max_age)
    return rules


def valid_events(
    events: DataFrame, as_of: datetime | None = None, max_age: timedelta = timedelta(days=7)
) -> DataFrame:
    """Events satisfying every rule. The time rules apply when ``as_of`` is given.

    The rules are plain comparisons, so on a stored table they reach the scan.
    """
    return events.where(reduce(and_, _rules(as_of, max_age).values()))


def rejected_events(
    events: DataFrame, as_of: datetime | None = None, max_age: timedelta = timedelta(days=7)
) -> DataFrame:
    """The complement of ``valid_events``, with the reasons. An unknown outcome is a failure."""
    failed = [
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(reason))
        for reason, rule in _rules(as_of, max_age).items()
    ]
    reasons = F.array_compact(F.array(*failed))
    return events.withColumn("reject_reasons", reasons).where(F.size("reject_reasons") > 0)


def enrich_events(events: DataFrame, ingestion_ts: Column | None = None) -> DataFrame:
    """Add the page, the referrer and the processing time (now, unless given)."""
    stamped = as_utc(F.current_timestamp()) if ingestion_ts is None else ingestion_ts
    return events.withColumns({
        "page_url": json_scalar(F.col("metadata"), "page"),
        "referrer": json_scalar(F.col("metadata"), "referrer"),
        "ingestion_ts": stamped,
    })


def validated_events(
    events: DataFrame,
    ingestion_ts: Column | None = None,
    strict: bool = False,
    as_of: datetime | None = None,
) -> DataFrame:
    """Silver table: valid bronze events, enriched."""
    checked = strict_values(events) if strict else events
    return enrich_events(valid_events(checked, as_of), ingestion_ts)


def dedupe_events(
    events: DataFrame, within: str = WATERMARK, spread_by: str | None = None, salts: int = 32
) -> DataFrame:
    """One event per ``event_id``; events without an id are all kept.

    In a batch the earliest event of an id is kept, whatever the input order; a
    copy without a time counts as the latest. A stream keeps the first to
    arrive and remembers an id for ``within``; events without a time cannot
    pass a watermark and are left to ``untimed_events``. Its
    dedupe has no map-side step, so for an id with very many copies name in
    ``spread_by`` a number that differs between copies, such as the log offset:
    the copies are thinned out in ``salts`` places before they meet.
    """
    if events.isStreaming:
        # An event without an id gets one that no other has, for the comparison only.
        alone = F.when(F.col("event_id").isNull(), F.expr("uuid()"))
        timed = with_event_time(events, within).withColumn("_alone", alone)
        if spread_by:
            salted = timed.withColumn("_salt", F.pmod(F.col(spread_by), F.lit(salts)))
            timed = salted.dropDuplicatesWithinWatermark(["event_id", "_alone", "_salt"]).drop("_salt")
        return timed.dropDuplicatesWithinWatermark(["event_id", "_alone"]).drop("event_time", "_alone")
    known = events.where(F.col("event_id").isNotNull()).withColumn("_untimed", F.col("event_timestamp").isNull())
    first = first_per_key(known, ["event_id"], ["_untimed", "event_timestamp"]).drop("_untimed")
    return first.unionByName(events.where(F.col("event_id").isNull()))


def with_event_time(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Add ``event_time``, a TIMESTAMP carrying the watermark.

    Events without a time are dropped here, as every window drops them; they
    are reported by ``untimed_events``.
    """
    timed = events.where(F.col("event_timestamp").isNotNull())
    return timed.withColumn("event_time", as_instant(F.col("event_timestamp"))).withWatermark("event_time", delay)


def untimed_events(events: DataFrame) -> DataFrame:
    """Events no window can hold."""
    return events.where(F.col("event_timestamp").isNull())
