"""Event-time expressions that do not depend on the session time zone.

Lake tables hold zone-less timestamps (TIMESTAMP_NTZ) that are read as UTC.
Watermarks need TIMESTAMP. A cast between the two would use the session zone,
as do ``timestampdiff``, ``timestampadd`` and ``unix_micros`` on a zone-less
timestamp, so they meet through intervals since the epoch.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

# Accepted payload layouts, by name.
MILLIS = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}$"
SECONDS = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
ISO_OFFSET = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"
FORMATS = {"millis": MILLIS, "seconds": SECONDS, "iso": ISO_OFFSET}

DATE_GRAINS = ("day", "week", "month", "quarter", "year")


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def moment(at: datetime) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def as_instant(ts: Column) -> Column:
    """TIMESTAMP_NTZ in UTC -> TIMESTAMP, as watermarks require."""
    return F.timestamp_seconds((ts - _epoch()).cast("interval second").cast("decimal(18,6)"))


def as_utc(instant: Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ in UTC, as lake tables store it."""
    return _epoch() + F.expr("INTERVAL '0.000001' SECOND") * F.unix_micros(instant)


def whole_seconds(start: Column, end: Column) -> Column:
    """Completed seconds between two zone-less timestamps."""
    return (end - start).cast("interval second").cast("bigint")


def duration(length: timedelta) -> str:
    """The length as the text that window functions take."""
    return f"{length // timedelta(microseconds=1)} microseconds"


def cell_start(ts: Column | str, width: timedelta) -> Column:
    """Start of the ``width``-wide cell, counted from the epoch, that holds ``ts``.

    A fixed window, hence usable once per ``select``, and dropping rows without
    a timestamp.
    """
    return F.window(ts, duration(width))["start"]


def truncate(ts: Column, grain: str) -> Column:
    """``date_trunc`` for zone-less timestamps and dates; returns a timestamp."""
    if grain in DATE_GRAINS:
        day = F.to_date(ts)
        return (day if grain == "day" else F.trunc(day, grain)).cast("timestamp_ntz")
    time_of_day = [F.hour, F.minute, F.second]
    try:
        kept = time_of_day[:["hour", "minute", "second"].index(grain) + 1]
    except ValueError:
        raise ValueError(f"unknown time grain {grain!r}") from None
    since_midnight = F.make_dt_interval(F.lit(0), *[part(ts) for part in kept])
    return F.to_date(ts).cast("timestamp_ntz") + since_midnight


def parse_timestamp(text: Column, formats: tuple[str, ...] = ("millis",)) -> Column:
    """Text -> zone-less UTC timestamp; NULL when no named format matches."""
    tries = []
    for name in formats:
        matched = F.when(text.rlike(FORMATS[name]), text)
        if name == "iso":
            tries.append(as_utc(matched.try_cast("timestamp")))
        else:
            tries.append(matched.try_cast("timestamp_ntz"))
    return F.coalesce(*tries) if len(tries) > 1 else tries[0]
