"""Event counts per product and fixed time window."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from ..functions.time import as_utc, duration, moment, whole_seconds
from .events import WATERMARK, with_event_time
from .sessions import TYPE_COUNTS, type_counts

WINDOW = timedelta(minutes=1)
#: The widest cell of ``dyadic_cells`` is this power of two of windows: two years of minutes.
TOP_LEVEL = 20
EPOCH = datetime(1970, 1, 1)
CELL = ("product_id", "level", "cell")


def product_funnel(events: DataFrame, size: timedelta = WINDOW, delay: str = WATERMARK) -> DataFrame:
    """Funnel counts per ``[window_start, window_end)``.

    Events without a product form a group of their own. The counts are combined
    before the exchange, so a popular product costs one row per task and window.
    """
    time, utc = "event_timestamp", F.col
    if events.isStreaming:
        events, time, utc = with_event_time(events, delay), "event_time", lambda c: as_utc(F.col(c))
    windows = events.groupBy("product_id", F.window(time, duration(size)).alias("_window"))
    return windows.agg(*type_counts()).select(
        "product_id",
        utc("_window.start").alias("window_start"),
        utc("_window.end").alias("window_end"),
        *TYPE_COUNTS.values(),
    )


def coarser_funnel(funnel: DataFrame, fine: timedelta, coarse: timedelta) -> DataFrame:
    """Re-sum a funnel of ``fine`` windows into ``coarse`` ones."""
    if coarse % fine:
        raise ValueError(f"{coarse} is not a multiple of {fine}")
    windows = funnel.groupBy("product_id", F.window("window_start", duration(coarse)).alias("_window"))
    totals = windows.agg(*[F.sum(c).alias(c) for c in TYPE_COUNTS.values()])
    return totals.select("product_id", F.expr("_window.start AS window_start"), F.expr("_window.end AS window_end"),
                         *TYPE_COUNTS.values())


def serving_funnel(funnel: DataFrame) -> DataFrame:
    """Rows the serving table takes: it requires a product."""
    return funnel.where(F.col("product_id").isNotNull())


def dyadic_cells(funnel: DataFrame, fine: timedelta = WINDOW, top: int = TOP_LEVEL) -> DataFrame:
    """The funnel summed into cells of ``fine`` times 1, 2, 4, ... up to two to the power of ``top``.

    A cell is named by its level and its number since 1970. Each window is in one cell of each level, combined before the
    exchange. Cells of separate windows add up, see ``merge_cells``, so a batch of closed windows can be added to earlier ones.
    """
    first = F.floor(whole_seconds(moment(EPOCH), F.col("window_start")) / _seconds(fine))
    leveled = funnel.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top))))
    leveled = leveled.withColumn("_first", first.cast("long"))
    return merge_cells(leveled.withColumn("cell", F.expr("shiftright(_first, level)")))


def merge_cells(cells: DataFrame, *also: str) -> DataFrame:
    """One row per product and cell, of those of several batches; of columns in ``also`` the greatest value."""
    sums = [F.sum(c).alias(c) for c in TYPE_COUNTS.values()]
    return cells.groupBy(*CELL).agg(*sums, *(F.max(c).alias(c) for c in also))


def cover(start: datetime, end: datetime, fine: timedelta = WINDOW, top: int = TOP_LEVEL) -> list[tuple[int, int, int]]:
    """The cells that make up ``[start, end)``, as (level, first, last): two of each level at most, below the top one."""
    (low, odd), (high, odd_end) = divmod(start - EPOCH, fine), divmod(end - EPOCH, fine)
    if odd or odd_end:
        raise ValueError(f"the range must begin and end with a window of {fine}")
    parts = []
    for level in range(top):
        if low >= high:
            return parts
        if low % 2:
            parts.append((level, low, low))
            low += 1
        if high % 2:
            high -= 1
            parts.append((level, high, high))
        low, high = low // 2, high // 2
    return [*parts, (top, low, high - 1)] if low < high else parts


def funnel_between(
    cells: DataFrame, start: datetime, end: datetime, fine: timedelta = WINDOW, top: int = TOP_LEVEL
) -> DataFrame:
    """Counts per product over ``[start, end)``, from a number of cells per product that grows with the logarithm of the range.

    The cells are named in the filter, so it reaches the scan; products without an event in the range have no row.
    """
    wanted = [(F.col("level") == level) & F.col("cell").between(first, last) for level, first, last in cover(start, end, fine, top)]
    rows = cells.where(reduce(or_, wanted)) if wanted else cells.limit(0)
    return rows.groupBy("product_id").agg(*[F.sum(c).alias(c) for c in TYPE_COUNTS.values()])


def _seconds(fine: timedelta) -> int:
    seconds, rest = divmod(fine, timedelta(seconds=1))
    if rest or seconds < 1:
        raise ValueError("windows must last whole seconds")
    return seconds
