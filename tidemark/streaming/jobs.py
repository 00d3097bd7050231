"""The streaming jobs: one query and one checkpoint each.

``trigger`` is passed to ``DataStreamWriter.trigger``; ``{"availableNow": True}``
processes what is there and stops, which is also how a replay runs. A job with
several outputs computes a batch once and writes it to all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import contracts
from ..operators import changes as entity
from ..operators.events import (
    WATERMARK, bronze_events, dedupe_events, enrich_events, rejected_events, untimed_events, valid_events,
)
from ..operators.funnel import CELL, WINDOW, dyadic_cells, funnel_between, merge_cells, product_funnel, serving_funnel
from ..operators.sessions import GAP, serving_sessions, session_metrics, user_sessions
from ..operators.users import merge_states, user_360, user_state
from ..session import SHUFFLE_CLEANUP, check_streaming, set_for
from ..sources.logs import WINDOW_FIELDS, parse_changes, parse_events, rejected_changes, rejected_text
from . import seen, sinks, store

Trigger = Mapping[str, Any]
LIVE: Trigger = {"processingTime": "30 seconds"}
# How often the jobs with serving tables write.
SESSIONS_LIVE: Trigger = {"processingTime": "2 seconds"}
FUNNEL_LIVE: Trigger = {"processingTime": "5 seconds"}
DRAIN: Trigger = {"availableNow": True}
POSITION = ("log_partition", "log_offset")
SESSION_ORDER = ("session_end", "session_start", "user_id")


def _start(
    df: DataFrame, checkpoint: str, trigger: Trigger, write: Callable[[DataFrame, str], None]
) -> StreamingQuery:
    def run(batch: DataFrame, batch_id: int) -> None:
        # Spilled to disk where memory is short; lost blocks are computed again.
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            since = sinks.started(batch.sparkSession, checkpoint)
            write(held, sinks.batch_label(checkpoint, batch_id, since))
        finally:
            held.unpersist()

    writer = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger).start()


def window_events(raw: DataFrame, formats: Sequence[str] = ("millis",)) -> DataFrame:
    """Typed events for the windowed jobs; the metadata is not read."""
    parsed = parse_events(raw, WINDOW_FIELDS).withColumn("metadata", F.lit(None).cast("string"))
    return bronze_events(parsed, tuple(formats)).drop("metadata", "event_date")


def start_bronze(raw: DataFrame, out: str, checkpoint: str, trigger: Trigger = LIVE) -> StreamingQuery:
    """Every readable record, partitioned by date; the text of the others to a reject table."""
    parts = contracts.load("bronze.raw_events").partition_by

    def write(batch: DataFrame, label: str) -> None:
        sinks.append_batch(bronze_events(parse_events(batch)), f"{out}/bronze/raw_events", label, parts)
        sinks.append_batch(rejected_text(batch), f"{out}/bronze/rejected_text", label)

    return _start(raw, checkpoint, trigger, write)


def start_validated(
    raw: DataFrame, out: str, checkpoint: str, trigger: Trigger = LIVE, remember: timedelta | None = None
) -> StreamingQuery:
    """Valid events to the silver table, the others with their reasons to a reject table.

    Valid events without a time, which no window can hold, are reported as well.
    With ``remember``, in whole days, a copy of an event is left out for so long, by an index of the ids seen
    (see ``seen``), and counted in a table of its own; the index takes a batch after its events are written.
    """
    parts = contracts.load("silver.validated_events").partition_by
    index = f"{out}/silver/seen_ids"

    def write(batch: DataFrame, label: str) -> None:
        good = enrich_events(valid_events(batch))
        sinks.append_batch(rejected_events(batch), f"{out}/silver/rejected_events", label)
        sinks.append_batch(untimed_events(good), f"{out}/silver/untimed_events", label)
        if remember is None:
            sinks.append_batch(good, f"{out}/silver/validated_events", label, parts)
        elif not seen.has(batch.sparkSession, index, label):
            write_unique(good, label, remember.days)

    def write_unique(good: DataFrame, label: str, days: int) -> None:
        table, within = f"{out}/silver/validated_events", seen.span(good)
        if within is None:
            sinks.append_batch(good, table, label, parts)
            return
        marked = seen.mark_copies(good, seen.read(good.sparkSession, index), days, within)
        marked = marked.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            unique = seen.first_events(marked, good.columns).unionByName(seen.incomparable(good))
            sinks.append_batch(unique, table, label, parts)
            sinks.append_batch(seen.copies(marked), f"{out}/silver/repeated_events", label)
            seen.remember(marked, index, label, days, within)
        finally:
            marked.unpersist()

    return _start(bronze_events(parse_events(raw)), checkpoint, trigger, write)


def start_deduplicated(
    events: DataFrame, out: str, checkpoint: str, trigger: Trigger = LIVE, within: str = WATERMARK,
    spread_by: str | None = None,
) -> StreamingQuery:
    """One event per id, see ``dedupe_events``; events without an id are all kept."""
    check_streaming(events.sparkSession)
    return _start(
        dedupe_events(events, within, spread_by), checkpoint, trigger,
        lambda batch, label: sinks.append_batch(batch, f"{out}/silver/unique_events", label),
    )


def start_sessions(
    events: DataFrame,
    out: str,
    checkpoint: str,
    trigger: Trigger = SESSIONS_LIVE,
    gap: timedelta = GAP,
    delay: str = WATERMARK,
) -> StreamingQuery:
    """Closed sessions to silver, gold and the serving table, from one aggregation.

    The batch's share of the user totals is kept as well, see ``read_user_360``.
    """
    check_streaming(events.sparkSession)
    silver = contracts.load("silver.user_sessions").partition_by
    gold = contracts.load("gold.session_metrics").partition_by

    def write(batch: DataFrame, label: str) -> None:
        sinks.append_batch(user_sessions(batch), f"{out}/silver/user_sessions", label, silver)
        sinks.append_batch(batch, f"{out}/gold/session_metrics", label, gold)
        sinks.upsert_batch(
            serving_sessions(batch), f"{out}/serving/session_metrics", ["session_id"], SESSION_ORDER,
            label, sinks.SERVING_DEFAULTS["session_metrics"],
        )
        store.commit(user_state(batch), f"{out}/gold/user_state", label, merge_states, ["user_id"])

    return _start(session_metrics(events, gap=gap, delay=delay), checkpoint, trigger, write)


def read_user_360(spark: SparkSession, out: str) -> DataFrame:
    """User totals up to the last batch, merged from the share of each batch.

    Equal to recomputing them from all sessions. A repeated batch is left
    out, so no session is counted twice.
    """
    return user_360(merge_states(store.read(spark, f"{out}/gold/user_state")))


def start_funnel(
    events: DataFrame,
    out: str,
    checkpoint: str,
    trigger: Trigger = FUNNEL_LIVE,
    size: timedelta = WINDOW,
    delay: str = WATERMARK,
    cells: bool = False,
) -> StreamingQuery:
    """Closed windows to the gold and the serving table; with ``cells`` also to those ``read_funnel_between`` answers from."""
    check_streaming(events.sparkSession)

    def write(batch: DataFrame, label: str) -> None:
        sinks.append_batch(batch, f"{out}/gold/product_funnel_1m", label)
        sinks.upsert_batch(
            serving_funnel(batch), f"{out}/serving/product_funnel_1m", ["product_id", "window_start"],
            ["window_end"], label, sinks.SERVING_DEFAULTS["product_funnel_1m"],
        )
        if cells:
            add_cells(batch, f"{out}/gold/product_funnel_cells", label, size)

    return _start(product_funnel(events, size, delay), checkpoint, trigger, write)


def add_cells(windows: DataFrame, path: str, label: str, size: timedelta = WINDOW) -> bool:
    """Add a batch of closed windows to the stored cells; false if they have this batch, which isn't counted twice then."""

    def merge(rows: DataFrame) -> DataFrame:
        return merge_cells(rows, store.VERSION).repartitionByRange(*CELL[1:], CELL[0]).sortWithinPartitions(*CELL[1:], CELL[0])

    return store.commit(dyadic_cells(windows, size), path, label, merge)


def read_funnel_between(spark: SparkSession, path: str, start: datetime, end: datetime, size: timedelta = WINDOW) -> DataFrame:
    """Counts per product over any range of whole windows, from the stored cells."""
    return funnel_between(store.read(spark, path), start, end, size)


def start_changes(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    trigger: Trigger = LIVE,
    entities: Sequence[str] = tuple(entity.ROUTES),
    position: Sequence[str] | None = None,
    rejects: bool = True,
    lake: bool = True,
) -> StreamingQuery:
    """Each entity to its lake log, with every version (unless ``start_lake`` writes that), and to its serving table.

    ``position`` names log columns (partition, offset) that order changes of
    the same time; by default those the log has. Changes that cannot be read
    or belong to no entity go to a reject table, unless another job writes it.
    """
    if position is None:
        position = [c for c in POSITION if c in raw.columns]
    order = (entity.CHANGED, *position)

    def write(batch: DataFrame, label: str) -> None:
        if rejects:
            sinks.append_batch(rejected_changes(batch, position), f"{out}/lake/rejected_changes", label)
        changes = parse_changes(batch, position, entities)
        for kind in entities:
            table, key, parts = entity.TABLES[kind]
            versions = entity.route(changes, kind, keep=order)
            if lake:
                sinks.append_batch(versions, f"{out}/lake/{table}", label, parts)
            sinks.upsert_batch(
                entity.serving_columns(versions, kind), f"{out}/serving/{table}", [key], order, label,
                sinks.SERVING_DEFAULTS.get(table),
            )

    return _start(raw, checkpoint, trigger, write)


def start_lake(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    entities: Sequence[str] = (),
    trigger: Trigger = LIVE,
    position: Sequence[str] | None = None,
) -> StreamingQuery:
    """The lake log of one entity, with every version, by Spark's file sink.

    The sink keeps a log of its files, which it compacts, and readers list that instead of folders: neither a
    read nor a commit depends on the number of batches ever written. Text of other entities is not parsed.
    Rows of one partition of the table meet before they are written, or every task would write a file to each of them;
    a large one is still written by many tasks, by the sizes seen at run time. What was moved for that goes with its batch,
    and not when the driver happens to collect its garbage.
    """
    (kind,) = entities
    table, _, parts = entity.TABLES[kind]
    if position is None:
        position = [c for c in POSITION if c in raw.columns]
    versions = entity.route(parse_changes(raw, position, entities), kind, keep=(entity.CHANGED, *position))
    versions = versions.hint("rebalance", *parts) if parts else versions
    writer = versions.writeStream.format("parquet").option("path", f"{out}/lake/{table}")
    writer = writer.partitionBy(*parts) if parts else writer
    with set_for(raw.sparkSession, SHUFFLE_CLEANUP, "true"):  # the query keeps the settings it is started with
        return writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()


def start_all(
    event_log: Callable[[], DataFrame],
    change_log: Callable[[], DataFrame],
    out: str,
    checkpoints: str,
    trigger: Trigger | None = None,
) -> dict[str, StreamingQuery]:
    """All jobs, each reading its log on its own and keeping its own checkpoint.

    ``trigger`` is for all of them; without it each job has its own pace.

    The logs are given as functions that open a new stream, at the position the
    caller chose: the live end of a topic, or its beginning for a replay.
    """
    starts = {
        "bronze": lambda c: start_bronze(event_log(), out, c, trigger or LIVE),
        "validated": lambda c: start_validated(event_log(), out, c, trigger or LIVE, seen.REMEMBER),
        "sessions": lambda c: start_sessions(window_events(event_log()), out, c, trigger or SESSIONS_LIVE),
        "funnel": lambda c: start_funnel(window_events(event_log()), out, c, trigger or FUNNEL_LIVE),
        "dimensions": lambda c: start_changes(change_log(), out, c, trigger or LIVE, ("category", "user", "product"), lake=False),
        "facts": lambda c: start_changes(change_log(), out, c, trigger or LIVE, ("order", "order_item"), rejects=False, lake=False),
    }
    for kind in entity.TABLES:
        starts[f"lake_{kind}"] = lambda c, kind=kind: start_lake(change_log(), out, c, (kind,), trigger or LIVE)
    return {name: start(f"{checkpoints}/{name}") for name, start in starts.items()}
