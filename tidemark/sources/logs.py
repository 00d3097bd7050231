"""The two input logs: click events and entity changes.

A log is a DataFrame with a text column ``value``, batch or streaming. Where it
comes from is the caller's choice: a message broker, text files or a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..contracts import Contract
from ..operators.changes import ROUTES
from .decode import decode, rejects, undecodable

# Payload fields of the two logs.
EVENT_FIELDS = ("event_id", "event_type", "user_id", "session_id", "product_id", "timestamp", "metadata")
WINDOW_FIELDS = ("event_id", "event_type", "user_id", "session_id", "product_id", "timestamp")
CHANGE_FIELDS = (
    "entity_type", "timestamp",
    "category_id", "cat_name", "parent_category_id",
    "user_id", "user_name", "user_email", "user_city", "registered_date", "user_status", "updated_at",
    "product_id", "product_name", "price", "product_status", "created_at",
    "order_id", "order_user_id", "order_total", "order_status", "order_created_at", "order_date",
    "order_item_id", "order_item_order_id", "quantity", "unit_price", "line_total",
)
EVENT_TOPIC = "raw-events"
CHANGE_TOPIC = "entity-updates"


def broker_options(brokers: str, topic: str, from_beginning: bool = False, **extra: str) -> dict[str, str]:
    """Reader options of a topic; a new consumer starts at either end of it."""
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest" if from_beginning else "latest",
        **extra,
    }


def contract_options(contract: Contract, brokers: str, from_beginning: bool = False) -> dict[str, str]:
    """The same options, taken from the broker entry of a contract."""
    server = contract.server("kafka")
    config = dict(server.get("config", {}))
    start = {}
    for when, usual in (("default", "latest"), ("backfill", "earliest")):
        other = config.pop(f"scan.startup.mode.{when}", usual)  # another name of the same setting
        start[when] = config.pop(f"startingOffsets.{when}", other).removesuffix("-offset")
    # Client settings have a prefix here; how to read JSON is not the broker's business.
    config = {f"kafka.{k.removeprefix('properties.')}" if k.startswith("properties.") else k: v
              for k, v in config.items() if not k.startswith("json.")}
    options = broker_options(brokers, server["topic"], from_beginning, **config)
    options["startingOffsets"] = start["backfill" if from_beginning else "default"]
    return options


def read_broker(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """A topic as text with its position. Needs the connector on the class path."""
    reader = spark.readStream if streaming else spark.read
    if not streaming and options.get("startingOffsets", "latest") == "latest":
        options = {**options, "startingOffsets": "earliest"}  # a batch cannot begin at the live end
    log = reader.format("kafka").options(**options).load()
    return log.select(
        F.col("value").cast("string").alias("value"),
        F.col("partition").alias("log_partition"),
        F.col("offset").alias("log_offset"),
    )


def read_text(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """A log kept as text files with one record per line."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("text").options(**options).load(path)


def parse_events(raw: DataFrame, fields: tuple[str, ...] = EVENT_FIELDS) -> DataFrame:
    return decode(raw, fields)


def rejected_text(raw: DataFrame) -> DataFrame:
    return undecodable(raw, EVENT_FIELDS)


def rejected_changes(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Changes no route takes: the text of unreadable ones and of those without a known entity type."""
    return rejects(raw, CHANGE_FIELDS, "entity_type", tuple(ROUTES), "unknown entity", keep=keep)


def parse_changes(
    raw: DataFrame, keep: Sequence[str] = (), entities: Sequence[str] | None = None
) -> DataFrame:
    """Entity changes, one wide record each; parsed once for all entity types.

    With ``entities`` records of other types are left unparsed and only the
    fields of these types are read. The type is in the text as a quoted word,
    unless the text spells characters as escapes.
    """
    fields = CHANGE_FIELDS
    if entities:
        used = {f for e in entities for f in ROUTES[e]}
        fields = [f for f in CHANGE_FIELDS if f in used or f in ("entity_type", "timestamp")]
        named = [F.col("value").contains(f'"{e}"') for e in entities]
        raw = raw.where(reduce(or_, named, F.col("value").contains("\\u")))
    return decode(raw, fields, keep=keep)
