"""Entity changes: one wide log in, five typed tables out, with their history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.time import cell_start, moment, parse_timestamp
from .keyed import last_per_key

MONEY = "decimal(10,2)"
CHANGED = "change_ts"
# Payload field -> column and type, per entity.
ROUTES: dict[str, dict[str, tuple[str, str]]] = {
    "category": {
        "category_id": ("category_id", "string"),
        "cat_name": ("name", "string"),
        "parent_category_id": ("parent_category_id", "string"),
    },
    "user": {
        "user_id": ("user_id", "string"),
        "user_name": ("name", "string"),
        "user_email": ("email", "string"),
        "user_city": ("city", "string"),
        "registered_date": ("registered_date", "date"),
        "user_status": ("status", "string"),
        "updated_at": ("updated_at", "timestamp_ntz"),
    },
    "product": {
        "product_id": ("product_id", "string"),
        "product_name": ("name", "string"),
        "category_id": ("category_id", "string"),
        "price": ("price", MONEY),
        "product_status": ("status", "string"),
        "created_at": ("created_at", "timestamp_ntz"),
    },
    "order": {
        "order_id": ("order_id", "string"),
        "order_user_id": ("user_id", "string"),
        "order_total": ("total", MONEY),
        "order_status": ("status", "string"),
        "order_created_at": ("created_at", "timestamp_ntz"),
        "order_date": ("order_date", "date"),
    },
    "order_item": {
        "order_item_id": ("order_item_id", "string"),
        "order_item_order_id": ("order_id", "string"),
        "product_id": ("product_id", "string"),
        "quantity": ("quantity", "int"),
        "unit_price": ("unit_price", MONEY),
        "line_total": ("line_total", MONEY),
        "order_date": ("order_date", "date"),
    },
}
# Table name, key and lake partitioning per entity.
TABLES = {
    "category": ("categories", "category_id", ()),
    "user": ("users", "user_id", ("registered_date",)),
    "product": ("products", "product_id", ("category_id",)),
    "order": ("orders", "order_id", ("order_date",)),
    "order_item": ("order_items", "order_item_id", ("order_date",)),
}
# Columns the serving tables fill themselves.
SERVING_DROPS = {"user": ("updated_at",), "product": ("created_at",)}


def _typed(text: str, kind: str, formats: Sequence[str]) -> Column:
    if kind == "string":
        return F.col(text)
    if kind == "timestamp_ntz":
        return parse_timestamp(F.col(text), tuple(formats))
    return F.col(text).try_cast(kind)


def route(
    changes: DataFrame,
    entity: str,
    keep: Sequence[str] = (),
    formats: Sequence[str] = ("millis",),
) -> DataFrame:
    """Versions of one entity. A value that does not fit its type is NULL.

    ``keep`` adds ordering columns: ``change_ts``, the time of the message, and
    any column the parsed log carries, such as its offset.
    """
    columns = [_typed(f, kind, formats).alias(name) for f, (name, kind) in ROUTES[entity].items()]
    order = [
        parse_timestamp(F.col("timestamp"), tuple(formats)).alias(CHANGED) if c == CHANGED else F.col(c)
        for c in keep
    ]
    return changes.where(F.col("entity_type") == entity).select(*columns, *order)


def serving_columns(versions: DataFrame, entity: str) -> DataFrame:
    return versions.drop(*SERVING_DROPS.get(entity, ()))


def current(log: DataFrame, key: str, order_by: Sequence[str] = (CHANGED,)) -> DataFrame:
    """Latest version of each key."""
    return last_per_key(log, [key], order_by)


def as_of(log: DataFrame, key: str, at: datetime, order_by: Sequence[str] = (CHANGED,)) -> DataFrame:
    """Latest version of each key known at ``at``."""
    known = log.where(F.col(order_by[0]) <= moment(at))
    return last_per_key(known, [key], order_by)


def history(
    log: DataFrame,
    key: str,
    changed: str = CHANGED,
    tie_break: Sequence[str] = (),
    cell: timedelta = timedelta(hours=1),
) -> DataFrame:
    """Validity range of each version: ``[valid_from, valid_to)``, open for the current one.

    Of versions with the same change time the last one counts. Ranges are
    ordered inside (key, cell), where at most one row per representable instant
    is left, and the first change of the next cell closes the last range of a
    cell. So no key is ordered as a whole, however often it changed. A change
    without a key or a time belongs to no history.
    """
    log = log.where(F.col(key).isNotNull() & F.col(changed).isNotNull())
    versions = last_per_key(log, [key, changed], tie_break)
    versions = versions.withColumn("_cell", cell_start(changed, cell))
    in_cell = Window.partitionBy(key, "_cell").orderBy(changed)

    timeline = Window.partitionBy(key).orderBy("_cell")
    cells = (
        versions.groupBy(key, "_cell")
        .agg(F.min(changed).alias("_first"))
        .withColumn("_next_cell", F.lead("_first").over(timeline))
        .select(key, "_cell", "_next_cell")
    )
    ranged = versions.withColumn("_next", F.lead(changed).over(in_cell)).join(cells, [key, "_cell"])
    return ranged.withColumns({
        "valid_from": F.col(changed),
        "valid_to": F.coalesce("_next", "_next_cell"),
        "is_current": F.coalesce("_next", "_next_cell").isNull(),
    }).drop("_cell", "_next", "_next_cell")


def at_own_time(
    facts: DataFrame,
    log: DataFrame,
    key: str,
    time: str,
    changed: str = CHANGED,
    tie_break: Sequence[str] = (),
    cell: timedelta = timedelta(hours=1),
) -> DataFrame:
    """Each fact with ``version``, the row of ``log`` that was valid for its key at the fact's own time.

    That is the last version changed at or before it; of those with the same time the greatest ``tie_break`` counts.
    ``version`` is NULL where there was none yet, and for facts without a key or a time. No fact is lost or repeated.

    Facts meet the versions of their own (key, cell) and the one version carried into it, found over cells and not over
    rows: no key is ordered as a whole, neither its facts nor its versions, and a (key, cell) with very many facts can be
    split by the join. Choose ``cell`` so that a key changes a few times in it at most. Facts are shuffled once.
    """
    known = log.where(F.col(key).isNotNull() & F.col(changed).isNotNull())
    versions = last_per_key(known, [key, changed], tie_break).select(
        F.col(key).alias("_key"), cell_start(changed, cell).alias("_cell"), F.col(changed).alias("_from"),
        F.lit(1).alias("_own"), F.struct(*log.columns).alias("version"))
    # Cells leave out rows without a time, so such facts are put into one, where no version matches them.
    some_time = F.coalesce(F.col(time), moment(datetime(1970, 1, 1)))
    placed = facts.select(F.struct("*").alias("fact"), F.col(key).alias("_fact_key"), F.col(time).alias("_time"),
                          cell_start(some_time, cell).alias("_fact_cell"))
    # What is carried into a cell with facts: the last version of the cells before it.
    asked = placed.where("_fact_key IS NOT NULL AND _time IS NOT NULL").groupBy(
        F.col("_fact_key").alias("_key"), F.col("_fact_cell").alias("_cell")).agg(F.lit(True).alias("_asked"))
    lasts = versions.groupBy("_key", "_cell").agg(F.max_by(F.struct("_from", "version"), "_from").alias("_last"))
    before = Window.partitionBy("_key").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        lasts.join(asked, ["_key", "_cell"], "full")
        .withColumn("_carried", F.last("_last", ignorenulls=True).over(before))
        .where("_asked AND _carried IS NOT NULL")
        .select("_key", "_cell", F.col("_cell").alias("_from"), F.lit(0).alias("_own"), F.col("_carried.version"))
    )
    # A version that starts with the cell leaves the carried one an empty range.
    ordered = Window.partitionBy("_key", "_cell").orderBy("_from", "_own")
    ranges = versions.unionByName(carried).withColumn("_to", F.lead("_from").over(ordered))
    valid = (
        (F.col("_fact_key") == F.col("_key")) & (F.col("_fact_cell") == F.col("_cell"))
        & (F.col("_from") <= F.col("_time")) & (F.col("_to").isNull() | (F.col("_time") < F.col("_to")))
    )
    return placed.join(ranges, valid, "left").select("fact.*", "version")
