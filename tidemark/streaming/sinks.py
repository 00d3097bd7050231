"""Lake and serving sinks that are safe to repeat.

``foreachBatch`` may run a batch again after a failure. Every write below
replaces what an earlier run of the same batch wrote, so a repeat changes
nothing. A batch is named after its query's start, its checkpoint and its
number, hence another checkpoint never overwrites the batches of this one, and
names sort as the batches were made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.keyed import last_per_key
from . import store

BATCH = store.VERSION
BASE = "-base"
# Rows per statement of the relational serving tables.
FLUSH_ROWS = {
    "session_metrics": 100, "product_funnel_1m": 200, "categories": 100, "users": 100, "products": 100,
    "orders": 100, "order_items": 200,
}
# Defaults of the serving tables.
SERVING_DEFAULTS: dict[str, dict[str, Any]] = {
    "session_metrics": {"event_count": 0, "page_views": 0, "add_to_carts": 0, "purchases": 0, "converted": False},
    "product_funnel_1m": {"page_views": 0, "add_to_carts": 0, "purchases": 0},
    "users": {"status": "active"},
    "products": {"status": "active"},
    "orders": {"status": "completed"},
}


def started(spark: SparkSession, checkpoint: str) -> int:
    """When the checkpoint was made: the time of the file that holds its query's id, which is never written again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getFileStatus(path).getModificationTime()


def batch_label(checkpoint: str, batch_id: int, since: int = 0) -> str:
    """Sorts by the start of the query, then by batch."""
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    return f"{since:015d}-{run}-{batch_id:012d}"


def append_batch(df: DataFrame, path: str, label: str, partition_by: Sequence[str] = ()) -> None:
    """Append one batch to a Parquet table, replacing an earlier run of the same batch.

    Rows stay in the tasks that hold them: a date with most of the rows is
    written by many tasks.
    """
    (
        df.withColumn(BATCH, F.lit(label))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, BATCH)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table with the result of a batch.

    The rebalance keeps small partitions in few files and splits large ones
    over many tasks, by the sizes seen at run time.
    """
    writer = df.hint("rebalance", *partition_by) if partition_by else df
    writer.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_table(df: DataFrame, table: str) -> None:
    """Append to a catalog table of a format with its own commits."""
    df.writeTo(table).append()


def with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    known = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in df.columns}
    return df.withColumns(known)


def upsert_batch(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    label: str,
    defaults: Mapping[str, Any] | None = None,
) -> None:
    """Record one batch of a keyed table: the last row of each key, without NULL keys.

    The batch is written, and merged with earlier ones in levels; ``read_serving`` resolves a key across those.
    """
    keyed = df.dropna(subset=list(keys))
    latest = with_defaults(last_per_key(keyed, keys, order_by), defaults or {})
    store.commit(latest, path, label, lambda rows: last_per_key(rows, keys, [*order_by, BATCH]), keys)


def read_serving(
    spark: SparkSession, path: str, keys: Sequence[str], order_by: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Current rows of a keyed table: the greatest ``order_by`` wins, then the later batch.

    With ``schema`` (of the rows) a table that was never written has no rows; without it there is none to read.
    A filter on the keys is applied before the rows of a key meet, and skips files that can't have it.
    """
    if schema is not None and store.load(spark, path) is None:
        return spark.createDataFrame([], schema)
    return last_per_key(store.read(spark, path), keys, [*order_by, BATCH]).drop(BATCH)


def compact_serving(
    spark: SparkSession, path: str, target: str, keys: Sequence[str], order_by: Sequence[str]
) -> None:
    """Write the current rows to a new folder as its first run. Rows of later batches win over equal ones of it."""
    if store.load(spark, target) is not None:
        raise FileExistsError(f"there is a table at {target}")
    upsert_batch(read_serving(spark, path, keys, order_by), target, keys, order_by, BASE)


def merge_statement(
    target: str, source: str, keys: Sequence[str], columns: Sequence[str], order_by: Sequence[str] = ()
) -> str:
    """MERGE for tables that support it: as in ``read_serving``, the greater ``order_by`` stays.

    NULL sorts lowest. A table of keys only has nothing to update.
    """
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sets = ", ".join(f"{c} = s.{c}" for c in columns if c not in keys)
    names, values = ", ".join(columns), ", ".join(f"s.{c}" for c in columns)
    newer = "1 = 1"  # of equal ones the later batch counts
    for c in reversed(order_by):
        newer = (f"(s.{c} > t.{c} OR (t.{c} IS NULL AND s.{c} IS NOT NULL) OR "
                 f"((s.{c} = t.{c} OR (s.{c} IS NULL AND t.{c} IS NULL)) AND {newer}))")
    condition = f" AND {newer}" if order_by else ""
    update = f"WHEN MATCHED{condition} THEN UPDATE SET {sets} " if sets else ""
    return (
        f"MERGE INTO {target} t USING {source} s ON {on} {update}"
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def staging_options(url: str, table: str, **options: str) -> dict[str, str]:
    """Writer options of the staging table of a relational serving table."""
    rows = FLUSH_ROWS.get(table, 100)
    return {"url": url, "dbtable": f"{table}_staging", "batchsize": str(rows), "truncate": "true", **options}


def write_staging(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Fill the staging table; the database merges it with ``merge_statement``."""
    df.write.format("jdbc").mode("overwrite").options(**staging_options(url, table, **options)).save()
