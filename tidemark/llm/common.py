"""Small helpers of the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import work_path

SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def space_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text that isn't null."""
    return F.array_remove(F.split(text, "[ \\t-\\r]+"), "")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """The rows, written once to the shared folder in buckets of the key: joins on it do not move them again."""
    spark, table = df.sparkSession, f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.format("parquet").bucketBy(n, key).option("path", work_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def shared(rows: DataFrame, *key: str) -> DataFrame:
    """The rows whose key several rows have, with their ``count``.

    They are merged: Spark takes what a generator makes of a row for one row, and would broadcast many times its limit.
    """
    several = rows.groupBy(*key).count().where("count > 1")
    return rows.join(several.hint("merge"), list(key))


def packed(docs: DataFrame, *columns: Column) -> DataFrame:
    """All columns of a row as one struct ``row``, beside ``columns``: names can't clash."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *columns)
