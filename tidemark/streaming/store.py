"""Tables that a job writes batch by batch and that stay cheap to read.

Each batch is a run, a folder of its own. As soon as ``FANOUT`` runs of one level lie there, the job merges them into one run
of the next level. So a table of n batches has less than ``FANOUT`` runs on each of its log(n) levels, whatever its age, and
a row is written again once per level.

One small file, the head, names the runs that count, the last batch of each query, and the schema. It is replaced in one
step: readers see a batch, or a merge, wholly or not at all. A batch that is written again after a failure is left out if the
head has it, and otherwise writes over what is left of it. Later commits have greater versions, on any query and checkpoint.
A table has one writer at a time. Runs that a merge replaced are kept until the next merge, for readers that are under way.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

FANOUT = 8
VERSION = "batch"
HEAD = "_head.json"


class Run(NamedTuple):
    name: str
    level: int


class Head(NamedTuple):
    """What a table consists of. ``done`` has the last batch of each query, ``old`` the runs the last merge replaced."""

    version: int = 0
    schema: str = ""
    runs: tuple[Run, ...] = ()
    done: dict[str, int] = {}  # noqa: RUF012  (never changed)
    old: tuple[str, ...] = ()


def batch_of(label: str) -> tuple[str, int]:
    """The query and the number of a batch, from a label that ends in its number; other labels are batches of their own."""
    query, _, number = label.rpartition("-")
    return (query, int(number)) if query and number.isdigit() else (label, 0)


def merges(runs: Sequence[Run], version: int, fanout: int = FANOUT) -> list[tuple[tuple[Run, ...], Run]]:
    """The merges due: which runs become which one. A merge may fill the next level, which is then merged as well."""
    due, live, level = [], list(runs), 0
    while len(same := tuple(r for r in live if r.level == level)) >= fanout:
        merged = Run(f"run-{version:09d}-{level + 1}", level + 1)
        due.append((same, merged))
        live = [r for r in live if r.level != level] + [merged]
        level += 1
    return due


def _file(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text_file(spark: SparkSession, path: str) -> str | None:
    at, files = _file(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name, then rename it over the old one."""
    at, files = _file(spark, path)
    new, _ = _file(spark, f"{path}.new")
    stream = files.create(new, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    over[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration()).rename(
        files.makeQualified(new), files.makeQualified(at), over)


def load(spark: SparkSession, path: str) -> Head | None:
    text = read_text_file(spark, f"{path}/{HEAD}")
    if text is None:
        return None
    raw = json.loads(text)
    return Head(raw["version"], raw["schema"], tuple(Run(*r) for r in raw["runs"]), raw["done"], tuple(raw["old"]))


def _rows(spark: SparkSession, path: str, runs: Sequence[Run], schema: str) -> DataFrame:
    kind = T.StructType.fromJson(json.loads(schema))
    return spark.read.schema(kind).parquet(*[f"{path}/{r.name}" for r in runs]) if runs else spark.createDataFrame([], kind)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the runs that count, a key's versions unresolved, with the version of their commit."""
    head = load(spark, path)
    if head is None:
        raise FileNotFoundError(f"no table at {path}")
    return _rows(spark, path, head.runs, head.schema)


def commit(
    df: DataFrame,
    path: str,
    label: str,
    merge: Callable[[DataFrame], DataFrame],
    lookups: Sequence[str] = (),
    fanout: int = FANOUT,
) -> bool:
    """Add a batch, and merge what is due; false if the table has this batch.

    ``merge`` makes one run's rows of those of several, and may be applied again to its own result. Columns of
    ``lookups`` get Bloom filters in merged runs, so a read of single keys skips most files.
    """
    spark = df.sparkSession
    head = load(spark, path) or Head()
    query, number = batch_of(label)
    if number <= head.done.get(query, -1):
        return False
    version = head.version + 1
    rows = df.withColumn(VERSION, F.lit(f"{version:015d}"))
    known = T.StructType.fromJson(json.loads(head.schema)).fields if head.schema else []
    names = {f.name for f in known}
    schema = T.StructType([*known, *(f for f in rows.schema.fields if f.name not in names)])
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]).json()
    run = Run(f"run-{version:09d}-0", 0)
    rows.write.mode("overwrite").parquet(f"{path}/{run.name}")
    runs, dropped = (*head.runs, run), []
    for same, merged in merges(runs, version, fanout):
        writer = merge(_rows(spark, path, same, schema)).write.mode("overwrite")
        for column in lookups:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.parquet(f"{path}/{merged.name}")
        runs = (*(r for r in runs if r not in same), merged)
        dropped += [r.name for r in same]
    new = Head(version, schema, runs, {**head.done, query: number}, tuple(dropped) or head.old)
    replace_text_file(spark, f"{path}/{HEAD}", json.dumps(new._asdict()))
    for name in head.old if dropped else ():
        at, files = _file(spark, f"{path}/{name}")
        files.delete(at, True)
    return True
