"""Equality of two tables as bags of rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 4096
SUMS = ("high", "low", "high_2", "low_2")


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows whose number of copies differs, with ``surplus`` = left - right.

    Copies are counted in one aggregate over both sides, so a row repeated any
    number of times costs one row per task.
    """
    columns = left.columns
    sides = left.select(*columns, F.lit(1).alias("_side")).unionByName(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    counted = sides.groupBy(*columns).agg(F.sum("_side").alias("surplus"))
    return counted.where(F.col("surplus") != 0)


def compare(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: sizes of both sides and rows found on one side only."""
    columns = left.columns
    sides = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    counted = sides.groupBy(*columns).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    zero = F.lit(0)
    return counted.agg(
        F.lit(name).alias("table"),
        F.coalesce(F.sum("_l"), zero).alias("left_rows"),
        F.coalesce(F.sum("_r"), zero).alias("right_rows"),
        F.coalesce(F.sum(F.greatest(F.col("_l") - F.col("_r"), zero)), zero).alias("only_left"),
        F.coalesce(F.sum(F.greatest(F.col("_r") - F.col("_l"), zero)), zero).alias("only_right"),
    ).select("table", "left_rows", "right_rows", "only_left", "only_right")


def _hash(columns: Sequence[str], seed: int) -> Column:
    # Spark's hash passes over NULLs, so where they stand is hashed as well.
    return F.xxhash64(F.lit(seed), *[part for c in columns for part in (F.col(c), F.col(c).isNull())])


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(_hash(keys, 0), F.lit(buckets)).cast("int")


def digests(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """One row per bucket of the keys' hash: the number of its rows and sums of two 64-bit hashes of them.

    Sums don't depend on the order of rows and count each copy. They are made of halves of the hashes, so 2**31 rows of a bucket
    add up without overflow. Rows are summed before they are sent: at most ``buckets`` rows of a task. Digests can be
    stored with a table, and those of parts of a table add up.
    """
    halves = []
    for name, seed in (("", 1), ("_2", 2)):
        value = _hash(sorted(df.columns), seed)
        halves += [F.sum(F.shiftrightunsigned(value, 32)).alias(f"high{name}"),
                   F.sum(value.bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"low{name}")]
    return df.groupBy(bucket_of(keys, buckets).alias("bucket")).agg(F.count("*").alias("rows"), *halves)


def unequal_buckets(left: DataFrame, right: DataFrame) -> tuple[list[int], int]:
    """The buckets whose digests differ, at most as many as there are, and the number of rows of the equal ones."""
    same = reduce(Column.__and__, [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("rows", *SUMS)])
    both = left.alias("l").join(right.alias("r"), F.col("l.bucket") == F.col("r.bucket"), "full").select(
        F.coalesce("l.bucket", "r.bucket").alias("bucket"), F.coalesce(same, F.lit(False)).alias("same"), F.col("l.rows").alias("rows"))
    row = both.agg(F.collect_list(F.when(~F.col("same"), F.col("bucket"))), F.sum(F.when(F.col("same"), F.col("rows")))).first()
    return sorted(row[0]), row[1] or 0


def compare_by_digests(
    name: str, left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = BUCKETS,
    left_digests: DataFrame | None = None, right_digests: DataFrame | None = None,
) -> DataFrame:
    """As ``compare``, with the number of buckets that were compared row by row; the other rows are not shuffled.

    Digests that are not given are made first, in one pass without a shuffle of rows. Tables whose digests agree are not read
    again. A changed row lies in one bucket as long as its keys stay. Different rows pass for equal only where two
    64-bit sums of a bucket agree by chance.
    """
    found = [digests(df, keys, buckets) if given is None else given for df, given in ((left, left_digests), (right, right_digests))]
    unequal, equal_rows = unequal_buckets(*found)
    wanted = bucket_of(keys, buckets).isin(unequal) if unequal else F.lit(False)
    compared = compare(name, left.where(wanted), right.select(left.columns).where(wanted))
    return compared.withColumns({
        "left_rows": F.col("left_rows") + equal_rows, "right_rows": F.col("right_rows") + equal_rows,
        "unequal_buckets": F.lit(len(unequal)),
    })
