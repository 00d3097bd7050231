"""Joins whose large side may hold one key in a large share of its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def salted_join(
    large: DataFrame, lookup: DataFrame, on: str, spread_by: Sequence[str], salts: int = 32
) -> DataFrame:
    """Inner equi-join with a lookup table, each key split over ``salts`` tasks.

    Rows of ``large`` are spread by a hash of ``spread_by``; each row of
    ``lookup`` is repeated once per salt. Exact for any key distribution, and
    the same row gets the same salt if a task is run again.
    """
    spread = large.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [on, "_salt"]).drop("_salt")
