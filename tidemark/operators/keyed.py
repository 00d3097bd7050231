"""One row per key.

The winner is found by an aggregate, not by ranking a window: each task keeps
one candidate per key before the exchange, so a key that owns a large share of
the rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _extreme(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], pick) -> DataFrame:
    # Remaining columns break ties, so the result does not depend on row order.
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    winner = pick(F.struct(*order_by, *rest)).alias("_winner")
    picked = df.groupBy(*keys).agg(winner)
    return picked.select(*[
        F.col(c) if c in keys else F.col(f"_winner.{c}").alias(c) for c in df.columns
    ])


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` of each key (NULL sorts lowest)."""
    return _extreme(df, keys, order_by, F.max)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order_by`` of each key (NULL sorts lowest)."""
    return _extreme(df, keys, order_by, F.min)
