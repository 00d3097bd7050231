"""Lifetime totals per user, in full or by merging new sessions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# How each column of the mergeable state combines.
_MERGE = {
    "total_sessions": F.sum,
    "total_events": F.sum,
    "total_page_views": F.sum,
    "total_add_to_carts": F.sum,
    "total_purchases": F.sum,
    "total_duration_seconds": F.sum,
    "first_activity_date": F.min,
    "last_activity_date": F.max,
    "is_converted": F.bool_or,
}


def user_state(sessions: DataFrame) -> DataFrame:
    """Per-user sums and extremes. Holds the duration as a sum, so states can be merged."""
    return sessions.groupBy("user_id").agg(
        F.count("*").alias("total_sessions"),
        F.sum("event_count").alias("total_events"),
        F.sum("page_views").alias("total_page_views"),
        F.sum("add_to_carts").alias("total_add_to_carts"),
        F.sum("purchases").alias("total_purchases"),
        F.sum("session_duration_seconds").alias("total_duration_seconds"),
        F.min("session_date").alias("first_activity_date"),
        F.max("session_date").alias("last_activity_date"),
        F.bool_or("converted").alias("is_converted"),
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """Combine the states of disjoint sets of sessions into one row per user."""
    return reduce(DataFrame.unionByName, states).groupBy("user_id").agg(*[how(c).alias(c) for c, how in _MERGE.items()])


def user_360(state: DataFrame) -> DataFrame:
    """Gold table from a state. The average duration is fractional."""
    average = F.col("total_duration_seconds").cast("double") / F.col("total_sessions").cast("double")
    return state.select(
        "user_id", "total_sessions", "total_events", "total_page_views", "total_add_to_carts",
        "total_purchases", average.alias("avg_session_duration_seconds"),
        "first_activity_date", "last_activity_date", "is_converted",
    )
