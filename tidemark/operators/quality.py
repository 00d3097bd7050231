"""Contract rules evaluated on a table, and consistency checks between tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..contracts import Contract
from ..functions.time import moment

_UNITS = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days"}


def _interval(text: str) -> timedelta:
    amount, unit = re.fullmatch(r"(\d+)\s*([smhd])", text).groups()
    return timedelta(**{_UNITS[unit]: int(amount)})


def _row_rules(contract: Contract) -> dict[tuple[str, str], Column]:
    """(rule, subject) -> condition that is true for a violating row."""
    rules: dict[tuple[str, str], Column] = {}
    for name in contract.required:
        rules["required", name] = F.col(name).isNull()
    for column in contract.columns:
        name = column["name"]
        for rule in column.get("quality", ()):
            if rule["type"] == "notNull":
                rules["notNull", name] = F.col(name).isNull()
            elif rule["type"] in ("enumeration", "enum"):
                # A missing value is the business of notNull.
                rules["enumeration", name] = ~F.col(name).isin(*rule["values"])
            elif rule["type"] != "uniqueness":
                raise ValueError(f"contract {contract.id}: unknown rule type {rule['type']!r} of {name}")
    for rule in contract.rules:
        if rule["type"] == "notNull":
            for name in rule["columns"]:
                rules["notNull", name] = F.col(name).isNull()
        elif rule["type"] == "custom":
            # Some contracts write the condition as the description.
            condition = rule.get("expression") or rule.get("description")
            if not condition:
                raise ValueError(f"contract {contract.id}: a custom rule without a condition")
            rules["custom", rule.get("name", condition)] = ~F.expr(condition)
        elif rule["type"] not in ("rowCount", "freshness"):
            raise ValueError(f"contract {contract.id}: unknown rule type {rule['type']!r}")
    return rules


def _time_column(contract: Contract) -> str:
    """The column freshness is about where the rule names none."""
    named = contract.tagged("governance:timestamp") or [
        c["name"] for c in contract.columns if c["type"].upper().startswith("TIMESTAMP")
    ]
    if not named:
        raise ValueError(f"contract {contract.id}: freshness needs a column")
    return named[0]


def _unique_columns(contract: Contract) -> list[str]:
    return [
        c["name"] for c in contract.columns
        if any(q["type"] == "uniqueness" for q in c.get("quality", ()))
    ]


def _result(rule: str, subject: str, violations: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"), F.lit(subject).alias("subject"), violations.cast("bigint").alias("violations")
    )


def check(df: DataFrame, contract: Contract, as_of: datetime | None = None) -> DataFrame:
    """One row per rule: table, rule, subject, violations, passed.

    All row rules, the row count and the freshness come from a single pass.
    Uniqueness counts rows beyond the first of each value. Freshness is checked
    against ``as_of``; without it ``violations`` and ``passed`` are NULL. Rules
    of unknown type raise. A rule that evaluates to NULL for
    a row is not violated by it.
    """
    results = []
    for (rule, subject), broken in _row_rules(contract).items():
        results.append(_result(rule, subject, F.count_if(broken)))
    for rule in contract.rules:
        if rule["type"] == "rowCount":
            short = F.count("*") <= rule["mustBeGreaterThan"]
            results.append(_result("rowCount", "*", F.when(short, 1).otherwise(0)))
        elif rule["type"] == "freshness":
            column = rule.get("column") or _time_column(contract)
            stale = F.lit(None)
            if as_of is not None:
                oldest = moment(as_of - _interval(rule["interval"]))
                stale = F.when(F.max(column) >= oldest, 0).otherwise(1)
            results.append(_result("freshness", column, stale))
    parts = []
    if results:
        parts.append(df.agg(F.array(*results).alias("_results")).select(F.inline("_results")))
    for name in _unique_columns(contract):
        copies = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("_n"))
        extra = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
        parts.append(copies.agg(F.array(_result("uniqueness", name, extra)).alias("_r")).select(F.inline("_r")))
    if not parts:
        raise ValueError(f"contract {contract.id} declares no rules")
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(contract.id).alias("table"), "rule", "subject", "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a parent and how many rows use each.

    Child rows are counted per key first, so the join sees each key once. A
    NULL foreign key refers to nothing and is not an orphan.
    """
    used = (
        child.where(F.col(foreign_key).isNotNull())
        .groupBy(F.col(foreign_key).alias("missing_key"))
        .agg(F.count("*").alias("child_rows"))
    )
    known = parent.select(F.col(key).alias("missing_key"))
    return used.join(known, "missing_key", "left_anti")


def integrity(relations: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Orphan totals, one row per (name, child, foreign key, parent, key)."""
    parts = [
        orphans(child, fk, parent, key).agg(
            F.lit(name).alias("relation"),
            F.count("*").alias("orphan_keys"),
            F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphan_rows"),
        ).select("relation", "orphan_keys", "orphan_rows")
        for name, child, fk, parent, key in relations
    ]
    return reduce(DataFrame.unionByName, parts)


def reconcile_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose total is not the sum of their lines.

    ``status`` is ``mismatch``, ``no items`` or ``no order``. Lines are summed
    per order before the join.
    """
    lines = items.groupBy("order_id").agg(F.sum("line_total").alias("items_total"))
    both = orders.select("order_id", F.col("total").alias("order_total"), F.lit(True).alias("_order")).join(
        lines.withColumn("_items", F.lit(True)), "order_id", "full_outer"
    )
    status = (
        F.when(F.col("_order").isNull(), "no order")
        .when(F.col("_items").isNull(), "no items")
        .when(~F.col("order_total").eqNullSafe(F.col("items_total")), "mismatch")
    )
    return both.select("order_id", "order_total", "items_total", status.alias("status")).where(
        F.col("status").isNotNull()
    )
