"""Business metrics over the gold tables: a request names a cube, measures and dimensions."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import safe_ratio
from ..functions.time import truncate


@dataclass(frozen=True)
class Measure:
    """``kind`` is count, sum, avg, count_distinct or number (a ratio of two measures)."""

    kind: str
    of: Callable[[], Column] | str | None = None
    ratio: tuple[str, str] | None = None

    def column(self) -> Column:
        return F.col(self.of) if isinstance(self.of, str) else self.of()


@dataclass(frozen=True)
class Cube:
    table: str
    dimensions: Mapping[str, str]
    measures: Mapping[str, Measure]


# The metric definitions.
CUBES: dict[str, Cube] = {
    "session_metrics": Cube(
        table="gold.session_metrics",
        dimensions={
            "session_id": "string", "user_id": "string", "session_start": "time",
            "session_end": "time", "converted": "boolean", "session_date": "time",
        },
        measures={
            "count": Measure("count"),
            "total_sessions": Measure("count_distinct", "session_id"),
            "avg_session_duration_seconds": Measure("avg", "session_duration_seconds"),
            "total_page_views": Measure("sum", "page_views"),
            "total_add_to_carts": Measure("sum", "add_to_carts"),
            "total_purchases": Measure("sum", "purchases"),
            "converted_sessions": Measure("sum", lambda: F.when(F.col("converted"), 1).otherwise(0)),
            "conversion_rate": Measure("number", ratio=("converted_sessions", "count")),
        },
    ),
    "product_funnel_1m": Cube(
        table="gold.product_funnel_1m",
        dimensions={"product_id": "string", "window_start": "time", "window_end": "time"},
        measures={
            "count": Measure("count"),
            "total_page_views": Measure("sum", "page_views"),
            "total_add_to_carts": Measure("sum", "add_to_carts"),
            "total_purchases": Measure("sum", "purchases"),
        },
    ),
    "user_360": Cube(
        table="gold.user_360",
        dimensions={
            "user_id": "string", "is_converted": "boolean",
            "first_activity_date": "time", "last_activity_date": "time",
        },
        measures={
            "count": Measure("count"),
            "total_sessions": Measure("sum", "total_sessions"),
            "total_events": Measure("sum", "total_events"),
            "total_purchases": Measure("sum", "total_purchases"),
            # Mean of the users' means: every user weighs the same.
            "avg_session_duration_seconds": Measure("avg", "avg_session_duration_seconds"),
        },
    ),
}


def _aggregate(measure: Measure) -> Column:
    if measure.kind == "count":
        return F.count("*")
    if measure.kind == "sum":
        return F.sum(measure.column())
    if measure.kind == "avg":
        return F.avg(measure.column())
    if measure.kind == "count_distinct":
        return F.count_distinct(measure.column())
    raise ValueError(f"{measure.kind!r} is not an aggregate")


def _dimensions(cube: Cube, names: Sequence[str], grain: str | None) -> list[Column]:
    columns = []
    for name in names:
        if name not in cube.dimensions:
            raise KeyError(f"no dimension {name!r}")
        timed = grain and cube.dimensions[name] == "time"
        column = truncate(F.col(name), grain) if timed else F.col(name)
        # The grain travels with the column, so that a rollup knows its own.
        columns.append(column.alias(name, metadata={"grain": grain}) if timed else column.alias(name))
    return columns


#: Coarser grains that hold each grain whole; weeks lie across months.
NESTS = {
    "second": ("minute", "hour", "day", "week", "month", "quarter", "year"),
    "minute": ("hour", "day", "week", "month", "quarter", "year"),
    "hour": ("day", "week", "month", "quarter", "year"),
    "day": ("week", "month", "quarter", "year"),
    "week": (),
    "month": ("quarter", "year"),
    "quarter": ("year",),
    "year": (),
}


def _base_measures(cube: Cube, names: Sequence[str]) -> dict[str, Measure]:
    """The aggregates a request needs: its own and those its ratios are made of."""
    needed: dict[str, Measure] = {}
    for name in names:
        if name not in cube.measures:
            raise KeyError(f"no measure {name!r}")
        measure = cube.measures[name]
        for part in measure.ratio or (name,):
            needed[part] = cube.measures[part]
    return needed


def _finish(grouped: DataFrame, cube: Cube, measures: Sequence[str], dimensions: Sequence[str]) -> DataFrame:
    derived = {
        name: safe_ratio(*(F.col(p) for p in cube.measures[name].ratio))
        for name in measures if cube.measures[name].ratio
    }
    return grouped.withColumns(derived).select(*dimensions, *measures)


def query(
    table: DataFrame,
    cube: str,
    measures: Sequence[str],
    dimensions: Sequence[str] = (),
    where: Column | str | None = None,
    grain: str | None = None,
) -> DataFrame:
    """Measures by dimensions from a gold table. ``grain`` truncates time dimensions."""
    model = CUBES[cube]
    rows = table if where is None else table.where(where)
    aggregates = [_aggregate(m).alias(n) for n, m in _base_measures(model, measures).items()]
    grouped = rows.groupBy(*_dimensions(model, dimensions, grain)).agg(*aggregates)
    return _finish(grouped, model, measures, dimensions)


#: Sketches have two to this power registers. Estimates are off by 0.65 % on average; see ``sketch_bound``.
SKETCH_BITS = 14


def sketch_bound(deviations: float = 3.0) -> float:
    """The relative error that an estimate keeps within, by so many standard deviations: 2.5 % for three.

    1.04 / sqrt(registers) is the bound for sketches that were merged; those of one task are better.
    """
    return deviations * 1.04 / 2 ** (SKETCH_BITS / 2)


def pre_aggregate(
    table: DataFrame, cube: str, dimensions: Sequence[str], grain: str | None = None, sketches: bool = False
) -> DataFrame:
    """A rollup later requests can re-aggregate: counts and sums, an average as sum and count.

    Distinct counts do not add up and are left out, unless ``sketches`` keeps a mergeable sketch of at most
    some 10 KB for each, from which they can be estimated.
    """
    model = CUBES[cube]
    parts = []
    for name, measure in model.measures.items():
        if measure.kind in ("count", "sum"):
            parts.append(_aggregate(measure).alias(name))
        elif measure.kind == "avg":
            parts.append(F.sum(measure.column()).alias(f"{name}__sum"))
            parts.append(F.count(measure.column()).alias(f"{name}__count"))
        elif measure.kind == "count_distinct" and sketches:
            parts.append(F.hll_sketch_agg(measure.column(), SKETCH_BITS).alias(f"{name}__sketch"))
    return table.groupBy(*_dimensions(model, dimensions, grain)).agg(*parts)


def query_rollup(
    rollup: DataFrame,
    cube: str,
    measures: Sequence[str],
    dimensions: Sequence[str] = (),
    where: Column | str | None = None,
    grain: str | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Answer a request from a rollup that holds its dimensions at the same or a finer grain.

    A request for a grain the rollup's own does not nest in raises. So does a distinct count, unless ``approximate`` takes an
    estimate for it, made of the rollup's sketches, see ``sketch_bound``.
    """
    model = CUBES[cube]
    missing = [d for d in dimensions if d not in rollup.columns]
    if missing:
        raise KeyError(f"the rollup has no {', '.join(missing)}")
    for name in dimensions:
        own = rollup.schema[name].metadata.get("grain")
        if own and grain != own and grain not in NESTS.get(own, ()):
            raise ValueError(f"the rollup holds {name} by {own}, which {grain or 'the finest grain'} cannot be made of")
    aggregates = []
    for name, measure in _base_measures(model, measures).items():
        if measure.kind == "count_distinct":
            if not approximate or f"{name}__sketch" not in rollup.columns:
                raise ValueError(f"{name} cannot be re-aggregated from a rollup")
            estimate = F.hll_sketch_estimate(F.hll_union_agg(f"{name}__sketch"))
            # Without groups and rows there is no sketch to merge, and no value to count.
            aggregates.append(F.coalesce(estimate, F.lit(0)).cast("long").alias(name))
            continue
        if measure.kind == "avg":
            total, n = F.sum(f"{name}__sum"), F.sum(f"{name}__count")
            aggregates.append(safe_ratio(total, n).alias(name))
        else:
            aggregates.append(F.sum(name).alias(name))
    rows = rollup if where is None else rollup.where(where)
    grouped = rows.groupBy(*_dimensions(model, dimensions, grain)).agg(*aggregates)
    return _finish(grouped, model, measures, dimensions)


def store_rollup(rollup: DataFrame, root: str, cube: str, name: str) -> str:
    """Store a pre-aggregate where ``answer`` finds it; the grain is kept with its columns."""
    path = f"{root}/{cube}/{name}"
    rollup.write.mode("overwrite").parquet(path)
    return path


def answer(
    table: DataFrame,
    cube: str,
    measures: Sequence[str],
    dimensions: Sequence[str] = (),
    where: str | None = None,
    grain: str | None = None,
    rollups: Sequence[DataFrame] = (),
    approximate: bool = False,
) -> DataFrame:
    """Answer a request from the first rollup that covers it, else from the gold table.

    A rollup covers a request if it has the dimensions at a grain the asked one is made of, no measure is a distinct
    count, and the filter names its untruncated dimensions only. With ``approximate`` a rollup with sketches covers
    distinct counts as well.
    """
    for rollup in rollups:
        try:
            if where:
                timed = {f.name for f in rollup.schema if "grain" in f.metadata}
                # A name inside a literal counts too, which costs a hit at most.
                named = {c for c in rollup.columns if re.search(rf"\b{c}\b", where)}
                if named & timed or not named <= set(CUBES[cube].dimensions):
                    continue
            return query_rollup(rollup, cube, measures, dimensions, where, grain, approximate)
        except (KeyError, ValueError, AnalysisException):
            continue
    return query(table, cube, measures, dimensions, where, grain)

