"""Metrics over semantic models.

A semantic model names the entity keys, dimensions and measures of a table. A metric is
answered by grouping that table at the asked grain. Measures are always recomputed from rows at the
grain of the question: distinct counts and ratios of finer results do not add up.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martmill.functions.columns import date_shift, safe_ratio
from martmill.operators.joins import join_full, join_on_spine
from martmill.operators.partials import Rollup
from martmill.session import materialise

PERIOD = "period"
Grain = str | None


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str  # "sum" or "count_distinct"
    expr: str


@dataclass
class SemanticModel:
    """``links`` maps an entity to the model that holds its attributes."""

    table: DataFrame
    time: str
    measures: Sequence[Measure]
    entities: dict[str, str] = field(default_factory=dict)
    dimensions: dict[str, str] = field(default_factory=dict)
    links: dict[str, "SemanticModel"] = field(default_factory=dict)

    def measure(self, name: str) -> Measure:
        for m in self.measures:
            if m.name == name:
                return m
        raise KeyError(f"no measure {name!r}")


def period_of(day: Column, grain: str) -> Column:
    if grain == "day":
        return day.cast("date")
    if grain in ("week", "month", "quarter", "year"):
        return F.trunc(day, grain)
    raise ValueError(f"unknown grain {grain!r}")


def _aggregate(m: Measure) -> Column:
    if m.agg == "sum":
        return F.sum(F.expr(m.expr))
    if m.agg == "count_distinct":
        return F.countDistinct(F.expr(m.expr))
    raise ValueError(f"unknown aggregate {m.agg!r}")


def _rows(model: SemanticModel, group_by: Sequence[str], start: dt.date | None, end: dt.date | None) -> DataFrame:
    """Rows in ``[start, end]`` with the asked dimensions as columns, linked models joined in by key."""
    df = bounded(model.table.withColumn("_day", F.expr(model.time).cast("date")), "_day", start, end)
    for name in group_by:
        if name in model.entities:
            df = df.withColumn(name, F.expr(model.entities[name]))
        elif name in model.dimensions:
            df = df.withColumn(name, F.expr(model.dimensions[name]))
    for entity, other in model.links.items():
        wanted = [n for n in group_by if n in other.dimensions and n not in model.dimensions]
        if wanted:
            attributes = other.table.select(
                F.expr(other.entities[entity]).alias("_link"), *[F.expr(other.dimensions[n]).alias(n) for n in wanted]
            )
            df = df.join(attributes, F.expr(model.entities[entity]) == F.col("_link"), "left").drop("_link")
    return df


def measures(
    model: SemanticModel,
    named: Mapping[str, str],
    grain: Grain = None,
    group_by: Sequence[str] = (),
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Measures (result name to measure name) by period and dimensions, in one aggregation."""
    rows = _rows(model, group_by, start, end)
    keys = list(group_by)
    if grain:
        rows = rows.withColumn(PERIOD, period_of(F.col("_day"), grain))
        keys = [PERIOD, *keys]
    return rows.groupBy(*keys).agg(*[_aggregate(model.measure(m)).alias(name) for name, m in named.items()])


def cube(
    model: SemanticModel,
    named: Mapping[str, str],
    sets: Mapping[str, tuple[Grain, Sequence[str]]],
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Measures for several groupings at once, each a grain and dimensions; ``grouping`` names the one a row belongs to.

    The table is read once: it is reduced to the parts of its figures by day and all dimensions, and every grouping adds up
    the stored parts. Distinct counts stay exact, as their parts are sets.
    """
    dimensions = list(dict.fromkeys(d for _, dims in sets.values() for d in dims))
    chosen = {name: model.measure(m) for name, m in named.items()}
    rollup = Rollup(
        ["_day", *dimensions],
        sums={name: m.expr for name, m in chosen.items() if m.agg == "sum"},
        distinct={name: m.expr for name, m in chosen.items() if m.agg == "count_distinct"},
    )
    parts = materialise(rollup.parts(_rows(model, dimensions, start, end)), "cube-parts")
    keys = {}
    for label, (grain, dims) in sets.items():
        keys[label] = {PERIOD: period_of(F.col("_day"), grain) if grain else F.lit(None).cast("date"), **{d: F.col(d) for d in dims}}
    return rollup.at_sets(parts, keys).select("grouping", PERIOD, *dimensions, *named)


def spine_periods(spine: DataFrame, grain: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """The calendar's periods at a grain, from a one-column frame of days."""
    spine = bounded(spine, spine.columns[0], start, end)
    periods = spine.select(period_of(F.col(spine.columns[0]), grain).alias(PERIOD))
    return periods if grain == "day" else periods.distinct()


def bounded(df: DataFrame, day: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """Rows whose day lies in ``[start, end]``; None leaves a side open."""
    if start is not None:
        df = df.filter(F.col(day) >= F.lit(start))
    return df if end is None else df.filter(F.col(day) <= F.lit(end))


def period_offset(metric: DataFrame, n: int, unit: str, names: Mapping[str, str]) -> DataFrame:
    """A metric's value ``n`` periods earlier, its value columns renamed.

    Whole periods are shifted, after aggregation, and matched by key: a gap in the data leaves a
    gap in the result instead of moving older values up.
    """
    return metric.withColumn(PERIOD, date_shift(PERIOD, unit, n)).withColumnsRenamed(dict(names))


def offset_on_spine(
    by_period: DataFrame, periods: DataFrame, n: int, unit: str, value: str, earlier: str, group_by: Sequence[str] = ()
) -> DataFrame:
    """Each calendar period with the value of that period and the one ``n`` periods earlier.

    With dimensions, the rows are those groups and periods for which either value exists.
    """
    past = period_offset(by_period, n, unit, {value: earlier})
    if not group_by:
        return join_on_spine(join_on_spine(periods, by_period, PERIOD), past, PERIOD)
    # Calendar periods are few by nature, so they are broadcast and the values stay where they are.
    return join_full(by_period, past, [PERIOD, *group_by]).join(F.broadcast(periods), PERIOD, "left_semi")


def ratio(df: DataFrame, numerator: str, denominator: str, name: str) -> DataFrame:
    """Two metrics of the same rows divided; no or zero denominator gives NULL."""
    return df.withColumn(name, safe_ratio(F.col(numerator).cast("double"), F.col(denominator).cast("double")))


def to_date_cumulative(
    daily: DataFrame,
    value: str,
    spine: DataFrame,
    name: str,
    grain: str = "month",
    group_by: Sequence[str] = (),
    fill: object = 0,
) -> DataFrame:
    """Running total of a daily metric that starts anew with each period of ``grain``.

    Without dimensions every spine day has a row, ``fill`` standing in before the first value. With
    dimensions a group has rows from its first value in a period to the end of that period
    (or of the spine): each daily value is carried up to the group's next one, so groups and
    days are never multiplied out. A window partition holds the days of one period.
    """
    first = period_of(F.col(PERIOD), grain)
    if not group_by:
        dense = join_on_spine(spine_periods(spine, "day"), daily, PERIOD)
        running = Window.partitionBy(first).orderBy(PERIOD).rowsBetween(Window.unboundedPreceding, 0)
        total = F.sum(F.coalesce(F.col(value), F.lit(fill))).over(running)
        return dense.select(PERIOD, total.alias(name))
    months = {"month": 1, "quarter": 3, "year": 12}[grain]
    by_group = Window.partitionBy(*group_by, first).orderBy(PERIOD)
    total = F.sum(F.coalesce(F.col(value), F.lit(fill))).over(by_group.rowsBetween(Window.unboundedPreceding, 0))
    next_day = F.coalesce(F.lead(PERIOD).over(by_group), F.add_months(first, months))
    steps = daily.select(*group_by, PERIOD, total.alias(name), next_day.alias("_until"))
    carried = steps.select(
        *group_by, F.explode(F.sequence(F.col(PERIOD), F.date_sub("_until", 1))).alias(PERIOD), name
    )
    # Days are few by nature, so they are broadcast and the carried values stay where they are.
    return carried.join(F.broadcast(spine_periods(spine, "day")), PERIOD, "left_semi").select(PERIOD, *group_by, name)
