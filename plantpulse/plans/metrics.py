"""Metrics named by text, over a range or per recipe period.

A metric is ``table|column|aggregate|filter``. All metrics asked for become columns of one
aggregate, so periods and metrics cost one job together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.functions.values import ratio
from plantpulse.operators.joins import interval_join
from plantpulse.operators.ranges import Partials, range_totals

_AGGREGATES = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count, "stddev": F.stddev_samp}


@dataclass(frozen=True)
class MetricSpec:
    table: str
    column: str
    aggregate: str
    condition: str | None = None

    @property
    def label(self) -> str:
        return f"{self.aggregate}_{self.column}"

    def source(self) -> Column:
        return F.when(F.expr(self.condition), F.col(self.column)) if self.condition else F.col(self.column)

    def value(self) -> Column:
        return _AGGREGATES[self.aggregate](self.source()).cast("double")

    def partials(self, name: str) -> Partials:
        """Partial aggregates the value can be merged from."""
        source, add = self.source(), lambda n: F.sum(n)
        if self.aggregate in ("min", "max"):
            least = _AGGREGATES[self.aggregate]
            return {name: (least(source), least)}
        parts: Partials = {f"{name}_n": (F.count(source), add)}
        if self.aggregate in ("sum", "avg"):
            parts[f"{name}_s"] = (F.sum(source), add)
        return parts

    def merged(self, name: str) -> Column:
        if self.aggregate in ("min", "max"):
            value = F.col(name)
        elif self.aggregate == "avg":
            value = ratio(F.col(f"{name}_s"), F.col(f"{name}_n"))
        else:
            value = F.col(f"{name}_n" if self.aggregate == "count" else f"{name}_s")
        return value.cast("double")


def parse(text: str) -> MetricSpec:
    """Read a metric text; an unknown aggregate is refused."""
    table, column, aggregate, *rest = [x.strip() for x in text.split("|", 3)]
    aggregate = aggregate.lower()
    if aggregate not in _AGGREGATES:
        raise ValueError(f"unknown aggregate in metric: {text}")
    return MetricSpec(table, column, aggregate, rest[0] if rest and rest[0] else None)


def _named(specs: Sequence[MetricSpec]) -> list[Column]:
    return [s.value().alias(f"_m{i}") for i, s in enumerate(specs)]


def in_range(df: DataFrame, start: Column, end: Column, time: str = "time") -> DataFrame:
    return df.where(F.col(time).between(start, end))


def metric_one(df: DataFrame, spec: MetricSpec, start: Column, end: Column) -> DataFrame:
    """One metric over a closed range."""
    return in_range(df, start, end).agg(spec.value().alias("value"))


def metric_list(df: DataFrame, specs: Sequence[MetricSpec], start: Column, end: Column) -> DataFrame:
    """Several metrics over a closed range, one row each with position and label."""
    row = in_range(df, start, end).agg(*_named(specs))
    entries = F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(s.label).alias("label"), F.col(f"_m{i}").alias("value"))
        for i, s in enumerate(specs)])
    return row.select(F.inline(entries))


def metric_arrays(df: DataFrame, specs: Sequence[MetricSpec], keys: Sequence[str]) -> DataFrame:
    """Per key an array of metric names and an array of their values."""
    return _as_arrays(df.groupBy(*keys).agg(*_named(specs)), specs, keys)


def _as_arrays(sums: DataFrame, specs: Sequence[MetricSpec], keys: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(s.label) for s in specs])
    values = F.array(*[F.col(f"_m{i}") for i in range(len(specs))])
    return sums.select(*keys, names.alias("names"), values.alias("values"))


def unnest_arrays(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Unfold names and values in step."""
    pairs = F.arrays_zip(F.col("names").alias("name"), F.col("values").alias("value"))
    return df.select(*keys, F.inline(pairs)).toDF(*keys, "name", "value")


def metric_columns(df: DataFrame, specs: Sequence[MetricSpec], keys: Sequence[str], columns: int = 0) -> DataFrame:
    """Per key the metrics as d1, d2 and so on, ``columns`` of them or as many as there are metrics.

    A column without a metric is 0, a NULL metric stays NULL.
    """
    return _as_columns(df.groupBy(*keys).agg(*_named(specs)), specs, keys, columns)


def _as_columns(sums: DataFrame, specs: Sequence[MetricSpec], keys: Sequence[str], columns: int) -> DataFrame:
    wide = [
        (F.col(f"_m{i}") if i < len(specs) else F.lit(0.0)).alias(f"d{i + 1}") for i in range(max(columns, len(specs)))]
    return sums.select(*keys, *wide)


def in_periods(df: DataFrame, periods: DataFrame, on: Sequence[str] = ("serial",)) -> DataFrame:
    """Rows of a table inside the periods, with the period's recipe and bounds."""
    bounds = periods.select(*on, F.col("recipe").alias("period_recipe"), "time_from", "time_to")
    return interval_join(df, bounds, list(on), "time_from", "time_to")


PERIOD_KEYS = ["serial", "period_recipe", "time_from", "time_to"]
#: Aggregates that partial ones merge into.
_MERGEABLE = {"sum", "avg", "min", "max", "count"}


def period_sums(df: DataFrame, periods: DataFrame, specs: Sequence[MetricSpec], on: Sequence[str] = ("serial",)) -> DataFrame:
    """The metrics of each recipe period, as columns ``_m0``, ``_m1`` and so on.

    Metrics that merge come from sums by hour and day, and rows are met only in the broken hours at a period's
    ends. With a standard deviation among the metrics all of them are taken from the rows inside.
    """
    if not {s.aggregate for s in specs} <= _MERGEABLE:
        return in_periods(df, periods, on).groupBy(*PERIOD_KEYS).agg(*_named(specs))
    bounds = periods.select(*on, F.col("recipe").alias("period_recipe"), "time_from", "time_to")
    partials: Partials = {}
    for i, spec in enumerate(specs):
        partials |= spec.partials(f"_p{i}")
    totals = range_totals(df, bounds, list(on), "time_from", "time_to", partials)
    return totals.select(*PERIOD_KEYS, *[s.merged(f"_p{i}").alias(f"_m{i}") for i, s in enumerate(specs)])


def metric_per_period(df: DataFrame, periods: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """Arrays of metric names and values for each recipe period."""
    return _as_arrays(period_sums(df, periods, specs), specs, PERIOD_KEYS)


def metric_per_period_wide(df: DataFrame, periods: DataFrame, specs: Sequence[MetricSpec], columns: int = 0) -> DataFrame:
    """Metrics as columns for each recipe period."""
    return _as_columns(period_sums(df, periods, specs), specs, PERIOD_KEYS, columns)
