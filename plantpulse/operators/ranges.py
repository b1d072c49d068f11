"""Aggregates over many time ranges from a hierarchy of buckets.

Rows are summed up once by key and hour, and hours by day. A range is then the merge of the whole days inside it, the
whole hours before and after these, and the single rows in the broken hours at its two ends. So a row is met by as
many ranges as have an end in its hour, not by all ranges it lies in.

Measures are given as partial aggregates with the way to merge them: sums and counts are added, the lowest of minima and the
highest of maxima stand.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.functions.time import micros
from plantpulse.session import staged

HOUR = 3_600_000_000
HOURS_A_DAY = 24

#: Name of a partial aggregate: its aggregate over rows, and how partial ones are merged.
Partials = dict[str, tuple[Column, Callable[[str], Column]]]


def _number(at: Column, width: int) -> Column:
    """How many widths lie before a time."""
    return F.floor((at - F.pmod(at, F.lit(width))) / F.lit(width)).cast("long")


def _numbers(first: Column, after: Column) -> Column:
    """All whole numbers from ``first`` up to the one before ``after``; none if there are none."""
    return F.when(first < after, F.sequence(first, after - 1)).otherwise(F.array().cast("array<bigint>"))


def range_totals(
    df: DataFrame, ranges: DataFrame, on: Sequence[str], start: str, end: str, partials: Partials, time: str = "time",
) -> DataFrame:
    """The columns of ``ranges`` with the merged ``partials`` of the rows inside each closed range that shares the keys.

    Ranges without a row have no row. Equal ranges are one.
    """
    own = ranges.columns
    hour = _number(micros(time), HOUR)
    hours = staged(df.groupBy(*on, hour.alias("_bucket")).agg(*[e.alias(n) for n, (e, _) in partials.items()]), "hours")
    merge = [m(n).alias(n) for n, (_, m) in partials.items()]
    days = hours.groupBy(*on, F.floor(F.col("_bucket") / HOURS_A_DAY).alias("_bucket")).agg(*merge)
    a, b = micros(start), micros(end)
    # Whole hours and days inside: from the first one that begins in the range to the last one that ends in it.
    first_hour, after_hours = _number(a + (HOUR - 1), HOUR), _number(b, HOUR)
    first_day, after_days = F.ceil(first_hour / F.lit(HOURS_A_DAY)), F.floor(after_hours / F.lit(HOURS_A_DAY))
    some_days = first_day < after_days
    asked = ranges.where(F.col(start) <= F.col(end)).distinct().withColumns({
        "_days": _numbers(first_day, after_days),
        "_hours": F.when(some_days, F.concat(_numbers(first_hour, first_day * HOURS_A_DAY), _numbers(after_days * HOURS_A_DAY, after_hours)))
        .otherwise(_numbers(first_hour, after_hours)),
        # Broken hours: those of both ends, or all that are touched where no whole hour lies inside.
        "_edges": F.when(first_hour < after_hours, F.array_distinct(F.concat(_numbers(_number(a, HOUR), first_hour), F.array(after_hours))))
        .otherwise(_numbers(_number(a, HOUR), after_hours + 1)),
    })

    def whole(table: DataFrame, buckets: str) -> DataFrame:
        wanted = asked.select(*own, F.explode(buckets).alias("_bucket"))
        return wanted.join(table, [*on, "_bucket"]).select(*own, *partials)

    names = {c: f"_range_{c}" for c in own if c not in on}
    edges = asked.select(*own, F.explode("_edges").alias("_bucket")).withColumnsRenamed(names)
    rows = df.withColumn("_bucket", hour).join(edges, [*on, "_bucket"])
    rows = rows.where(F.col(time).between(F.col(names[start]), F.col(names[end])))
    singles = rows.groupBy(*[names.get(c, c) for c in own]).agg(*[e.alias(n) for n, (e, _) in partials.items()])
    singles = singles.withColumnsRenamed({v: k for k, v in names.items()}).select(*own, *partials)
    parts = whole(days, "_days").unionByName(whole(hours, "_hours")).unionByName(singles)
    return parts.groupBy(*own).agg(*merge)
