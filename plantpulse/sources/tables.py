"""Scans of telemetry tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, time: str = "time") -> Column:
    """The latest time of a table, as a one-value subquery."""
    return df.agg(F.max(time)).scalar()


def time_range(df: DataFrame, start: str, end: str, columns: Sequence[str], time: str = "time") -> DataFrame:
    """Rows in a closed time range; filter and columns reach the file scan."""
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    return df.where(F.col(time).between(lo, hi)).select(*columns)


def recent(
    df: DataFrame, as_of: Column, minutes: int = 10, limit: int | None = None, time: str = "time", tie: str = "uuid",
    most_minutes: int | None = None,
) -> DataFrame:
    """Rows after ``as_of`` minus some minutes, oldest first.

    With ``limit`` the first ones only, with ``most_minutes`` those of a span of at most that length.
    """
    minutes = minutes if most_minutes is None else min(minutes, most_minutes)
    found = df.where(F.col(time) > as_of - F.make_dt_interval(mins=F.lit(minutes))).orderBy(time, tie)
    return found if limit is None else found.limit(limit)


def latest_snapshot(df: DataFrame, time: str = "time") -> DataFrame:
    """All rows that carry the newest time."""
    return df.where(F.col(time) == newest(df, time))


def tenants(parts: dict[str, DataFrame]) -> DataFrame:
    """One table of all tenants' copies; add ``tenant`` to the keys of what follows."""
    tables = [df.withColumn("tenant", F.lit(name)) for name, df in parts.items()]
    result = tables[0]
    for df in tables[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result
