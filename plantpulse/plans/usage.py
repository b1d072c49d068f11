"""Usage of dashboards: hourly counts and screened capture of usage events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.functions.text import is_safe
from plantpulse.functions.time import bucket


def usage_hourly(log: DataFrame, by_dashboard: bool = False, category: str = "Dashboard") -> DataFrame:
    """Refreshes per hour and organisation, or per hour, organisation and dashboard."""
    keys = ["organization", "dashboard"] if by_dashboard else ["organization"]
    visits = log.where(F.col("category") == category)
    return visits.groupBy(bucket("logtime", 3600).alias("hour"), *keys).agg(F.count("*").alias("refreshes"))


def screened(events: DataFrame, text: str) -> DataFrame:
    """Add ``accepted``: whether the text of an event is free of unsafe parts."""
    return events.withColumn("accepted", is_safe(F.col(text)) == 1)


def capture(events: DataFrame, text: str, folder: str) -> DataFrame:
    """Append the accepted events to the log folder and return the rejected ones."""
    checked = screened(events, text)
    checked.where("accepted").drop("accepted").write.mode("append").parquet(folder)
    return checked.where("NOT accepted").drop("accepted")
