"""Rollups kept up to date: as a stream, by refreshing a window, and joined with open rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plantpulse.functions.time import bucket
from plantpulse.plans.weighing import HOUR, HOURLY_KEYS, rollup, rollup_measures
from plantpulse.session import discard
from plantpulse.session import stored as stored_rows
from plantpulse.sources.sinks import write_by

DAY = 86_400
_TIMES = ["filling_first_time", "filling_last_time", "first_time", "last_time"]


def stream_rollup(
    weights: DataFrame, keys: Sequence[str] = HOURLY_KEYS, window: str = "1 hour", late: str = "10 days"
) -> DataFrame:
    """The weight rollup over a stream. In append mode a bucket appears once it is closed.

    ``late`` is how long a bucket stays open for late rows.
    """
    boxes = weights.where(F.col("net").isNotNull()).withColumn("time", F.col("time").cast("timestamp"))
    sums = boxes.withWatermark("time", late).groupBy(*keys, F.window("time", window)).agg(
        *[e.alias(name) for name, e in rollup_measures().items()])
    return sums.withColumns({c: F.col(c).cast("timestamp_ntz") for c in _TIMES}).withColumn(
        "bucket", F.col("window.start").cast("timestamp_ntz")).drop("window")


def write_stream(df: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append closed results to a folder, taking all data that is available now."""
    writer = df.writeStream.outputMode("append").format("parquet")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)


def stored_rollup(weights: DataFrame, folder: str, keys: Sequence[str] = HOURLY_KEYS) -> None:
    """Store the hourly rollup, one folder per day."""
    write_by(_by_day(rollup(weights, keys, HOUR)), folder, "day")


def _by_day(rollups: DataFrame) -> DataFrame:
    return rollups.withColumn("day", F.to_date("bucket"))


def refresh_window(
    weights: DataFrame, folder: str, start: Column, end: Column, keys: Sequence[str] = HOURLY_KEYS
) -> None:
    """Compute the hourly buckets that lie wholly in ``[start, end]`` again.

    Only the days touched are read and replaced. Buckets of these days outside the window keep
    what was stored.
    """
    hour = F.make_dt_interval(secs=F.lit(HOUR))

    def inside(at: Column) -> Column:
        return (at >= start) & (at + hour <= end)

    spark = weights.sparkSession
    stored = spark.read.parquet(folder)
    days = F.col("day").between(F.to_date(start), F.to_date(end))
    kept = stored.where(days & ~inside(F.col("bucket")))
    # The bound on the stored time reaches the scan; the one on the bucket leaves whole hours.
    rows = weights.where((F.col("time") >= start) & (F.col("time") < end) & inside(bucket("time", HOUR)))
    fresh = _by_day(rollup(rows, keys, HOUR))
    # The new days are complete elsewhere before the stored ones are replaced.
    whole, made = stored_rows(kept.unionByName(fresh), "refresh")
    write_by(whole, folder, "day", replace=True)
    discard(spark, made)


def note_touched(rows: DataFrame, ledger: str, run: int) -> None:
    """Note the hourly buckets that newly delivered rows fall into, under the number of the delivery.

    A delivery that is repeated notes the same again.
    """
    touched = rows.where(F.col("time").isNotNull()).select(bucket("time", HOUR).alias("bucket")).distinct()
    touched.write.mode("overwrite").parquet(f"{ledger}/run={run}")


def _spans(days: Sequence[date]) -> list[tuple[date, date]]:
    """Days put together into spans: first day, and the day after the last one."""
    spans: list[tuple[date, date]] = []
    for day in sorted(days):
        if spans and spans[-1][1] == day:
            spans[-1] = (spans[-1][0], day + timedelta(days=1))
        else:
            spans.append((day, day + timedelta(days=1)))
    return spans


def refresh_touched(weights: DataFrame, folder: str, ledger: str, keys: Sequence[str] = HOURLY_KEYS) -> list[date]:
    """Compute the hourly buckets that the ledger names again, and empty the ledger; the days that were replaced.

    Only the days of touched buckets are read, of the rows and of what is stored, and only their folders are
    replaced. The ledger is emptied last, so a refresh that was broken off is done again by the next one.
    """
    spark = weights.sparkSession
    # Runs that come while this one works stay for the next one.
    noted = spark.read.schema("bucket timestamp_ntz, run int").parquet(ledger)
    runs = [r["run"] for r in noted.select("run").distinct().collect()]
    touched = noted.where(F.col("run").isin(runs)).select("bucket").distinct()
    # One date for each day, whatever the number of rows.
    days = [r["day"] for r in touched.select(F.to_date("bucket").alias("day")).distinct().collect()]
    if not days:
        return []
    # As bounds on the stored time, which reach the scan.
    inside = F.lit(False)
    for first, after in _spans(days):
        inside = inside | ((F.col("time") >= F.lit(first).cast("timestamp_ntz")) & (F.col("time") < F.lit(after).cast("timestamp_ntz")))
    rows = weights.where(inside).withColumn("bucket", bucket("time", HOUR)).join(touched, "bucket", "left_semi").select(*weights.columns)
    fresh = _by_day(rollup(rows, keys, HOUR))
    kept = spark.read.schema(fresh.schema).parquet(folder).where(F.col("day").isin(days)).join(touched, "bucket", "left_anti")
    whole, made = stored_rows(fresh.unionByName(kept), "refresh")
    write_by(whole, folder, "day", replace=True)
    discard(spark, made, *[f"{ledger}/run={run}" for run in runs])
    return sorted(days)


def realtime_union(
    stored: DataFrame, rows: DataFrame, cutoff: Column, aggregate: Callable[[DataFrame], DataFrame],
    time: str = "time",
) -> DataFrame:
    """Stored buckets before ``cutoff`` together with the aggregate of the rows from it on."""
    return stored.where(F.col("bucket") < cutoff).unionByName(aggregate(rows.where(F.col(time) >= cutoff)))
