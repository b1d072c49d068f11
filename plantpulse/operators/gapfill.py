"""Time buckets over a whole range, also where there is no data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.functions.time import bucket, micros
from plantpulse.operators.ordered import TimeOrder, carry, with_next
from plantpulse.session import staged
from plantpulse.sources.series import numbered


def _sums(df: DataFrame, keys: Sequence[str], seconds: int, measures: dict[str, Column], time: str) -> DataFrame:
    """Aggregates of the buckets that hold rows; stored, as several steps go on from them."""
    sums = df.groupBy(*keys, bucket(time, seconds).alias("bucket")).agg(
        *[e.alias(name) for name, e in measures.items()])
    return staged(sums, "buckets")


def _step(seconds: int) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds))


def _buckets(low: str, high: str, seconds: int) -> Column:
    """Number of the last bucket between two bucket starts; negative if there is none."""
    return F.floor((micros(high) - micros(low)) / F.lit(seconds * 1_000_000))


def gapfill(
    df: DataFrame, keys: Sequence[str], seconds: int, measures: dict[str, Column], time: str = "time"
) -> DataFrame:
    """Bucket aggregates with a row for every bucket of the table's range.

    An empty bucket has NULL measures. With keys, every key gets all buckets.
    """
    sums = _sums(df, keys, seconds, measures, time)
    low, high = sums.agg(F.min("bucket")).scalar(), sums.agg(F.max("bucket")).scalar()
    start = sums.select(*keys).distinct() if keys else df.sparkSession.range(1)
    bounds = start.select(*keys, low.alias("_low"), high.alias("_high"))
    spine = numbered(bounds, _buckets("_low", "_high", seconds)).select(
        *keys, (F.col("_low") + F.make_dt_interval(secs=F.col("i") * seconds)).alias("bucket"))
    return spine.join(sums, [*keys, "bucket"], "left")


def gapfill_carried(
    df: DataFrame, keys: Sequence[str], seconds: int, measures: dict[str, Column], time: str = "time"
) -> DataFrame:
    """Bucket aggregates where an empty bucket repeats the last value before it.

    Each bucket that holds rows is repeated up to the next one, so no join is needed. Buckets
    before the first one of a key are NULL.
    """
    sums = _sums(df, keys, seconds, measures, time)
    low, high = sums.agg(F.min("bucket")).scalar(), sums.agg(F.max("bucket")).scalar()
    order, step = TimeOrder(keys=keys, time="bucket", tie=()), _step(seconds)
    carried = carry(order.sliced(sums), order, **{name: name for name in measures})
    ends = with_next(carried, order, _next="bucket").withColumn("_until", F.coalesce(F.col("_next") - step, high))
    filled = numbered(ends, _buckets("bucket", "_until", seconds)).select(
        *keys, (F.col("bucket") + F.make_dt_interval(secs=F.col("i") * seconds)).alias("bucket"), *measures)
    first = sums.groupBy(*keys).agg(F.min("bucket").alias("_first")).select(*keys, low.alias("_low"), (F.col("_first") - step).alias("_last_empty"))
    leading = numbered(first, _buckets("_low", "_last_empty", seconds)).select(
        *keys, (F.col("_low") + F.make_dt_interval(secs=F.col("i") * seconds)).alias("bucket"))
    return filled.unionByName(leading, allowMissingColumns=True)
