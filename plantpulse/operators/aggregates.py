"""Aggregates the engine does not have, written as sums, counts and comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.functions.values import ratio
from plantpulse.operators.ordered import TimeOrder
from plantpulse.operators.stretches import state_totals


def most_frequent(df: DataFrame, keys: Sequence[str], column: str, alias: str) -> DataFrame:
    """Most frequent value per key, the smallest on a tie; NULL values do not count.

    Values are counted first, so what is shuffled is one row per key and value.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct(-F.col("_n"), F.col(column).alias("_value")))
    return counts.groupBy(*keys).agg(best["_value"].alias(alias))


def transition_count(df: DataFrame, order: TimeOrder, state: str, target: float, alias: str) -> DataFrame:
    """Entries into a state per key; a missing or NULL previous state counts as another state."""
    totals = state_totals(df, order.keys, state, order=order)
    return totals.groupBy(*order.keys).agg(
        F.coalesce(F.sum(F.when(F.col(state) == target, F.col("entries"))), F.lit(0)).alias(alias))


def pooled_stddev(
    df: DataFrame, keys: Sequence[str], sd: str, mean: str, n: str, exact: bool = False
) -> DataFrame:
    """Merge groups given as (standard deviation, mean, count) into one per key.

    The deviations are taken as population values; ``exact`` takes them as sample values
    instead. A NULL deviation makes the result NULL. The mean comes first and the squares are
    taken around it, which keeps the digits when the mean is large.
    """
    totals = df.groupBy(*keys).agg(
        F.sum(n).alias("n"), ratio(F.sum(F.col(n) * F.col(mean)), F.sum(n)).alias("mean"))
    centred = df.select(*keys, F.col(sd).alias("_s"), F.col(mean).alias("_m"), F.col(n).alias("_n"))
    weight = F.col("_n") - (1 if exact else 0)
    spread = weight * F.pow("_s", F.lit(2)) + F.col("_n") * F.pow(F.col("_m") - F.col("mean"), F.lit(2))
    sums = centred.join(totals, list(keys)).groupBy(*keys).agg(
        F.first("n").alias("n"), F.first("mean").alias("mean"),
        F.sum(spread).alias("_square"), F.count_if(F.col("_s").isNull()).alias("_missing"))
    total = F.col("n") - (1 if exact else 0)
    value = F.sqrt(ratio(F.col("_square"), total))
    return sums.select(*keys, F.when(F.col("_missing") == 0, value).alias("stddev"), "mean", "n")


def histogram(df: DataFrame, keys: Sequence[str], value: Column, low: Column, high: Column, buckets: int) -> DataFrame:
    """Equal-width histogram per key: bucket 0 lies below ``low``, the last one from ``high`` on."""
    numbered = df.withColumn("_value", value).withColumn(
        "bucket", F.width_bucket(F.col("_value"), low, high, F.lit(buckets)))
    return numbered.where(F.col("_value").isNotNull()).groupBy(*keys, "bucket").agg(
        F.min("_value").alias("bucket_min"), F.max("_value").alias("bucket_max"),
        F.count(F.lit(1)).alias("frequency"))
