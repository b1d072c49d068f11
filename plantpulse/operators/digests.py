"""Mergeable digests: how many different values, and which most often, without keeping the values.

A digest row holds, for a key and a time bucket, the row count, a distinct-count sketch per column and a frequent-item sketch per
column. Rows of one key and bucket merge into one, in any order and any number of steps, so deliveries are digested
once and longer periods are answered from the digests. NULL values don't count. A distinct count is as good as exact
for up to some hundred values, and beyond has a standard error of 1.04 / sqrt(2 ** LG_CELLS). A frequent-item sketch is exact
while it has met no more than ``TRACKED`` different values; beyond, a count may be too high by about rows / ``TRACKED``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.functions.time import bucket

LG_CELLS = 12
TRACKED = 1000


def _tracked(c: str) -> Column:
    return F.expr(f"approx_top_k_accumulate(CAST(`{c}` AS STRING), {TRACKED}) FILTER (WHERE `{c}` IS NOT NULL)")


def digest(
    df: DataFrame, keys: Sequence[str], seconds: int, distinct: Sequence[str] = (), frequent: Sequence[str] = (), time: str = "time"
) -> DataFrame:
    """Digests of rows by key and time bucket: ``n``, ``distinct_<column>`` and ``frequent_<column>``. Values are taken as text."""
    return df.groupBy(*keys, bucket(time, seconds).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), LG_CELLS).alias(f"distinct_{c}") for c in distinct],
        *[_tracked(c).alias(f"frequent_{c}") for c in frequent])


def combine(digests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One digest for each value of the keys, which may leave out ``bucket`` or some of the digests' keys."""
    sketches = [c for c in digests.columns if c.startswith("distinct_")]
    items = [c for c in digests.columns if c.startswith("frequent_")]
    return digests.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        *[F.hll_union_agg(c).alias(c) for c in sketches],
        *[F.expr(f"approx_top_k_combine(`{c}`, {TRACKED})").alias(c) for c in items])


def answers(digests: DataFrame) -> DataFrame:
    """What the digests say: counts in place of ``distinct_<column>``, and in place of ``frequent_<column>`` the most frequent value
    as text (the smallest on a tie, NULL without a value) and, in ``times_<column>``, how often it came."""

    def most(c: str) -> list[Column]:
        found = F.expr(f"approx_top_k_estimate(`{c}`, {TRACKED})")
        times = F.array_max(F.transform(found, lambda e: e["count"]))
        best = F.filter(found, lambda e: e["count"] == F.array_max(F.transform(found, lambda x: x["count"])))
        return [F.array_min(F.transform(best, lambda e: e["item"])).alias(c), F.coalesce(times, F.lit(0)).alias(f"times_{c.removeprefix('frequent_')}")]

    columns: list[Column] = []
    for c in digests.columns:
        if c.startswith("distinct_"):
            columns.append(F.hll_sketch_estimate(c).alias(c))
        elif c.startswith("frequent_"):
            columns += most(c)
        else:
            columns.append(F.col(c))
    return digests.select(*columns)


def store_digests(folder: str, make: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Step of a stream: write the digests of each micro-batch under its number, so a batch that is run again counts once."""

    def step(batch: DataFrame, number: int) -> None:
        make(batch).write.mode("overwrite").parquet(f"{folder}/run={number}")

    return step
