"""Joins over time: inside periods, as of a moment, and lookups with a fallback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.functions.text import general_key
from plantpulse.functions.time import micros
from plantpulse.operators.ordered import TimeOrder, carry, carry_both


def interval_join(
    facts: DataFrame, periods: DataFrame, on: Sequence[str], start: str, end: str,
    time: str = "time", width_seconds: int = 86_400,
) -> DataFrame:
    """Rows of ``facts`` inside the closed periods that share their keys.

    Both sides get a time bucket, so the join is an equi-join over (keys, bucket) and a busy key
    is spread over its buckets. A period is repeated once per bucket it touches; a fact matches
    a period only in the fact's own bucket, so no pair appears twice.
    """
    width = F.lit(width_seconds * 1_000_000)

    def number(at: Column) -> Column:
        return (micros(at) - F.pmod(micros(at), width)) / width

    steps = F.sequence(number(F.col(start)).cast("bigint"), number(F.col(end)).cast("bigint"))
    spread = periods.where(F.col(start) <= F.col(end)).withColumn("_bucket", F.explode(steps))
    placed = facts.withColumn("_bucket", number(F.col(time)).cast("bigint"))
    inside = F.col(time).between(F.col(start), F.col(end))
    return placed.join(spread, [*on, "_bucket"]).where(inside).drop("_bucket")


def asof(
    probes: DataFrame, rows: DataFrame, on: Sequence[str], values: dict[str, str],
    forward: bool | str = False, time: str = "time", tie: str = "uuid",
) -> DataFrame:
    """Per probe the last row at or before its time, or the first one at or after it (``forward``).

    ``values`` lists ``new_name=column`` of the rows to attach. Both inputs are put in one order and the value
    is carried along, so no pairs are built. ``forward`` may name a column of the probes that tells the direction of each.
    """
    direction = F.col(forward) if isinstance(forward, str) else F.lit(forward)
    # On equal times a row stands between the probes that look ahead and those that look back.
    side = F.when(direction, 0).otherwise(2)
    found = F.struct(*[F.col(c).alias(n) for n, c in values.items()])
    packed_probes = probes.select(*on, time, tie, side.alias("_side"), F.struct(*probes.columns).alias("_probe"))
    packed_rows = rows.select(*on, time, tie, F.lit(1).alias("_side"), found.alias("_found"))
    order = TimeOrder(keys=on, time=time, tie=("_side", tie))
    both = packed_probes.unionByName(packed_rows, allowMissingColumns=True)
    ahead, back = {"_ahead": "_found"}, {"_back": "_found"}
    if isinstance(forward, str):
        joined = carry_both(both, order, back, ahead).withColumn("_found", F.when(F.col("_side") == 0, F.col("_ahead")).otherwise(F.col("_back")))
    else:
        joined = carry(both, order, backward=forward, _found="_found")
    return joined.where(F.col("_side") != 1).select("_probe.*", *[F.col(f"_found.{n}").alias(n) for n in values])


def translate(
    alarms: DataFrame, translations: DataFrame, language: str, type_id: int, key: str = "skey",
    fallback: str = "en_US",
) -> DataFrame:
    """Add ``translation`` of the alarm key; an unknown language falls back to English.

    Where a key is stored more than once the smallest text counts.
    """
    known = translations.agg(F.max(F.col("language") == language)).scalar()
    wanted = F.when(known, F.lit(language)).otherwise(F.lit(fallback))
    texts = translations.groupBy("unique_key").agg(F.min("translation").alias("translation"))
    unique = F.concat(wanted, F.lit(f"_{type_id}"), general_key(F.col(key)))
    return alarms.withColumn("unique_key", unique).join(texts, "unique_key", "left").drop("unique_key")
