"""Series whose range comes from data, and rows generated from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Steps that are made from one row.
CHUNK = 100_000


def numbered(bounds: DataFrame, last: Column, alias: str = "i") -> DataFrame:
    """``bounds`` with the numbers from 0 to ``last``, both included.

    Chunks of numbers are dealt out over the tasks first, so no row holds more than a chunk of them.
    """
    chunks = bounds.withColumn("_last", last.cast("bigint")).where("_last >= 0")
    chunks = chunks.withColumn("_from", F.explode(F.expr(f"sequence(0L, _last, {CHUNK}L)")))
    # A given number of partitions, as the few rows would else be put together again.
    dealt = chunks.repartition(int(bounds.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col("_from"))
    steps = F.expr(f"sequence(_from, least(_last, _from + {CHUNK - 1}L))")
    return dealt.withColumn(alias, F.explode(steps)).drop("_last", "_from")


def number_series(df: DataFrame, column: str, step: float, alias: str = "value") -> DataFrame:
    """Numbers from the smallest to the largest value of a column, also in fractional steps."""
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    steps = numbered(bounds, F.floor((F.col("hi") - F.col("lo")) / F.lit(step)))
    return steps.select((F.col("lo") + F.col("i") * F.lit(step)).alias(alias))


def time_series(df: DataFrame, column: str, seconds: int, alias: str = "moment") -> DataFrame:
    """Moments from the hour of the earliest time to the latest time of a column."""
    bounds = df.agg(
        F.date_trunc("hour", F.min(column)).cast("timestamp_ntz").alias("lo"), F.max(column).alias("hi"))
    micros = seconds * 1_000_000
    steps = numbered(bounds, F.floor((F.unix_micros(F.col("hi").cast("timestamp")) - F.unix_micros(F.col("lo").cast("timestamp"))) / micros))
    return steps.select((F.col("lo") + F.make_dt_interval(secs=F.col("i") * seconds)).alias(alias))


def synthetic_boxes(batches: DataFrame, batch: str, most: int = 5) -> DataFrame:
    """Up to ``most`` boxes per batch with repeatable values drawn from a hash of the ids."""
    n = F.col(batch) % F.lit(most) + F.lit(1)
    boxes = batches.select(F.col(batch).alias("batch_id"), F.explode(F.sequence(F.lit(1), n)).alias("box_no"))
    digest = F.md5(F.concat_ws("-", F.col("batch_id"), F.col("box_no")))
    draw = F.conv(F.substring(digest, 1, 6), 16, 10).cast("bigint")
    return boxes.select(
        "batch_id",
        F.col("box_no").cast("bigint").alias("box_no"),
        (F.lit(10.0) + (draw % 1000) / F.lit(100.0)).alias("weight"),
        F.substring(digest, 1, 5).alias("label"),
        (draw % 2 == 0).alias("flag"),
        F.when(draw % 3 == 0, "red").when(draw % 3 == 1, "green").otherwise("blue").alias("category"),
    )


def clone_machine(df: DataFrame, rows, machine: str, new_id, machine_column: str = "machine") -> DataFrame:
    """A table plus a copy of some of its rows under another machine and with new ids."""
    copy = df.where(rows).withColumn(machine_column, F.lit(machine)).withColumn("uuid", new_id)
    return df.unionByName(copy)
