"""Counts and bounds of stored tables from the footers of their Parquet files, without a row read.

A file's footer tells how many rows it has and, for numbers, dates and flags, how many values and which the lowest and
highest are. The second version of Spark's Parquet reader answers aggregates of these from the footers alone.
Bounds of times and texts are not in its reach and are read from the column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_READERS = "spark.sql.sources.useV1SourceList"


def table(spark: SparkSession, folder: str) -> DataFrame:
    """A Parquet table by the reader that answers ungrouped counts, minima and maxima from footers (a filter needs the rows)."""
    before = spark.conf.get(_READERS)
    spark.conf.set(_READERS, ",".join(name for name in before.split(",") if name.strip() != "parquet"))
    try:
        return spark.read.parquet(folder)
    finally:
        spark.conf.set(_READERS, before)


def rows(spark: SparkSession, folder: str) -> DataFrame:
    """One row with the number of rows."""
    return table(spark, folder).agg(F.count(F.lit(1)).alias("n"))


def bounds(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """``column``, ``n`` values, ``least`` and ``most``, for columns of numbers, as doubles."""
    wanted = [f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.count, F.min, F.max)]
    row = table(spark, folder).agg(*wanted)
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"count_{c}").alias("n"), F.col(f"min_{c}").cast("double").alias("least"),
                 F.col(f"max_{c}").cast("double").alias("most")) for c in columns]
    return row.select(F.inline(F.array(*entries)))
