"""Writing and merging results.

Parquet has no row updates. Merges compute the new table; the caller overwrites the
partitions concerned (``spark.sql.sources.partitionOverwriteMode=dynamic``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plantpulse.functions.time import bucket


def only_new(new: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet. A NULL key counts as new."""
    return new.join(stored.select(*key), list(key), "left_anti")


def append_new(new: DataFrame, folder: str, key: Sequence[str]) -> None:
    """Append the rows whose key the stored table does not have."""
    stored = new.sparkSession.read.schema(new.schema).parquet(folder)
    only_new(new, stored, key).write.mode("append").parquet(folder)


def merge_batches(
    stored: DataFrame, new: DataFrame, key: str, version: str, updated: Sequence[str]
) -> DataFrame:
    """Upsert: a changed ``version`` updates some columns, an unknown key is inserted."""
    n = new.select(*[F.col(c).alias(f"_new_{c}") for c in new.columns])
    both = stored.join(n, F.col(key) == F.col(f"_new_{key}"), "full_outer")
    unknown = F.col(key).isNull()
    changed = F.col(version) != F.col(f"_new_{version}")

    def merged(c: str) -> Column:
        take = (unknown | changed) if c in updated else unknown
        return F.when(take, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return both.select(*[merged(c) for c in stored.columns])


def backfill(df: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """Take a column from a keyed result, never replacing a value by NULL."""
    v = values.select(key, F.col(column).alias("_value"))
    filled = F.coalesce(F.col("_value"), F.col(column))
    return df.join(v, key, "left").withColumn(column, filled).select(*df.columns)


def mark(df: DataFrame, condition: Column, column: str = "mark", value: str = "out") -> DataFrame:
    """Mark the rows that meet a condition known in the same pass; other rows keep the mark they have, if any."""
    old = F.col(column) if column in df.columns else F.lit(None).cast("string")
    return df.withColumn(column, F.when(condition, F.lit(value)).otherwise(old))


def unmarked(df: DataFrame, column: str = "mark", value: str = "out") -> DataFrame:
    """Rows that no earlier run marked."""
    return df.where(F.coalesce(F.col(column), F.lit("")) != value)


def write_by(df: DataFrame, folder: str, column: str, replace: bool = False) -> None:
    """Write one folder per value of a column.

    Rows are first brought together by that column, so that not every task writes into every
    folder. Spark splits the values that hold many rows. With ``replace`` only the folders that
    occur in the rows are replaced.
    """
    writer = df.hint("rebalance", F.col(column)).write.partitionBy(column)
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(folder)


def write_chunks(df: DataFrame, folder: str, chunk_seconds: int, time: str = "time") -> None:
    """Write a table split by time chunk; existing chunks of the same name are replaced."""
    chunk = F.date_format(bucket(time, chunk_seconds), "yyyy-MM-dd'T'HH-mm-ss")
    write_by(df.withColumn("chunk", chunk), folder, "chunk", replace=True)


def read_chunks(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Read a chunked table; a filter on ``chunk`` prunes folders."""
    return spark.read.schema(schema.add("chunk", "string")).parquet(folder)


def retain(df: DataFrame, as_of: Column, keep_days: int, chunk_seconds: int, time: str = "time") -> DataFrame:
    """Drop the chunks that ended before ``as_of`` minus the retention period."""
    width = F.make_dt_interval(secs=F.lit(chunk_seconds))
    oldest = as_of - F.make_dt_interval(days=F.lit(keep_days))
    # The first chunk that ends after ``oldest``, as a bound on the stored time, which the scan can use.
    return df.where(F.col(time) >= bucket(oldest, chunk_seconds))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Remove matching rows; a condition that is NULL keeps its row."""
    return df.where(~F.coalesce(condition, F.lit(False)))
