"""Profiles of stored tables: chunks, rows over time, files, and one overview of everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plantpulse.functions.time import bucket, seconds_between

DAY = 86_400


def chunk_details(df: DataFrame, name: str, time: str, chunk_seconds: int = DAY) -> DataFrame:
    """Rows and time range of each chunk of a table."""
    return df.groupBy(bucket(time, chunk_seconds).alias("chunk_start")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_time"), F.max(time).alias("last_time"),
    ).select(
        F.lit(name).alias("name"), "chunk_start",
        (F.col("chunk_start") + F.make_dt_interval(secs=F.lit(chunk_seconds))).alias("chunk_end"),
        "rows", "first_time", "last_time")


def chunk_summary(details: DataFrame) -> DataFrame:
    """Number of chunks, rows, range and longest chunk of each table."""
    return details.groupBy("name").agg(
        F.count(F.lit(1)).alias("chunks"), F.sum("rows").alias("rows"),
        F.min("chunk_start").alias("range_start"), F.max("chunk_end").alias("range_end"),
        F.max(seconds_between("chunk_start", "chunk_end")).alias("chunk_seconds"),
    ).withColumn("span_seconds", seconds_between("range_start", "range_end"))


def row_growth(df: DataFrame, relation: str, time: str) -> DataFrame:
    """Rows of each relation so far at the end of every day, and those of the day.

    The running totals go over one row per relation and day.
    """
    daily = df.groupBy(F.col(relation).alias("relation"), bucket(time, DAY).alias("day")).agg(F.count(F.lit(1)).alias("growth"))
    so_far = W.partitionBy("relation").orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    return daily.select(
        "relation", (F.col("day") + F.make_dt_interval(days=F.lit(1))).alias("time"), F.sum("growth").over(so_far).alias("rows"), "growth")


def latest_rows(growth: DataFrame) -> DataFrame:
    """The newest day's rows and each relation's share of them."""
    latest = growth.where(F.col("time") == growth.agg(F.max("time")).scalar())
    total = latest.agg(F.sum("rows")).scalar()
    return latest.select("relation", "time", "rows", (F.col("rows") / F.nullif(total, F.lit(0))).alias("share"))


def file_sizes(df: DataFrame, name: str) -> DataFrame:
    """Number of files and their bytes, from the metadata of the files a table is read from."""
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    return files.groupBy("path").agg(F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")).agg(
        F.lit(name).alias("name"), F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"),
        F.sum("rows").alias("rows"))


def relation_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    return _stacked([df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()])


def _stacked(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def dataset_overview(
    base: DataFrame, summaries: DataFrame, chunks: DataFrame, retention: DataFrame
) -> DataFrame:
    """Base tables and summaries in one list with rows, chunks, period and retention.

    ``base`` and ``summaries`` hold ``name, rows``; ``retention`` holds ``name, config``, a JSON document. What a
    table lacks counts as 0.
    """
    labelled = base.withColumn("type", F.lit("Table")).unionByName(summaries.withColumn("type", F.lit("Summary")))
    found = chunks.select("name", "chunks", "range_start", "range_end", "span_seconds")
    kept = retention.select("name", F.get_json_object("config", "$.drop_after").alias("retention"))
    zero = F.lit(0)
    return labelled.join(found, "name", "left").join(kept, "name", "left").select(
        "type", "name", F.coalesce("rows", zero).alias("rows"), F.coalesce("chunks", zero).alias("chunks"),
        "range_start", "range_end", F.coalesce("span_seconds", F.lit(0.0)).alias("span_seconds"), "retention")
