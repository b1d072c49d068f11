"""Box production per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.functions.time import seconds_between
from plantpulse.functions.values import ratio
from plantpulse.sources.commits import upsert
from plantpulse.sources.sinks import merge_batches

BATCH_KEYS = ["line", "machine", "serial", "recipe"]
# Columns a later run may change; the others are fixed by the first row of a batch.
UPDATED = ["batch_end", "duration_hours", "boxes", "boxes_per_hour", "last_uuid"]


def batch_sums(general: DataFrame, batch: str = "batch", extra_keys: Sequence[str] = ()) -> DataFrame:
    """First and last row and bounds of the counter of each batch; what :func:`merge_sums` can put together."""
    at = F.struct("time", "uuid")
    known = F.col("line").isNotNull() & F.col("serial").isNotNull() & F.col("recipe").isNotNull()
    return general.where(known).groupBy(*extra_keys, *BATCH_KEYS, F.col(batch).alias("batch")).agg(
        F.min("time").alias("batch_start"),
        F.max("time").alias("batch_end"),
        F.min("total_cases").alias("low"),
        F.max("total_cases").alias("high"),
        F.min(at)["uuid"].alias("first_uuid"),
        F.max(at)["uuid"].alias("last_uuid"),
    )


def merge_sums(sums: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """One row per batch from sums of parts of its rows. Parts may share rows."""
    return sums.groupBy(*extra_keys, *BATCH_KEYS, "batch").agg(
        F.min("batch_start").alias("batch_start"),
        F.max("batch_end").alias("batch_end"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min(F.struct("batch_start", "first_uuid"))["first_uuid"].alias("first_uuid"),
        F.max(F.struct("batch_end", "last_uuid"))["last_uuid"].alias("last_uuid"),
    )


def production_of_sums(sums: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Boxes and boxes per hour from the sums of whole batches."""
    hours = seconds_between("batch_start", "batch_end") / F.lit(3600.0)
    made = F.col("high") - F.col("low")
    return sums.select(
        F.col("batch_start").alias("time"), *extra_keys, *BATCH_KEYS, "batch", "batch_start", "batch_end",
        hours.alias("duration_hours"), (made + 1).alias("boxes"),
        ratio(made, hours).alias("boxes_per_hour"), "first_uuid", "last_uuid",
    )


def box_production(general: DataFrame, batch: str = "batch", extra_keys: Sequence[str] = ()) -> DataFrame:
    """Start, end, boxes and boxes per hour of each batch.

    A batch with a single row has no duration, so its boxes per hour are NULL.
    """
    return production_of_sums(batch_sums(general, batch, extra_keys), extra_keys)


def merge_box_production(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Bring a stored result up to date with a newer one."""
    return merge_batches(stored, new, "first_uuid", "last_uuid", UPDATED)


def merge_production_into(folder: str, new: DataFrame) -> list[str]:
    """Bring a stored table of production up to date; only days with a changed batch are written, and returned.

    ``new`` comes from :func:`box_production`. Batches are known by their first row, which fixes their day.
    """
    day = F.to_date("batch_start")
    return upsert(new, folder, ["first_uuid"], day, version=["last_uuid"], updated=UPDATED)
