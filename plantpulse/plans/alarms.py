"""Alarm states: transitions, consolidation, and one line per alarm block.

States are 0 (no alarm), 1 or 10 (active), 20 (acknowledged, waiting). A block starts after a
return to 0 and ends with the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plantpulse.functions.time import epoch_ms, seconds_between
from plantpulse.operators.ordered import SLICE, TimeOrder, carry, with_next, with_next_rows, with_previous
from plantpulse.session import staged
from plantpulse.session import stored as stored_rows
from plantpulse.sources.sinks import only_new

BY_ALARM = TimeOrder(keys=["serial", "idx"])
# Alarm states.
ACTIVE = (1, 10)
WAITING = 20
COLUMNS = ["uuid", "time", "machine", "serial", "recipe", "batch", "idx", "skey", "state"]


def with_previous_state(alarms: DataFrame, order: TimeOrder = BY_ALARM) -> DataFrame:
    """Add ``previous_state``; it is NULL on the first row of a key."""
    return with_previous(alarms, order, previous_state="state")


def transitions(alarms: DataFrame, order: TimeOrder = BY_ALARM) -> DataFrame:
    """Rows whose state differs from the previous one of the same alarm."""
    changed = F.col("previous_state") != F.col("state")
    return with_previous_state(alarms, order).where(changed).select(*alarms.columns)


def consolidated(alarms: DataFrame, as_of: Column | None = None, look_back_hours: int | None = None) -> DataFrame:
    """State changes (``edge``) and repeated non-zero states; repeated zeros are dropped."""
    if look_back_hours is not None:
        span = F.make_dt_interval(hours=F.lit(look_back_hours))
        alarms = alarms.where(F.col("time") > as_of - span)
    edge = F.col("previous_state") != F.col("state")
    return (
        with_previous_state(alarms)
        .where(edge | (F.col("state") != 0) & F.col("previous_state").isNotNull())
        .select(*alarms.columns, edge.alias("edge"))
    )


def redundant_zeros(alarms: DataFrame) -> DataFrame:
    """Zero rows that follow a zero row of the same alarm."""
    both = (F.col("state") == 0) & (F.col("previous_state") == 0)
    return with_previous_state(alarms).where(both).select(*alarms.columns)


def without_redundant_zeros(alarms: DataFrame) -> DataFrame:
    """All rows but the redundant zeros; the alarm blocks stay the same."""
    both = (F.col("state") == 0) & (F.col("previous_state") == 0)
    return with_previous_state(alarms).where(~F.coalesce(both, F.lit(False))).select(*alarms.columns)


def _first_per_state(rows: Column) -> Column:
    """Rows of a short array whose state did not occur earlier in it."""

    def is_new(row: Column, i: Column) -> Column:
        return ~F.exists(F.slice(rows, F.lit(1), i), lambda e: e["state"] == row["state"])

    return F.filter(rows, is_new)


def _lines(kept: DataFrame) -> DataFrame:
    """Reduce the kept rows of each block, with their next time, to one line."""
    nxt = F.col("_next_time")
    lines = kept.groupBy("block_uuid", "idx").agg(
        F.min("time").alias("time"),
        F.min("machine").alias("machine"),
        F.min("serial").alias("serial"),
        F.min("recipe").alias("recipe"),
        F.min("batch").alias("batch"),
        F.min("skey").alias("skey"),
        F.max("state").alias("max_state"),
        F.max(F.when(F.col("state").isin(*ACTIVE), nxt)).alias("active_end"),
        F.max(F.when(F.col("state") == WAITING, nxt)).alias("waiting_end"),
        F.max(F.when(F.col("state") == 0, F.col("time"))).alias("alarm_end"),
    )
    return lines.select(
        "time", "machine", "serial", "recipe", "batch", "idx", "skey", "max_state",
        "active_end", "waiting_end", "alarm_end",
        seconds_between("time", "active_end").alias("active_seconds"),
        seconds_between("active_end", "waiting_end").alias("waiting_seconds"),
        seconds_between("time", "alarm_end").alias("alarm_seconds"),
        "block_uuid",
    )


def block_rows(alarms: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Rows of each block: up to three transitions after a return to zero, first per state.

    ``block_uuid`` is the id of the zero row that closes the block, NULL while it is open.
    Blocks listed in ``stored`` are left out before the rows are unpacked.
    """
    changes = staged(transitions(BY_ALARM.sliced(alarms.select(*COLUMNS))), "alarm-changes")
    by_machine = TimeOrder(keys=["machine", "idx"])
    anchors = with_next_rows(changes, by_machine, 3, "_after", [*COLUMNS, SLICE], same_instant=True).where(F.col("state") == 0)
    closed = with_next(anchors, BY_ALARM, block_uuid="uuid").select("block_uuid", "_after")
    if stored is not None:
        closed = only_new(closed, stored, ["block_uuid"])
    kept = closed.select("block_uuid", F.explode(_first_per_state(F.col("_after"))).alias("_row"))
    return kept.select("_row.*", "block_uuid")


def alarm_lines(alarms: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """One line per closed alarm block, as the original procedure computes it.

    The end of a state is the next kept row of the alarm, which may belong to the block after;
    ends can therefore lie beyond the block. ``alarm_lines_strict`` stays inside the block.
    """
    order = TimeOrder(keys=["serial", "idx"], tie=("uuid", "block_uuid"))
    kept = with_next(staged(block_rows(alarms, stored), "alarm-blocks"), order, _next_time="time")
    return _lines(kept.where(F.col("block_uuid").isNotNull()))


def alarm_lines_strict(alarms: DataFrame, made: list[str] | None = None) -> DataFrame:
    """One line per closed alarm block, from the rows up to and including its closing zero.

    The folder of the stored changes is added to ``made``, for callers that delete it again.
    """
    changes, folder = stored_rows(transitions(BY_ALARM.sliced(alarms.select(*COLUMNS))), "alarm-changes")
    if made is not None:
        made.append(folder)
    return lines_of_changes(changes)


def lines_of_changes(changes: DataFrame) -> DataFrame:
    """The lines of ``alarm_lines_strict``, from stored ``transitions``, which are read twice."""
    zero = F.col("state") == 0
    blocks = carry(changes.withColumn("_zero", F.when(zero, F.col("uuid"))), BY_ALARM, backward=True,
                   block_uuid="_zero").drop("_zero").where(F.col("block_uuid").isNotNull())
    # What comes before the first zero of an alarm has no known start.
    opening = (
        changes.where(zero)
        .groupBy("serial", "idx")
        .agg(F.min(BY_ALARM.position()).alias("_first"))
        .select(F.col("_first.uuid").alias("block_uuid"))
    )
    blocks = blocks.join(opening, "block_uuid", "left_anti")
    first = F.min(F.struct("time", "uuid", "machine", "serial", "recipe", "batch", "skey"))
    kept = blocks.groupBy("block_uuid", "idx", "state").agg(first.alias("_row"))
    kept = kept.select("block_uuid", "idx", "state", "_row.*")
    # A block now has one row per state, so this window sees a handful of rows.
    inside = W.partitionBy("block_uuid", "idx").orderBy("time", "uuid")
    return _lines(kept.withColumn("_next_time", F.lead("time").over(inside)))


def range_report(lines: DataFrame, idx: str, batch: str, start: Column, end: Column, limit: int | None = None) -> DataFrame:
    """First lines of one alarm and batch in a closed time range."""
    inside = F.col("time").between(start, end)
    found = lines.where((F.col("idx") == idx) & (F.col("batch") == batch) & inside).orderBy("time", "block_uuid")
    return found if limit is None else found.limit(limit)


def modal_interval(alarms: DataFrame, by: str, zero_rows_only: bool = True) -> DataFrame:
    """Most frequent distance in milliseconds to the next row, the smallest on a tie.

    Rows of one ``idx`` follow each other by machine and then by time, so the last row of a
    machine is followed by the first row of the next machine.
    """
    rows = alarms
    if zero_rows_only:
        rows = rows.where((F.col("state") == 0) & F.col("skey").isNotNull())
    inside = with_next(rows, BY_ALARM, more="_has_next", _next_time="time")
    # One row per machine and alarm, which is what has to be put in a single order per alarm.
    ends = rows.groupBy("idx", "serial").agg(F.min("time").alias("_first"), F.max(BY_ALARM.position()).alias("_last"))
    following = F.lead("_first").over(W.partitionBy("idx").orderBy(F.col("serial").asc_nulls_last()))
    over = ends.select("idx", "serial", F.col("_last.time").alias("time"), following.alias("_next_time"))
    columns = ["idx", "serial", "time", "_next_time"]
    pairs = inside.where("_has_next").select(*columns).unionByName(over.where(F.col("_next_time").isNotNull()))
    gap = F.round(epoch_ms("_next_time") - epoch_ms("time")).cast("bigint")
    counts = pairs.groupBy(by, gap.alias("interval_ms")).agg(F.count(F.lit(1)).alias("_n"))
    best = F.max_by("interval_ms", F.struct("_n", -F.col("interval_ms")))
    return counts.groupBy(by).agg(best.alias("interval_ms"))
