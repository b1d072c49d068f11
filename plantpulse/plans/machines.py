"""Machine state: carry-forward, timelines, durations, periods and batch reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantpulse.functions.time import bucket, epoch_ms, seconds_between
from plantpulse.functions.values import ratio
from plantpulse.operators import stretches
from plantpulse.operators.aggregates import most_frequent
from plantpulse.operators.joins import asof
from plantpulse.operators.ordered import SLICE, TimeOrder, carry, with_next, with_previous
from plantpulse.operators.stretches import state_totals
from plantpulse.session import staged

BY_MACHINE = TimeOrder(keys=["serial"])
# Program states that count as alarm and as waiting.
ALARM_STATE = 600
WAITING_STATES = (100, 200, 300, 400, 500)


def carry_start(general: DataFrame, state: str, carried: str, machines: int | None = None) -> datetime | None:
    """Time from which values have to be carried again.

    Before the first row without a carried value, each machine has a last known value; the
    earliest of these times counts, over all machines or the ``machines`` seen most recently. The result
    is a plain value, so that the scan that follows can skip older files.
    """
    first_open = general.where(F.col(carried).isNull()).agg(F.min("time")).scalar()
    known = general.where(F.col(state).isNotNull() & (F.col("time") <= first_open))
    recent = known.groupBy("serial").agg(F.max("time").alias("time"))
    newest = recent if machines is None else recent.orderBy(F.col("time").desc(), "serial").limit(machines)
    return newest.agg(F.min("time")).first()[0]


def carry_forward(general: DataFrame, state: str, carried: str, machines: int | None = None) -> DataFrame:
    """Fill ``carried`` with the last known state per machine, from the start computed above.

    Rows before the start keep their value, and no value is replaced by NULL. Where no machine
    has a known value before the first open row, nothing is filled.
    """
    start = carry_start(general, state, carried, machines)
    if start is None:
        return general
    at = F.lit(start.isoformat()).cast("timestamp_ntz")
    filled = carry(general.where(F.col("time") >= at), BY_MACHINE, _value=state)
    filled = filled.withColumn(carried, F.coalesce("_value", carried)).drop("_value")
    return general.where((F.col("time") < at) | F.col("time").isNull()).unionByName(filled)


def state_timeline(general: DataFrame, state: str = "program_state") -> DataFrame:
    """State changes inside each batch with their end; the open last one is left out.

    A NULL state stays in the sequence, so 300, NULL, 500 holds no change.
    """
    keys = ["line", "serial", "recipe", "batch"]
    order = TimeOrder(keys=keys)
    known = F.col("line").isNotNull() & F.col("serial").isNotNull() & F.col("recipe").isNotNull()
    sampled = F.col("mode_state").isNotNull() | F.col(state).isNotNull()
    rows = order.sliced(general.where(known & sampled).select(
        "uuid", "time", "line", "machine", "serial", "recipe", "batch", "mode_state", state))
    changed = with_previous(rows, order, _was=state).where(F.col("_was") != F.col(state)).drop("_was")
    ended = with_next(staged(changed, "state-changes"), order, end_time="time").where(F.col("end_time").isNotNull())
    return ended.withColumn("duration_seconds", seconds_between("time", "end_time")).drop(SLICE)


def batch_state_rollup(timeline: DataFrame, state: str = "program_state") -> DataFrame:
    """Totals per batch and state.

    ``last_end_start`` is the start of the row that ends last, as the original report has it;
    ``last_end`` is that end itself.
    """
    at = F.struct("time", "uuid")
    total = F.sum("duration_seconds")
    return timeline.groupBy("line", "machine", "recipe", "batch", "mode_state", state).agg(
        F.min("time").alias("first_start"),
        F.max_by("time", F.struct("end_time", "time", "uuid")).alias("last_end_start"),
        F.max("end_time").alias("last_end"),
        total.alias("total_seconds"),
        (total / 60).alias("total_minutes"),
        (total / 3600).alias("total_hours"),
        F.count(state).alias("occurrences"),
        F.min(at)["uuid"].alias("first_uuid"),
        F.max(at)["uuid"].alias("last_uuid"),
    )


def runs(df: DataFrame, order: TimeOrder, value: str) -> DataFrame:
    """One row per run of equal values: value, first and last time, and whether it has one row.

    Only the rows where the value changes are ordered a second time. A run ends with the row
    before the next change, or with the last row of its key.
    """
    at = F.struct(order.time, *order.tie)
    rows = order.sliced(df.select(*dict.fromkeys([*order.keys, order.time, *order.tie, value])))
    seen = with_previous(rows.withColumn("_at", at), order, seen="_seen", _was=value, _before="_at")
    same = F.col("_seen") & F.col("_was").eqNullSafe(F.col(value))
    starts = with_next(staged(seen.where(~same), "run-starts"), order, _until="_before")
    last = rows.groupBy(order.key().alias("_k")).agg(F.max(at).alias("_last"))
    ended = starts.withColumn("_k", order.key()).join(last, "_k", "left")
    end = F.coalesce("_until", "_last")
    return ended.select(
        *order.keys, *([] if value in order.keys else [value]),
        F.col(order.time).alias("time_from"), end[order.time].alias("time_to"),
        (F.col("_at") == end).alias("single_row"))


def recipe_periods(
    general: DataFrame, start: Column | None = None, end: Column | None = None, keys: Sequence[str] = ("serial",)
) -> DataFrame:
    """Periods in which a machine ran one recipe, inside an open interval.

    Periods of a single row are dropped.
    """
    rows = general
    if start is not None:
        rows = rows.where((F.col("time") > start) & (F.col("time") < end))
    periods = runs(rows, TimeOrder(keys=list(keys)), "recipe").where(~F.col("single_row"))
    return periods.drop("single_row")


def recipe_periods_epoch(general: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Recipe periods with epoch milliseconds."""
    return recipe_periods(general, start, end).select(
        "serial", "recipe", epoch_ms("time_from").alias("from_ms"), epoch_ms("time_to").alias("to_ms"))


def state_durations(
    general: DataFrame, as_of: Column, keys: Sequence[str] = ("serial", "batch"),
    next_within: Sequence[str] | None = None, state: str = "program_state",
) -> DataFrame:
    """Number of runs and total time of each state; the last row lasts until ``as_of``.

    ``next_within`` tells among which rows the next row is looked for. The original report looks
    among all rows of the batch, whatever the machine.
    """
    known = general.where(F.col(state).isNotNull())
    return state_totals(known, keys, state, as_of, next_within).select(
        *keys, state, F.col("entries").alias("runs"), F.col("seconds").alias("total_seconds"))


def state_group_report(durations: DataFrame, keys: Sequence[str] = ("serial", "batch")) -> DataFrame:
    """Durations summed into the named groups 'alarm' and 'waiting'."""
    state = F.col("program_state")
    group = F.when(state == ALARM_STATE, "alarm").when(state.isin(*WAITING_STATES), "waiting")
    named = durations.withColumn("state_group", group).where(F.col("state_group").isNotNull())
    return named.groupBy(*keys, "state_group").agg(
        F.sum("runs").alias("runs"), F.sum("total_seconds").alias("total_seconds"))


def stay_totals(
    general: DataFrame, keys: Sequence[str], target: float = ALARM_STATE, state: str = "program_state"
) -> DataFrame:
    """Number and total time of the completed stays in a state per key.

    A stay that was open at the first row has no known entry and is left out, like one that is
    still open at the last row.
    """
    known = general.where(F.col(state).isNotNull())
    return stretches.stay_totals(known, keys, F.col(state) == target)


def state_backfill(general: DataFrame, batch: Column, state: str = "program_state") -> DataFrame:
    """Rows of one batch with missing states filled from the row before."""
    return carry(general.where(F.col("batch") == batch), TimeOrder(keys=["batch", "serial"]), **{state: state})


def _later_batches(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Times of the first later batch for each batch of ``rows`` that ``bounds`` lacks and that has a number."""
    # The counter stands in for the time, so that its order is cut into slices too.
    at = F.timestamp_micros(F.col("batch").try_cast("bigint")).alias("_at")
    lacking = rows.select("batch").distinct().join(bounds.select("batch"), "batch", "left_anti").select("batch", at)
    listed = bounds.select("batch", at, "start_time", "end_time")
    times = {"start_time": "start_time", "end_time": "end_time"}
    numbered = F.col("_at").isNotNull()
    return asof(lacking.where(numbered), listed.where(numbered), [], times, forward=True, time="_at", tie="batch").drop("_at")


def flag_durations(status: DataFrame, batches: DataFrame, as_of: Column, flags: Sequence[str]) -> DataFrame:
    """Time per value of each flag, machine with its index, and batch, with the batch's start, end and total time.

    ``batches`` gives ``batch``, ``start_time`` and ``end_time`` (NULL while running). A batch that is not in this list
    takes the times of the first one after it in counter order; if there is none, they are NULL.
    """
    bounds = batches.select("batch", "start_time", F.coalesce("end_time", as_of).alias("end_time"))
    key = ["machine", "machine_index", "batch"]
    rows = status.where(F.col("batch").isNotNull()).select(*key, "time", "uuid", *flags)
    timed = with_next(rows, TimeOrder(keys=key), _next_time="time")
    timed = timed.join(bounds.unionByName(_later_batches(rows, bounds)), "batch", "left").withColumn(
        "_seconds", seconds_between("time", F.coalesce("_next_time", "end_time")))
    long = timed.unpivot(
        [*key, "start_time", "end_time", "_seconds"], list(flags), "flag", "state")
    totals = long.groupBy(*key, "flag", "state", "start_time", "end_time").agg(
        F.sum("_seconds").alias("duration_seconds"))
    return totals.withColumn("batch_seconds", seconds_between("start_time", "end_time"))


def batch_periods(df: DataFrame, batch: str = "batch") -> DataFrame:
    """Start of each batch and start of the one after it."""
    starts = df.groupBy(F.col(batch).alias("batch")).agg(F.min("time").alias("start_time"))
    # One row for each batch: few enough for slices of a fixed width.
    order = TimeOrder(keys=[], time="start_time", tie=("batch",), rows_per_slice=None)
    return with_next(staged(starts, "batch-starts"), order, end_time="start_time")


def batch_moments(general: DataFrame, weights: DataFrame, keys: Sequence[str] = ("serial", "batch")) -> DataFrame:
    """Start of a batch, first fill, last fill, end of the batch.

    The first fill is the machine's first weighing at or after the start, the last fill its
    last weighing at or before the end.
    """
    at = F.struct("time", "uuid", "recipe")
    spans = general.groupBy(*keys).agg(F.min(at).alias("_start"), F.max(at).alias("_end"))
    spans = staged(spans, "batch-spans")
    machine = [k for k in keys if k != "batch"]
    fills = weights.select(*machine, "time", "uuid", F.struct("time", "recipe").alias("_fill"))

    def edge(which: str, label: str) -> DataFrame:
        return spans.select(*keys, F.lit(label).alias("moment"), F.col(f"{which}.time").alias("time"),
                            F.col(f"{which}.recipe").alias("recipe"))

    # Both fills are looked for in one order: the first one ahead of the start, the last one back from the end.
    probes = spans.select(*keys, F.inline(F.array(
        F.struct(F.lit("first fill").alias("moment"), F.lit(True).alias("_ahead_of"), F.col("_start.time"), F.col("_start.uuid")),
        F.struct(F.lit("last fill").alias("moment"), F.lit(False).alias("_ahead_of"), F.col("_end.time"), F.col("_end.uuid")))))
    hit = asof(probes, fills, machine, {"_fill": "_fill"}, forward="_ahead_of").where(F.col("_fill").isNotNull())
    filled = hit.select(*keys, "moment", "_fill.time", "_fill.recipe")
    return edge("_start", "start batch").unionByName(filled).unionByName(edge("_end", "end batch"))


def batch_overview(general: DataFrame) -> DataFrame:
    """Per batch: recipe, start and end, boxes, boxes per minute, and the stays in alarm."""
    at = F.struct("time", "uuid")
    base = general.groupBy("batch").agg(
        F.min(at)["time"].alias("_start"), F.max(at)["time"].alias("_end"), F.sum("box_made").alias("boxes"))
    seconds = seconds_between("_start", "_end")
    return (
        base.join(most_frequent(general, ["batch"], "recipe", "recipe"), "batch", "left")
        .join(stay_totals(general, ["batch"]), "batch", "left")
        .select(
            "batch", "recipe", epoch_ms("_start").alias("start_ms"), epoch_ms("_end").alias("end_ms"),
            seconds.alias("duration_seconds"), "boxes", ratio(F.col("boxes") * 60, seconds).alias("boxes_per_minute"),
            F.coalesce("stays", F.lit(0)).alias("alarm_count"),
            F.coalesce("stay_seconds", F.lit(0.0)).alias("alarm_seconds"))
    )


def production_hourly(general: DataFrame, as_of: Column, hours: int = 25) -> DataFrame:
    """Boxes per hour, machine, recipe and batch over the last hours, with the last value."""
    recent = general.where((F.col("time") > as_of - F.make_dt_interval(hours=F.lit(hours))) & F.col("serial").isNotNull())
    return recent.groupBy(bucket("time", 3600).alias("hour"), "machine", "serial", "recipe", "batch").agg(
        F.sum("box_made").alias("boxes"), F.max_by("box_made", F.struct("time", "uuid")).alias("last_value"))
