"""Mergeable summaries of stretches of ordered telemetry: entries into states, and time in them.

A stretch is one slice of time of one key. Its summary has a row for each state in it: entries seen inside, time to the
next row inside, and what the neighbouring stretches need to know, which is the state and time at both ends. Two
neighbouring summaries merge into one: counts and times are added, and the step from the end of one to the beginning of
the other adds the entry and the time that neither could see. So the rows are read once, exchanged once by key and
slice, and only summaries meet across slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plantpulse.functions.time import micros
from plantpulse.operators.ordered import KEY, SLICE, TimeOrder

_MICROS = 1_000_000.0


def _steps(df: DataFrame, order: TimeOrder) -> DataFrame:
    """Rows with the next row's time inside the slice, and whether they are its first or last one."""
    within = order.within()
    return order.dealt(df).withColumns({
        "_next": F.lead(order.time).over(within), "_opens": F.lag(F.lit(1)).over(within).isNull(),
        "_closes": F.lead(F.lit(1)).over(within).isNull()})


def state_summary(df: DataFrame, keys: Sequence[str], state: str, order: TimeOrder) -> DataFrame:
    """One row for each stretch, ``keys`` and state, ready to be merged.

    ``order`` tells among which rows the next one is looked for; its keys are some or all of ``keys``, whose runs of states are counted.
    """
    own = W.partitionBy(KEY, SLICE, *keys).orderBy(*order.sort())
    was = F.lag(F.struct(state)).over(own)
    rows = _steps(df, order).withColumns({
        "_was": was, "_first": was.isNull(), "_last": F.lead(F.lit(1)).over(own).isNull()})
    entered = ~F.col("_first") & ~F.col("_was")[state].eqNullSafe(F.col(state))
    return rows.groupBy(KEY, SLICE, *keys, state).agg(
        F.count_if(entered).alias("entries"), F.sum(micros("_next") - micros(order.time)).alias("micros"),
        F.max("_first").alias("first"), F.max("_last").alias("last"),
        F.max(F.when(F.col("_closes"), F.col(order.time))).alias("closes"))


def state_totals(
    df: DataFrame, keys: Sequence[str], state: str, as_of: Column | None = None, next_within: Sequence[str] | None = None,
    order: TimeOrder | None = None,
) -> DataFrame:
    """``keys``, state, ``entries`` into it, and ``seconds`` from its rows to the next ones.

    A NULL state is a state of its own, and the first row of a key enters its state. The last row lasts until ``as_of``, or
    adds nothing.
    """
    base = order or TimeOrder(keys=list(keys))
    order = TimeOrder(list(next_within if next_within is not None else keys), base.time, base.tie, base.slice_seconds, base.rows_per_slice)
    rows = df.select(*dict.fromkeys([*keys, *order.keys, order.time, *order.tie, state]))
    parts = state_summary(rows, keys, state, order)
    # When the next stretch begins; one row for each stretch, found in the same exchange.
    begins = _steps(rows, order).where("_opens").select(KEY, SLICE, F.lead(order.time).over(order.across()).alias("_follows"))
    met = parts.join(begins.hint("merge"), [KEY, SLICE], "left")
    # The state before this stretch. A slice is a number, so a range of it is all earlier stretches.
    runs = W.partitionBy(KEY, *keys).orderBy(SLICE).rangeBetween(W.unboundedPreceding, -1)
    met = met.withColumn("_before", F.last(F.when(F.col("last"), F.struct(state)), True).over(runs))
    entered = F.col("first") & ~F.coalesce(F.col("_before").isNotNull() & F.col("_before")[state].eqNullSafe(F.col(state)), F.lit(False))
    until = F.col("_follows") if as_of is None else F.coalesce("_follows", as_of)
    across = F.coalesce(micros(until) - micros("closes"), F.lit(0))
    return met.groupBy(*keys, state).agg(
        F.sum(F.col("entries") + entered.cast("long")).alias("entries"),
        (F.sum(F.coalesce("micros", F.lit(0)) + across) / F.lit(_MICROS)).alias("seconds"))


def stay_totals(
    df: DataFrame, keys: Sequence[str], inside: Column, order: TimeOrder | None = None,
) -> DataFrame:
    """``keys``, number ``stays`` and time ``stay_seconds`` of completed stays: runs of rows where ``inside`` holds, with a row before and after.

    Of each stretch the time inside is kept apart by where it lies: before the first row outside (``head``),
    after the last one (``tail``), between them, or all along (``through``). Head time counts if some earlier stretch has a row
    outside, tail time if a later one has, and time all along if both do. Keys without a completed stay have no row.
    """
    base = order or TimeOrder(keys=list(keys))
    order = TimeOrder(list(keys), base.time, base.tie, base.slice_seconds, base.rows_per_slice)
    marked = df.select(*dict.fromkeys([*keys, order.time, *order.tie]), inside.alias("_in"))
    slice_ = W.partitionBy(KEY, SLICE)
    rows = _steps(marked, order).withColumns({
        "_outs": F.count_if(~F.col("_in")).over(order.within().rowsBetween(W.unboundedPreceding, 0)),
        "_all_outs": F.count_if(~F.col("_in")).over(slice_),
        "_leaves": ~F.col("_in") & F.lag("_in").over(order.within())})
    lasts = micros("_next") - micros(order.time)

    def time(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_in") & where, lasts)), F.lit(0))

    some, early, late = F.col("_all_outs") > 0, F.col("_outs") == 0, F.col("_outs") == F.col("_all_outs")
    parts = rows.groupBy(KEY, SLICE).agg(
        time(some & early).alias("head"), time(some & late).alias("tail"), time(some & ~early & ~late).alias("between"),
        time(~some).alias("through"), F.count_if("_leaves").alias("left"), F.max("_all_outs").alias("outs"),
        F.max(F.col("_opens") & F.col("_in")).alias("opens_in"), F.max(F.col("_closes") & F.col("_in")).alias("closes_in"),
        F.min(order.time).alias("opens"), F.max(order.time).alias("closes"))
    across = order.across()
    # Frames that grow with the rows, in either direction: one that shrinks would be summed anew for every row.
    earlier, later = (order.across(d).rowsBetween(W.unboundedPreceding, -1) for d in (False, True))
    met = parts.withColumns({
        "_out_before": F.coalesce(F.max("outs").over(earlier), F.lit(0)) > 0,
        "_out_after": F.coalesce(F.max("outs").over(later), F.lit(0)) > 0,
        "_came_in": F.coalesce(F.lag("closes_in").over(across), F.lit(False)),
        "_follows": F.lead("opens").over(across)})
    some = F.col("outs") > 0
    # The time to the next stretch belongs to where the last row lies.
    border = F.when(F.col("closes_in"), F.coalesce(micros("_follows") - micros("closes"), F.lit(0))).otherwise(0)
    tail = F.col("tail") + F.when(some, border).otherwise(0)
    through = F.col("through") + F.when(~some, border).otherwise(0)
    before, after = F.col("_out_before"), F.col("_out_after")
    counted = (
        F.col("between") + F.when(before, F.col("head")).otherwise(0) + F.when(after, tail).otherwise(0)
        + F.when(before & after, through).otherwise(0))
    # The first exit of a stretch that opens inside ends a stay of earlier stretches; one that opens outside may end one at its first row.
    unknown = (F.col("opens_in") & some & ~before).cast("long")
    at_border = (~F.col("opens_in") & F.col("_came_in") & before).cast("long")
    totals = met.groupBy(KEY).agg(F.sum(F.col("left") - unknown + at_border).alias("stays"), (F.sum(counted) / F.lit(_MICROS)).alias("stay_seconds"))
    return totals.where("stays > 0").select(*[F.col(KEY)[k].alias(k) for k in keys], "stays", "stay_seconds")
