"""Windows over ordered telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.functions.time import seconds_between
from plantpulse.operators.ordered import TimeOrder, carry, islands, with_next, with_previous
from plantpulse.plans.alarms import BY_ALARM, transitions
from plantpulse.plans.machines import BY_MACHINE, runs
from plantpulse.queries.registry import query
from plantpulse.session import staged
from plantpulse.sources.tables import newest


@query("win_lead_state", """
SELECT uuid, serial, state, lead(uuid) OVER w AS next_uuid, lead(state) OVER w AS next_state
FROM alarms WINDOW w AS (PARTITION BY serial, idx ORDER BY time, uuid)""")
def _(p):
    return with_next(p.alarms, BY_ALARM, next_uuid="uuid", next_state="state").select(
        "uuid", "serial", "state", "next_uuid", "next_state")


@query("win_lag_state", """
SELECT uuid, serial, batch, program_state, lag(program_state) OVER w AS previous_state, lag(time) OVER w AS previous_time
FROM general WINDOW w AS (PARTITION BY serial, batch ORDER BY time, uuid)""")
def _(p):
    order = TimeOrder(keys=["serial", "batch"])
    return with_previous(p.general, order, previous_state="program_state", previous_time="time").select(
        "uuid", "serial", "batch", "program_state", "previous_state", "previous_time")


@query("win_row_number_island", """
WITH r AS (SELECT serial, idx, state, time,
    row_number() OVER (ORDER BY serial, idx, time, uuid)
    - row_number() OVER (PARTITION BY serial, idx, state ORDER BY time, uuid) AS island FROM alarms)
SELECT serial, idx, state, min(time) AS start_time FROM r GROUP BY serial, idx, state, island""")
def _(p):
    return runs(p.alarms, BY_ALARM, "state").select(
        "serial", "idx", "state", F.col("time_from").alias("start_time"))


@query("win_dense_rank_island", """
WITH r AS (SELECT serial, recipe, time, uuid, value_rank FROM (
  SELECT serial, recipe, time, uuid, dense_rank() OVER (ORDER BY serial, time, uuid)
    - dense_rank() OVER (PARTITION BY recipe ORDER BY serial, time, uuid) AS value_rank FROM general))
SELECT serial, recipe, min(time) AS time_from, max(time) AS time_to, count(*) AS n
FROM r GROUP BY serial, recipe, value_rank""")
def _(p):
    rows = p.general.select("uuid", "time", "serial", "recipe")
    tagged = islands(rows, BY_MACHINE, ["recipe"])
    return tagged.groupBy("serial", "recipe", "island").agg(
        F.min("time").alias("time_from"), F.max("time").alias("time_to"), F.count("*").alias("n")).drop("island")


@query("win_duration_to_next", """
SELECT uuid, serial, ((epoch_us(coalesce(lead(time) OVER (PARTITION BY serial ORDER BY time, uuid),
    (SELECT max(time) FROM general))) - epoch_us(time)) / 1e6)::DOUBLE AS seconds,
  ((epoch_us(coalesce(lead(time) OVER (ORDER BY time, uuid), (SELECT max(time) FROM general)))
    - epoch_us(time)) / 1e6)::DOUBLE AS seconds_any_machine
FROM general""")
def _(p):
    g = TimeOrder(keys=[]).sliced(p.general.select("uuid", "time", "serial"))
    both = with_next(with_next(g, BY_MACHINE, _next="time"), TimeOrder(keys=[]), _next_any="time")
    end = newest(p.general)
    return both.select(
        "uuid", "serial", seconds_between("time", F.coalesce("_next", end)).alias("seconds"),
        seconds_between("time", F.coalesce("_next_any", end)).alias("seconds_any_machine"))


@query("win_locf_count", """
SELECT g.uuid, g.serial, g.mode_state, known.mode_state AS carried FROM general g LEFT JOIN general known
  ON known.serial = g.serial AND known.mode_state IS NOT NULL AND (known.time, known.uuid) <= (g.time, g.uuid)
QUALIFY row_number() OVER (PARTITION BY g.uuid ORDER BY known.time DESC NULLS LAST, known.uuid DESC) = 1""")
def _(p):
    rows = p.general.select("uuid", "time", "serial", "mode_state")
    return carry(rows, BY_MACHINE, carried="mode_state").select("uuid", "serial", "mode_state", "carried")


@query("win_row_number_dedupe", """
SELECT machine, idx, batch, state, uuid, time FROM alarms
QUALIFY row_number() OVER (PARTITION BY machine, idx, batch, state ORDER BY time, uuid) = 1""")
def _(p):
    # The first row is a minimum, which Spark reduces before the shuffle.
    first = p.alarms.groupBy("machine", "idx", "batch", "state").agg(F.min(F.struct("time", "uuid")).alias("f"))
    return first.select("machine", "idx", "batch", "state", "f.uuid", "f.time")


@query("win_max_over_all", """
WITH g AS (SELECT recipe, setpoint, count(*) AS frequency FROM weights GROUP BY ALL)
SELECT recipe, setpoint, frequency, round(frequency / max(frequency) OVER (), 6) AS share FROM g""")
def _(p):
    g = p.weights.groupBy("recipe", "setpoint").agg(F.count("*").alias("frequency"))
    top = g.agg(F.max("frequency")).scalar()
    return g.withColumn("share", F.round(F.col("frequency") / top, 6))


@query("win_next_in_subset", """
SELECT uuid, serial, time, lead(uuid) OVER (PARTITION BY serial, idx ORDER BY time, uuid) AS next_zero
FROM alarms WHERE state = 0""")
def _(p):
    zeros = p.alarms.where(F.col("state") == 0)
    return with_next(zeros, BY_ALARM, next_zero="uuid").select("uuid", "serial", "time", "next_zero")


@query("win_next_end_columns", """
WITH c AS (SELECT *, lag(state) OVER (PARTITION BY serial, idx ORDER BY time, uuid) AS was FROM alarms),
n AS (SELECT *, lead(time) OVER (PARTITION BY serial, idx ORDER BY time, uuid) AS nxt FROM c WHERE was <> state)
SELECT uuid, serial, state, CASE WHEN state IN (1, 10) THEN nxt END AS active_end,
  CASE WHEN state = 20 THEN nxt END AS waiting_end, CASE WHEN state = 0 THEN time END AS alarm_end FROM n""")
def _(p):
    n = with_next(staged(transitions(BY_ALARM.sliced(p.alarms)), "alarm-changes"), BY_ALARM, nxt="time")
    state = F.col("state")
    return n.select(
        "uuid", "serial", "state", F.when(state.isin(1, 10), F.col("nxt")).alias("active_end"),
        F.when(state == 20, F.col("nxt")).alias("waiting_end"), F.when(state == 0, F.col("time")).alias("alarm_end"))
