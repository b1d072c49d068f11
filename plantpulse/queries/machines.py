"""Machine state and production reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.functions.time import bucket
from plantpulse.operators.ordered import carry
from plantpulse.plans import machines as plan
from plantpulse.plans.production import box_production, merge_box_production
from plantpulse.queries.registry import query
from plantpulse.session import staged
from plantpulse.sources import tables


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _carry_sql(state):
    # The newest known row up to each row, by a join of rows with known rows.
    return f"""
WITH g AS (SELECT uuid, time, serial, {state} AS state,
             CASE WHEN time < TIMESTAMP '2024-01-16' THEN {state} END AS carried FROM general),
opened AS (SELECT min(time) AS first_open FROM g WHERE carried IS NULL),
seen AS (SELECT serial, max(time) AS last_known FROM g, opened WHERE state IS NOT NULL AND time <= first_open GROUP BY serial),
since AS (SELECT min(last_known) AS since FROM seen),
known AS (SELECT serial, time, uuid, state FROM g, since WHERE state IS NOT NULL AND time >= since)
SELECT g.uuid, g.serial, g.time, coalesce(known.state, g.carried) AS carried
FROM g CROSS JOIN since LEFT JOIN known
  ON known.serial = g.serial AND (known.time, known.uuid) <= (g.time, g.uuid) AND g.time >= since
QUALIFY row_number() OVER (PARTITION BY g.uuid ORDER BY known.time DESC NULLS LAST, known.uuid DESC) = 1"""


def _carried(p, state):
    done = F.when(F.col("time") < F.lit("2024-01-16").cast("timestamp_ntz"), F.col(state))
    general = p.general.select("uuid", "time", "serial", state).withColumn("carried", done)
    return plan.carry_forward(general, state, "carried").select("uuid", "serial", "time", "carried")


@query("state_carry_forward", _carry_sql("program_state"))
def _(p):
    return _carried(p, "program_state")


@query("mode_carry_forward", _carry_sql("mode_state"))
def _(p):
    return _carried(p, "mode_state")


# A change is a row whose newest earlier row of the same run of the machine has another state; it ends with the earliest later change.
_TIMELINE = """
c AS (
  SELECT r.* FROM g r JOIN g b ON (b.line, b.serial, b.recipe, b.day_batch) = (r.line, r.serial, r.recipe, r.day_batch)
    AND (b.time, b.uuid) < (r.time, r.uuid)
  QUALIFY row_number() OVER (PARTITION BY r.uuid ORDER BY b.time DESC, b.uuid DESC) = 1 AND b.program_state <> r.program_state),
ended AS (
  SELECT c.*, min(n.time) AS end_time FROM c JOIN c n
    ON (n.line, n.serial, n.recipe, n.day_batch) = (c.line, c.serial, c.recipe, c.day_batch) AND (n.time, n.uuid) > (c.time, c.uuid)
  GROUP BY ALL),
l AS (SELECT *, (epoch_us(end_time) - epoch_us(time)) / 1e6 AS duration_seconds FROM ended)"""
# A state that follows from the position, so that it changes inside a batch of one recipe.
_MIXED_SQL = """
WITH g AS (SELECT uuid, time, line, machine, serial, 'all' AS recipe, batch AS day_batch, mode_state, program_state
           FROM general WHERE mode_state IS NOT NULL OR program_state IS NOT NULL),"""


def _mixed(p):
    return p.general.withColumn("recipe", F.lit("all"))


@query("state_timeline", f"""{_MIXED_SQL} {_TIMELINE}
SELECT uuid, time, end_time, round(duration_seconds, 6) AS duration_seconds, line, machine, serial, recipe,
  day_batch AS batch, mode_state, program_state FROM l""")
def _(p):
    return _rounded(plan.state_timeline(_mixed(p)), "duration_seconds")


# The newest known state up to each row, by a join of rows with known rows.
_FILLED_SQL = """
WITH filled AS (
  SELECT r.uuid, r.time, r.line, r.machine, r.serial, 'all' AS recipe, r.batch AS day_batch, r.mode_state, k.program_state
  FROM general r LEFT JOIN general k ON k.serial = r.serial AND k.program_state IS NOT NULL AND (k.time, k.uuid) <= (r.time, r.uuid)
  QUALIFY row_number() OVER (PARTITION BY r.uuid ORDER BY k.time DESC NULLS LAST, k.uuid DESC) = 1),
g AS (SELECT * FROM filled WHERE mode_state IS NOT NULL OR program_state IS NOT NULL),"""


@query("state_timeline_carried", f"""{_FILLED_SQL} {_TIMELINE}
SELECT uuid, time, end_time, round(duration_seconds, 6) AS duration_seconds, line, machine, serial, recipe,
  day_batch AS batch, mode_state, program_state FROM l""")
def _(p):
    filled = staged(carry(_mixed(p), plan.BY_MACHINE, program_state="program_state"), "carried")
    return _rounded(plan.state_timeline(filled), "duration_seconds")


@query("batch_state_rollup", f"""{_MIXED_SQL} {_TIMELINE}
SELECT line, machine, recipe, day_batch AS batch, mode_state, program_state, min(time) AS first_start,
  arg_max(time, end_time) AS last_end_start, max(end_time) AS last_end,
  round(sum(duration_seconds), 6) AS total_seconds, round(sum(duration_seconds) / 60, 3) AS total_minutes,
  round(sum(duration_seconds) / 3600, 3) AS total_hours, count(program_state) AS occurrences,
  arg_min(uuid, time) AS first_uuid, arg_max(uuid, time) AS last_uuid
FROM l GROUP BY line, machine, recipe, day_batch, mode_state, program_state""")
def _(p):
    rollup = plan.batch_state_rollup(plan.state_timeline(_mixed(p)))
    return _rounded(_rounded(rollup, "total_seconds"), "total_minutes", "total_hours", digits=3)


def _production_sql(source, condition=""):
    return f"""
  SELECT min(time) AS time, line, machine, serial, recipe, day_batch AS batch, min(time) AS batch_start,
    max(time) AS batch_end, round((((epoch_us(max(time)) - epoch_us(min(time))) / 1e6)) / 3600, 6) AS duration_hours,
    max(total_cases) - min(total_cases) + 1 AS boxes,
    round((max(total_cases) - min(total_cases)) / nullif((((epoch_us(max(time)) - epoch_us(min(time))) / 1e6)) / 3600, 0), 4)
      AS boxes_per_hour, arg_min(uuid, time) AS first_uuid, arg_max(uuid, time) AS last_uuid
  FROM {source} WHERE line IS NOT NULL AND serial IS NOT NULL AND recipe IS NOT NULL {condition}
  GROUP BY line, machine, serial, recipe, day_batch"""


def _production(general):
    boxes = box_production(general, batch="day_batch")
    return boxes.withColumns(
        {"duration_hours": F.round("duration_hours", 6), "boxes_per_hour": F.round("boxes_per_hour", 4)})


@query("box_production", _production_sql("general"))
def _(p):
    return _production(p.general)


@query("box_production_merge", f"""
WITH new AS ({_production_sql("general")}),
old AS ({_production_sql("general", "AND time < TIMESTAMP '2024-01-16 08:00:00'")}),
j AS (SELECT old.first_uuid AS f, new.last_uuid <> old.last_uuid AS changed, new.* FROM new
      LEFT JOIN old ON old.first_uuid = new.first_uuid)
SELECT * EXCLUDE (f, changed) FROM j WHERE f IS NULL OR changed
UNION ALL
SELECT old.* FROM old WHERE first_uuid NOT IN (SELECT f FROM j WHERE f IS NOT NULL AND changed)""")
def _(p):
    early = p.general.where(F.col("time") < F.lit("2024-01-16 08:00:00").cast("timestamp_ntz"))
    return merge_box_production(_production(early), _production(p.general))


_PERIODS = """
WITH r AS (SELECT serial, recipe, time, uuid,
    dense_rank() OVER (PARTITION BY serial ORDER BY time, uuid)
    - dense_rank() OVER (PARTITION BY serial, recipe ORDER BY time, uuid) AS island
  FROM general {filter}),
d AS (SELECT serial, recipe, min(time) AS time_from, max(time) AS time_to
      FROM r GROUP BY serial, recipe, island HAVING count(*) > 1)"""


@query("recipe_periods", _PERIODS.format(
    filter="WHERE time > TIMESTAMP '2024-01-03' AND time < TIMESTAMP '2024-01-28'") + " SELECT * FROM d")
def _(p):
    start, end = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-03", "2024-01-28"))
    return plan.recipe_periods(p.general, start, end)


@query("recipe_periods_epoch", _PERIODS.format(filter="") + """
SELECT serial, recipe, epoch_us(time_from) / 1000.0::DOUBLE AS from_ms, epoch_us(time_to) / 1000.0::DOUBLE AS to_ms FROM d""")
def _(p):
    return plan.recipe_periods_epoch(p.general)


def _durations_sql(next_within):
    return f"""
WITH b AS (SELECT serial, batch, program_state, uuid, time FROM general WHERE program_state IS NOT NULL),
i AS (SELECT *, dense_rank() OVER (PARTITION BY serial, batch ORDER BY time, uuid)
        - dense_rank() OVER (PARTITION BY serial, batch, program_state ORDER BY time, uuid) AS island,
        ((epoch_us(coalesce(lead(time) OVER (PARTITION BY {next_within} ORDER BY time, uuid),
                       (SELECT max(time) FROM general))) - epoch_us(time)) / 1e6) AS seconds FROM b),
d AS (SELECT serial, batch, program_state, count(DISTINCT island) AS runs, sum(seconds) AS total_seconds
      FROM i GROUP BY serial, batch, program_state)"""


@query("state_durations", _durations_sql("batch") + """
SELECT serial, batch, program_state, runs, round(total_seconds, 6) AS total_seconds FROM d""")
def _(p):
    g = p.general
    return _rounded(plan.state_durations(g, tables.newest(g), next_within=["batch"]), "total_seconds")


@query("state_durations_machine", _durations_sql("serial, batch") + """
SELECT serial, batch, program_state, runs, round(total_seconds, 6) AS total_seconds FROM d""")
def _(p):
    g = p.general
    return _rounded(plan.state_durations(g, tables.newest(g)), "total_seconds")


@query("state_group_report", _durations_sql("batch") + """
SELECT serial, batch, 'alarm' AS state_group, sum(runs)::BIGINT AS runs, round(sum(total_seconds), 6) AS total_seconds
FROM d WHERE program_state = 600 GROUP BY serial, batch
UNION
SELECT serial, batch, 'waiting', sum(runs)::BIGINT, round(sum(total_seconds), 6)
FROM d WHERE program_state IN (100, 200, 300, 400, 500) GROUP BY serial, batch""")
def _(p):
    g = p.general
    durations = plan.state_durations(g, tables.newest(g), next_within=["batch"])
    return _rounded(plan.state_group_report(durations), "total_seconds")


def _stays_sql(key, source="general"):
    # A stay is a run of rows in the state: the difference of two numberings is the same all along a run. It is
    # complete if a row stands before its first and after its last one.
    return f"""
WITH numbered AS (
  SELECT {key} AS k, time, program_state = 600 AS inside,
    row_number() OVER (PARTITION BY {key} ORDER BY time, uuid) AS i,
    row_number() OVER (PARTITION BY {key}, program_state = 600 ORDER BY time, uuid) AS j
  FROM {source} WHERE program_state IS NOT NULL),
spans AS (SELECT k, min(i) AS enters, max(i) + 1 AS leaves FROM numbered WHERE inside GROUP BY k, i - j),
x AS (SELECT s.k, a.time AS entered, b.time AS time FROM spans s
      JOIN numbered a ON a.k = s.k AND a.i = s.enters JOIN numbered b ON b.k = s.k AND b.i = s.leaves WHERE s.enters > 1)"""


@query("alarm_count_time", _stays_sql("batch") + """
SELECT k AS batch, count(*) AS stays, round(sum(((epoch_us(time) - epoch_us(entered)) / 1e6)), 6) AS stay_seconds FROM x GROUP BY k""")
def _(p):
    return _rounded(plan.stay_totals(p.general, ["batch"]), "stay_seconds")


@query("alarm_count_time_recent", _stays_sql("1", """(
    SELECT * FROM general WHERE program_state IS NOT NULL ORDER BY time DESC, uuid DESC LIMIT 1000)""") + """
SELECT count(*) AS stays, round(sum(((epoch_us(time) - epoch_us(entered)) / 1e6)), 6) AS stay_seconds FROM x""")
def _(p):
    newest = p.general.where(F.col("program_state").isNotNull()).orderBy(
        F.col("time").desc(), F.col("uuid").desc()).limit(1000)
    return _rounded(plan.stay_totals(newest, []), "stay_seconds")


@query("state_backfill", """
WITH b AS (SELECT * FROM general WHERE batch = (SELECT max(batch) FROM general))
SELECT b.uuid, b.serial, b.time, known.program_state FROM b
LEFT JOIN b known ON known.serial = b.serial AND known.program_state IS NOT NULL AND (known.time, known.uuid) <= (b.time, b.uuid)
QUALIFY row_number() OVER (PARTITION BY b.uuid ORDER BY known.time DESC NULLS LAST, known.uuid DESC) = 1""")
def _(p):
    g = p.general
    last = g.agg(F.max("batch")).scalar()
    return plan.state_backfill(g, last).select("uuid", "serial", "time", "program_state")


_FLAGS = ["in_production", "default_state", "ready"]
_FLAG_SQL = " UNION ALL ".join(
    f"SELECT machine, machine_index, batch, '{f}' AS flag, {f} AS state, start_time, end_time, seconds FROM s" for f in _FLAGS)


# The list of batches lacks one that the status rows have, which takes the times of the first listed one after it.
@query("flag_state_durations", f"""
WITH o AS (SELECT batch, min(time) AS start_time FROM general WHERE batch <> '1' GROUP BY batch),
p AS (SELECT batch, start_time, coalesce((SELECT min(o.start_time) FROM o WHERE o.start_time > q.start_time),
             (SELECT max(time) FROM general)) AS end_time FROM o q),
m AS (SELECT a.batch AS asked, arg_min(p.batch, CAST(p.batch AS BIGINT)) AS found
      FROM (SELECT DISTINCT batch FROM status) a LEFT JOIN p ON CAST(p.batch AS BIGINT) >= CAST(a.batch AS BIGINT) GROUP BY a.batch),
s AS (SELECT t.*, p.start_time, p.end_time,
        ((epoch_us(coalesce(lead(t.time) OVER (PARTITION BY t.machine, t.machine_index, t.batch ORDER BY t.time, t.uuid), p.end_time)) - epoch_us(t.time)) / 1e6) AS seconds
      FROM status t JOIN m ON m.asked = t.batch LEFT JOIN p ON p.batch = m.found)
SELECT machine, machine_index, batch, flag, state, start_time, end_time, round(sum(seconds), 6) AS duration_seconds,
  round(((epoch_us(end_time) - epoch_us(start_time)) / 1e6), 6) AS batch_seconds
FROM ({_FLAG_SQL}) GROUP BY machine, machine_index, batch, flag, state, start_time, end_time""")
def _(p):
    g = p.general
    listed = plan.batch_periods(g.where(F.col("batch") != "1"))
    durations = plan.flag_durations(p.status, listed, tables.newest(g), _FLAGS)
    return durations.withColumns({
        "duration_seconds": F.round("duration_seconds", 6), "batch_seconds": F.round("batch_seconds", 6)})


@query("batch_moments", """
WITH b AS (SELECT serial, batch, min(time) AS t0, max(time) AS t1, arg_min(recipe, time) AS r0,
             arg_max(recipe, time) AS r1 FROM general GROUP BY serial, batch)
SELECT serial, batch, 'start batch' AS moment, t0 AS time, r0 AS recipe FROM b
UNION ALL SELECT serial, batch, 'end batch', t1, r1 FROM b
UNION ALL SELECT b.serial, b.batch, 'first fill', min(w.time), arg_min(w.recipe, w.time)
  FROM b JOIN weights w ON w.serial = b.serial AND w.time >= b.t0 AND w.result_code = 20 GROUP BY b.serial, b.batch
UNION ALL SELECT b.serial, b.batch, 'last fill', max(w.time), arg_max(w.recipe, w.time)
  FROM b JOIN weights w ON w.serial = b.serial AND w.time <= b.t1 AND w.result_code = 20 GROUP BY b.serial, b.batch""")
def _(p):
    return plan.batch_moments(p.general, p.weights.where(F.col("result_code") == 20))


@query("batch_overview", _stays_sql("batch") + """,
a AS (SELECT k AS batch, count(*) AS alarm_count, sum(((epoch_us(time) - epoch_us(entered)) / 1e6)) AS alarm_seconds FROM x GROUP BY k),
r AS (SELECT batch, recipe FROM general GROUP BY batch, recipe
      QUALIFY row_number() OVER (PARTITION BY batch ORDER BY count(*) DESC, recipe) = 1),
g AS (SELECT batch, min(time) AS t0, max(time) AS t1, sum(box_made)::BIGINT AS boxes FROM general GROUP BY batch)
SELECT g.batch, r.recipe, epoch_us(t0) / 1000.0::DOUBLE AS start_ms, epoch_us(t1) / 1000.0::DOUBLE AS end_ms,
  round(((epoch_us(t1) - epoch_us(t0)) / 1e6), 6) AS duration_seconds, boxes,
  round(boxes * 60 / nullif(((epoch_us(t1) - epoch_us(t0)) / 1e6), 0), 6) AS boxes_per_minute,
  coalesce(a.alarm_count, 0) AS alarm_count, round(coalesce(a.alarm_seconds, 0.0), 6) AS alarm_seconds
FROM g LEFT JOIN r ON r.batch = g.batch LEFT JOIN a ON a.batch = g.batch""")
def _(p):
    overview = _rounded(plan.batch_overview(p.general), "duration_seconds", "boxes_per_minute")
    return _rounded(overview, "alarm_seconds")


@query("production_hourly", """
SELECT date_trunc('hour', time) AS hour, machine, serial, recipe, batch, sum(box_made)::BIGINT AS boxes,
  arg_max(box_made, time) AS last_value
FROM general WHERE time > (SELECT max(time) FROM general) - INTERVAL 25 HOUR AND serial IS NOT NULL GROUP BY ALL""")
def _(p):
    g = p.general
    return plan.production_hourly(g, tables.newest(g))


@query("production_minutely", """
SELECT time_bucket(INTERVAL 60 SECOND, time) AS minute, recipe, arg_max(box_made, time) AS last_value
FROM general WHERE recipe IS NOT NULL GROUP BY ALL""")
def _(p):
    named = p.general.where(F.col("recipe").isNotNull())
    return named.groupBy(bucket("time", 60).alias("minute"), "recipe").agg(
        F.max_by("box_made", F.struct("time", "uuid")).alias("last_value"))
