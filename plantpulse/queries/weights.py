"""Weighing reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.plans import weighing as plan
from plantpulse.queries.registry import query
from plantpulse.session import staged


def rounded(df, digits=6, skip=()):
    """Round every double column."""
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double" and f.name not in skip]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def _rollup_sql(keys, bucket, extra="", source="weights"):
    return f"""
SELECT {', '.join(keys)}, {bucket} AS bucket, count(result_code) AS results, round(max(setpoint), 6) AS setpoint,
  round(max(max_over), 6) AS max_over, round(max(max_under), 6) AS max_under, count(net) AS boxes,
  round(sum(net), 6) AS total_weight, round(min(net), 6) AS min_weight, round(max(net), 6) AS max_weight,
  round(avg(net), 6) AS avg_weight, round(stddev_samp(net), 6) AS stddev_weight,
  first(time ORDER BY net, time, uuid) AS filling_first_time,
  first(time ORDER BY net DESC, time DESC, uuid DESC) AS filling_last_time,
  min(time) AS first_time, max(time) AS last_time, round(avg(tare), 6) AS avg_tare, max(module_key) AS module_key{extra}
FROM {source} WHERE net IS NOT NULL GROUP BY ALL"""


_HOUR = "date_trunc('hour', time)"


@query("weight_hourly", _rollup_sql(plan.HOURLY_KEYS, _HOUR))
def _(p):
    return rounded(plan.hourly(p.weights))


@query("weight_daily", _rollup_sql(plan.DAILY_KEYS, "date_trunc('day', time)::TIMESTAMP"))
def _(p):
    return rounded(plan.daily(p.weights))


@query("weight_hourly_ids", _rollup_sql([*plan.HOURLY_KEYS, "custom_1", "custom_2"], _HOUR,
                                        ", arg_min(uuid, time) AS uuid"))
def _(p):
    return rounded(plan.hourly_with_ids(p.weights))


@query("weight_15min", """
SELECT recipe, batch, unit_id, time_bucket(INTERVAL 15 MINUTE, time) AS bucket, min(time) AS first_time,
  max(time) AS last_time, count(net) AS boxes, round(avg(net), 6) AS avg_net, round(sum(net), 6) AS total_net,
  round(avg(tare), 6) AS avg_tare, arg_max(setpoint, time) AS last_setpoint
FROM weights WHERE unit_id = 'W1' GROUP BY ALL""")
def _(p):
    return rounded(plan.quarter_hourly(p.weights, "W1"))


_HOURLY_CTE = f"WITH h AS ({_rollup_sql(plan.HOURLY_KEYS, _HOUR)})"


def _stored_hourly(p):
    """The hourly rollup as a stored table, which is what the summaries read."""
    return staged(plan.hourly(p.weights), "hourly")


def _summary_sql(pattern, batch="batch"):
    return f"""
{_HOURLY_CTE},
s AS (SELECT * FROM h WHERE lower(recipe) LIKE '{pattern}'),
m AS (SELECT batch, recipe FROM s GROUP BY batch, recipe
      QUALIFY row_number() OVER (PARTITION BY batch ORDER BY count(*) DESC, recipe) = 1),
t AS (SELECT batch, setpoint FROM s GROUP BY batch, setpoint
      QUALIFY row_number() OVER (PARTITION BY batch ORDER BY count(*) DESC, setpoint) = 1),
g AS (SELECT batch, min(filling_first_time) AS t0, max(filling_last_time) AS t1, sum(total_weight) AS kg,
        sum(boxes)::BIGINT AS boxes FROM s GROUP BY batch)
SELECT cast(g.batch AS INTEGER) AS id, m.recipe, t0 AS batch_start, t1 AS batch_end,
  round((epoch_us(t1) - epoch_us(t0)) / 1e6, 6) AS duration_seconds, t.setpoint AS target_weight,
  round(kg / 1000, 6) AS tonnes, round(kg * 3.6 / nullif((epoch_us(t1) - epoch_us(t0)) / 1e6, 0), 6) AS tonnes_per_hour,
  boxes, round((kg / boxes)::DECIMAL(38, 10), 2)::DOUBLE AS avg_weight
FROM g JOIN m ON m.batch = g.batch JOIN t ON t.batch = g.batch ORDER BY g.batch DESC LIMIT 20"""


@query("weight_batch_summary", _summary_sql("%"))
def _(p):
    return rounded(plan.batch_summary(_stored_hourly(p), limit=20), skip=["avg_weight"])


@query("weight_batch_summary_pattern", _summary_sql("%j1%"))
def _(p):
    return rounded(plan.batch_summary(_stored_hourly(p), "%J1%", limit=20), skip=["avg_weight"])


@query("batch_throughput", f"""
{_HOURLY_CTE},
g AS (SELECT recipe, batch, min(first_time) AS t0, max(last_time) AS t1, sum(results)::BIGINT AS boxes,
        sum(total_weight) / 1000 AS tonnes FROM h GROUP BY recipe, batch),
d AS (SELECT *, (epoch_us(t1) - epoch_us(t0)) / 1e6 / 3600 AS hours FROM g)
SELECT recipe, batch, t0 AS batch_start, t1 AS batch_end, round(hours, 6) AS hours, boxes,
  round(tonnes::DECIMAL(38, 10), 3)::DOUBLE AS tonnes,
  round((tonnes / nullif(hours, 0))::DECIMAL(38, 10), 2)::DOUBLE AS tonnes_per_hour,
  round((boxes / nullif(hours, 0))::DECIMAL(38, 10), 0)::DOUBLE AS boxes_per_hour,
  round((boxes / nullif(hours * 60, 0))::DECIMAL(38, 10), 0)::DOUBLE AS boxes_per_minute FROM d""")
def _(p):
    return plan.batch_throughput(plan.hourly(p.weights)).withColumn("hours", F.round("hours", 6))


@query("batch_start", f"""
{_HOURLY_CTE}, b AS (SELECT batch, min(filling_first_time) AS batch_start FROM h GROUP BY batch)
SELECT w.uuid, w.batch, b.batch_start FROM weights w JOIN b ON b.batch = w.batch""")
def _(p):
    starts = plan.batch_start(plan.hourly(p.weights))
    return p.weights.select("uuid", "batch").join(starts, "batch").select("uuid", "batch", "batch_start")


_CONSTANTS = """
WITH f AS (SELECT batch, CASE unit_code WHEN 0 THEN 1000 WHEN 1 THEN 1 WHEN 2 THEN 1000000 WHEN 3 THEN 453.59237 END::DOUBLE
             AS unit_factor FROM weights QUALIFY row_number() OVER (PARTITION BY batch ORDER BY time, uuid) = 4),
m AS (SELECT batch, setpoint FROM weights GROUP BY batch, setpoint
      QUALIFY row_number() OVER (PARTITION BY batch ORDER BY count(*) DESC, setpoint) = 1),
b AS (SELECT batch, count(net) AS boxes, avg(net) AS mean, stddev_samp(net) AS sd, min(setpoint) AS lowest,
        min(unit_code) AS unit_code, min(time) AS time, max(time) AS end_time, min(line) AS line, min(machine) AS machine,
        min(serial) AS serial, min(recipe) AS recipe FROM weights GROUP BY batch),
t AS (SELECT b.*, f.unit_factor, m.setpoint * f.unit_factor AS target_weight
      FROM b LEFT JOIN f ON f.batch = b.batch LEFT JOIN m ON m.batch = b.batch),
c AS (SELECT *, target_weight AS g, CASE
  WHEN target_weight > 15000 THEN target_weight * 0.01::DOUBLE WHEN target_weight > 10000 THEN 150
  WHEN target_weight > 1000 THEN target_weight * 0.015::DOUBLE WHEN target_weight > 500 THEN 15
  WHEN target_weight > 300 THEN target_weight * 0.03::DOUBLE WHEN target_weight > 200 THEN 9
  WHEN target_weight > 100 THEN target_weight * 0.045::DOUBLE WHEN target_weight > 50 THEN 4.5
  WHEN target_weight > 5 THEN target_weight * 0.09::DOUBLE END::DOUBLE AS tu1 FROM t)"""

_BANDS = [("below_tu2", "x < g - tu1 * 2"), ("below_tu1", "x >= g - tu1 * 2 AND x < g - tu1"),
          ("below_qn", "x >= g - tu1 AND x < g"), ("below_to1", "x >= g AND x < g + tu1"),
          ("below_to2", "x >= g + tu1 AND x < g + tu1 * 2"), ("above_to2", "x >= g + tu1 * 2")]
_BAND_SQL = ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in _BANDS)
_SHARES = ", ".join(f"round({n} / nullif(boxes, 0) * 100, 6) AS {n}_percent" for n, _ in _BANDS)
_NAMES = ", ".join(n for n, _ in _BANDS)


@query("metrology_batch", f"""{_CONSTANTS},
x AS (SELECT w.batch, w.net * c.unit_factor AS x, c.g, c.tu1 FROM weights w JOIN c ON c.batch = w.batch),
n AS (SELECT batch, {_BAND_SQL} FROM x GROUP BY batch)
SELECT c.batch, time, end_time, line, machine, serial, recipe, target_weight, boxes, round(mean * unit_factor, 6) AS avg_weight,
  round(sd * unit_factor, 6) AS stddev_grams, round((mean - lowest) / nullif(lowest, 0) * 100, 6) AS giveaway_percent,
  unit_code, unit_factor, round(tu1, 6) AS tu1, round(tu1 * 2, 6) AS tu2, round(g - tu1 * 2, 6) AS min_tu2,
  round(g - tu1, 6) AS min_tu1, round(g, 6) AS qn, round(g + tu1, 6) AS max_to1, round(g + tu1 * 2, 6) AS max_to2,
  {_NAMES}, {_SHARES}
FROM c JOIN n ON n.batch = c.batch""")
def _(p):
    return rounded(plan.metrology(p.weights))


@query("metrology_borders", f"""
WITH b AS (SELECT batch, count(net) AS boxes, avg(net) * 1000 AS avg_weight, min(setpoint) AS s, min(unit_code) AS u
           FROM weights GROUP BY batch),
c AS (SELECT *, s * CASE u WHEN 0 THEN 1000 WHEN 1 THEN 1 WHEN 2 THEN 1000000 END::DOUBLE AS g, CASE
  WHEN s * 1000 > 15000 THEN s * 1000 * 0.01::DOUBLE WHEN s * 1000 > 10000 THEN 150
  WHEN s * 1000 > 1000 THEN s * 1000 * 0.015::DOUBLE ELSE NULL END::DOUBLE AS tu1 FROM b),
x AS (SELECT w.batch, w.net * 1000 AS x, c.g, c.tu1 FROM weights w JOIN c ON c.batch = w.batch),
n AS (SELECT batch, {_BAND_SQL} FROM x GROUP BY batch)
SELECT c.batch, boxes, round(avg_weight, 6) AS avg_weight, round(tu1, 6) AS tu1, round(tu1 * 2, 6) AS tu2,
  round(g - tu1 * 2, 6) AS min_tu2, round(g - tu1, 6) AS min_tu1, round(g, 6) AS qn, round(g + tu1, 6) AS max_to1,
  round(g + tu1 * 2, 6) AS max_to2, round((avg_weight - g) / nullif(g, 0) * 100, 6) AS giveaway_percent, {_NAMES}
FROM c JOIN n ON n.batch = c.batch""")
def _(p):
    return rounded(plan.metrology_borders(p.weights))


@query("setpoint_conflicts", """
SELECT batch, count(DISTINCT setpoint) AS setpoints, min(setpoint) AS smallest, max(setpoint) AS largest, count(*) AS rows
FROM weights GROUP BY batch HAVING count(DISTINCT setpoint) > 1""")
def _(p):
    return plan.setpoint_conflicts(p.weights)


@query("batch_weight_profile", """
WITH m AS (SELECT batch, setpoint FROM weights GROUP BY batch, setpoint
           QUALIFY row_number() OVER (PARTITION BY batch ORDER BY count(*) DESC, setpoint) = 1)
SELECT w.batch, count(net) AS boxes, round(avg(net), 6) AS avg_net, min(w.setpoint) AS min_setpoint,
  max(w.setpoint) AS max_setpoint, min(unit_code) AS min_unit, max(unit_code) AS max_unit, round(sum(net), 6) AS total,
  any_value(m.setpoint) AS mode_setpoint, min(w.setpoint) * count(net) AS nominal_total
FROM weights w JOIN m ON m.batch = w.batch GROUP BY w.batch""")
def _(p):
    return rounded(plan.batch_profile(p.weights))


@query("accuracy_ratio", """
WITH l AS (SELECT setpoint - max_under AS lo, setpoint + max_over AS hi FROM weights ORDER BY time DESC, uuid DESC LIMIT 1)
SELECT count(net) AS total, count(net) FILTER (net > (SELECT lo FROM l) AND net < (SELECT hi FROM l)) AS inside,
  round(count(net) FILTER (net > (SELECT lo FROM l) AND net < (SELECT hi FROM l)) / nullif(count(net), 0), 6) AS share
FROM weights WHERE time > TIMESTAMP '2024-01-10 06:00:00' AND recipe = 'J1' AND unit_id = 'W1'""")
def _(p):
    since = F.col("time") > F.lit("2024-01-10 06:00:00").cast("timestamp_ntz")
    return rounded(plan.accuracy_ratio(p.weights, since & (F.col("recipe") == "J1") & (F.col("unit_id") == "W1")))


@query("period_throughput", """
SELECT round(sum(net) / 1000, 6) AS tonnes, round(864000 / 3.6, 6) AS period_hours, round(864000 / 3600.0, 6)::DOUBLE
  AS period_hours_true, round(sum(net) / (864000 / 3.6), 6) AS tonnes_per_hour
FROM weights WHERE time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-15'""")
def _(p):
    start, end = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-05", "2024-01-15"))
    return rounded(plan.period_throughput(p.weights, start, end))
