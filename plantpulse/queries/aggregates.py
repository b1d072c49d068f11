"""Aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.functions.time import bucket
from plantpulse.functions.values import ratio
from plantpulse.operators import aggregates as agg
from plantpulse.operators.gapfill import gapfill, gapfill_carried
from plantpulse.operators.ordered import TimeOrder
from plantpulse.plans import machines, metrics, weighing
from plantpulse.plans.alarms import modal_interval
from plantpulse.queries.registry import query
from plantpulse.queries.weights import _CONSTANTS, rounded
from plantpulse.sources import footers


@query("agg_global", """
SELECT count(*) AS n, round(sum(l_quantity), 2) AS total, min(l_quantity) AS smallest, max(l_quantity) AS largest,
  round(avg(l_quantity), 6) AS mean FROM lineitem""")
def _(p):
    q = F.col("l_quantity")
    return p.table("lineitem").agg(
        F.count("*").alias("n"), F.round(F.sum(q), 2).alias("total"), F.min(q).alias("smallest"),
        F.max(q).alias("largest"), F.round(F.avg(q), 6).alias("mean"))


@query("agg_group", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS total, round(avg(l_discount), 6) AS discount
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def _(p):
    return p.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("total"),
        F.round(F.avg("l_discount"), 6).alias("discount"))


@query("agg_having_duplicates", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def _(p):
    return p.table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("agg_count_distinct", """
WITH c AS (SELECT serial, batch, count(DISTINCT setpoint) AS setpoints FROM weights GROUP BY serial, batch)
SELECT * FROM c WHERE setpoints > 1""")
def _(p):
    counts = p.weights.groupBy("serial", "batch").agg(F.count_distinct("setpoint").alias("setpoints"))
    return counts.where("setpoints > 1")


@query("agg_filtered", """
SELECT batch, count(*) FILTER (net < setpoint - max_under) AS under, count(*) FILTER (net > setpoint + max_over) AS above,
  count(*) FILTER (result_code = 20) AS flagged, round(avg(net) FILTER (result_code = 10), 6) AS normal_mean
FROM weights GROUP BY batch""")
def _(p):
    net = F.col("net")
    return p.weights.groupBy("batch").agg(
        F.count_if(net < F.col("setpoint") - F.col("max_under")).alias("under"),
        F.count_if(net > F.col("setpoint") + F.col("max_over")).alias("above"),
        F.count_if(F.col("result_code") == 20).alias("flagged"),
        F.round(F.avg(F.when(F.col("result_code") == 10, net)), 6).alias("normal_mean"))


@query("agg_first_last", """
SELECT serial, recipe, arg_min_null(mode_state, time) AS first_mode, arg_max_null(mode_state, time) AS last_mode,
  arg_min(uuid, time) AS first_uuid, arg_max(uuid, time) AS last_uuid FROM general GROUP BY serial, recipe""")
def _(p):
    at = F.struct("time", "uuid")
    return p.general.groupBy("serial", "recipe").agg(
        F.min_by("mode_state", at).alias("first_mode"), F.max_by("mode_state", at).alias("last_mode"),
        F.min(at)["uuid"].alias("first_uuid"), F.max(at)["uuid"].alias("last_uuid"))


@query("agg_mode", """
SELECT serial, setpoint AS mode_setpoint FROM weights GROUP BY serial, setpoint
QUALIFY row_number() OVER (PARTITION BY serial ORDER BY count(*) DESC, setpoint) = 1""")
def _(p):
    return agg.most_frequent(p.weights, ["serial"], "setpoint", "mode_setpoint")


@query("agg_stddev", "SELECT serial, batch, recipe, round(stddev_samp(net), 6) AS sd FROM weights GROUP BY serial, batch, recipe")
def _(p):
    return p.weights.groupBy("serial", "batch", "recipe").agg(F.round(F.stddev_samp("net"), 6).alias("sd"))


@query("agg_ratio", """
WITH n AS (SELECT count(net) FILTER ((net > 22.0 AND recipe = 'J0') OR (net < 18.0 AND recipe = 'J1')) AS bad,
             count(net) FILTER (recipe = 'J1') AS total FROM weights)
SELECT bad, total, total - bad AS good, round(bad / nullif(total, 0), 6) AS share FROM n""")
def _(p):
    # The numerator takes both recipes and the denominator one, as the original query does.
    net, recipe = F.col("net"), F.col("recipe")
    bad = F.count_if(((net > 22.0) & (recipe == "J0")) | ((net < 18.0) & (recipe == "J1")))
    total = F.count(F.when(recipe == "J1", net))
    return p.weights.agg(bad.alias("bad"), total.alias("total"), (total - bad).alias("good"),
                         F.round(ratio(bad, total), 6).alias("share"))


@query("agg_time_bucket", """
SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS bucket, event_type, count(*) AS n, round(sum(value), 6) AS total
FROM events GROUP BY ALL""")
def _(p):
    return p.table("events").groupBy(bucket("ts", 900).alias("bucket"), "event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query("agg_gapfill", """
WITH s AS (SELECT unnest(generate_series(time_bucket(INTERVAL 900 SECOND, lo), time_bucket(INTERVAL 900 SECOND, hi),
             INTERVAL 900 SECOND)) AS bucket FROM (SELECT min(time) lo, max(time) hi FROM weights)),
a AS (SELECT time_bucket(INTERVAL 900 SECOND, time) AS bucket, sum(net) AS total, count(net) AS boxes FROM weights GROUP BY 1)
SELECT s.bucket, round(total, 6) AS total, boxes, round(total / nullif(boxes, 0), 9) AS per_box,
  round(total * 4, 6) AS total_per_hour, boxes * 4 AS boxes_per_hour FROM s LEFT JOIN a ON a.bucket = s.bucket""")
def _(p):
    filled = gapfill(p.weights, [], 900, {"total": F.sum("net"), "boxes": F.count("net")})
    return filled.select(
        "bucket", F.round("total", 6).alias("total"), "boxes", F.round(ratio(F.col("total"), F.col("boxes")), 9).alias("per_box"),
        F.round(F.col("total") * 4, 6).alias("total_per_hour"), (F.col("boxes") * 4).alias("boxes_per_hour"))


@query("agg_gapfill_locf", """
WITH r AS (SELECT unnest(generate_series(date_trunc('hour', lo), date_trunc('hour', hi), INTERVAL 1 HOUR)) AS bucket
           FROM (SELECT min(time) lo, max(time) hi FROM general)),
s AS (SELECT k.serial, r.bucket FROM r, (SELECT DISTINCT serial FROM general) k),
a AS (SELECT serial, date_trunc('hour', time) AS bucket, avg(program_state) AS state FROM general GROUP BY 1, 2)
SELECT s.serial, s.bucket, round(last_value(a.state IGNORE NULLS) OVER (PARTITION BY s.serial ORDER BY s.bucket
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS state
FROM s LEFT JOIN a ON a.serial = s.serial AND a.bucket = s.bucket""")
def _(p):
    filled = gapfill_carried(p.general, ["serial"], 3600, {"state": F.avg("program_state")})
    return filled.select("serial", "bucket", F.round("state", 6).alias("state"))


@query("agg_rollup_two_level", """
WITH s AS (SELECT serial, batch, program_state, count(*) AS n FROM general GROUP BY ALL)
SELECT serial, batch, 'alarm' AS state_group, sum(n)::BIGINT AS n FROM s WHERE program_state = 600 GROUP BY serial, batch
UNION SELECT serial, batch, 'waiting', sum(n)::BIGINT FROM s WHERE program_state BETWEEN 100 AND 500 GROUP BY serial, batch""")
def _(p):
    sums = p.general.groupBy("serial", "batch", "program_state").agg(
        F.count("*").alias("runs"), F.lit(0.0).alias("total_seconds"))
    return machines.state_group_report(sums).select("serial", "batch", "state_group", F.col("runs").alias("n"))


_GAPS = """
WITH p AS (SELECT {by}, round((epoch_us(lead(time) OVER (PARTITION BY idx ORDER BY serial, time, uuid)) - epoch_us(time))
           / 1000.0::DOUBLE)::BIGINT AS interval_ms FROM alarms {filter})
SELECT {by}, interval_ms FROM p WHERE interval_ms IS NOT NULL GROUP BY {by}, interval_ms
QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, interval_ms) = 1"""


@query("agg_modal_interval", _GAPS.format(by="idx", filter=""))
def _(p):
    return modal_interval(p.alarms, "idx", zero_rows_only=False)


@query("agg_modal_interval_machine", _GAPS.format(by="serial", filter="WHERE state = 0 AND skey IS NOT NULL"))
def _(p):
    return modal_interval(p.alarms, "serial")


@query("agg_array_collect", """
SELECT recipe, batch, name, round(value, 6) AS value FROM (
  SELECT recipe, batch, unnest(['sum_net', 'avg_net', 'max_tare']) AS name, unnest([sum(net), avg(net), max(tare)]) AS value
  FROM weights GROUP BY recipe, batch)""")
def _(p):
    specs = [metrics.parse("weights|net|sum"), metrics.parse("weights|net|avg"), metrics.parse("weights|tare|max")]
    arrays = metrics.metric_arrays(p.weights, specs, ["recipe", "batch"])
    return metrics.unnest_arrays(arrays, ["recipe", "batch"]).select("recipe", "batch", "name", F.round("value", 6).alias("value"))


@query("agg_pivot_metrics", """
SELECT recipe, round(sum(net), 6) AS d1, round(avg(net) FILTER (result_code = 20), 6) AS d2, count(net)::DOUBLE AS d3,
  0.0::DOUBLE AS d4, 0.0::DOUBLE AS d5, 0.0::DOUBLE AS d6, 0.0::DOUBLE AS d7 FROM weights GROUP BY recipe""")
def _(p):
    texts = ["weights|net|sum", "weights|net|avg|result_code = 20", "weights|net|count"]
    return rounded(metrics.metric_columns(p.weights, [metrics.parse(t) for t in texts], ["recipe"], columns=7))


@query("agg_transition_count", """
WITH l AS (SELECT serial, program_state AS st, lag(program_state) OVER (PARTITION BY serial ORDER BY time, uuid) AS was FROM general)
SELECT serial, count(*) FILTER (st = 300 AND (was IS NULL OR was <> 300)) AS entries FROM l GROUP BY serial""")
def _(p):
    return agg.transition_count(p.general, TimeOrder(keys=["serial"]), "program_state", 300, "entries")


@query("agg_state_count_duration", """
WITH b AS (SELECT batch, serial, time, uuid, program_state AS st, lag(program_state) OVER w AS was FROM general
           WHERE program_state IS NOT NULL WINDOW w AS (PARTITION BY batch, serial ORDER BY time, uuid)),
t AS (SELECT *, lag(time) OVER (PARTITION BY batch, serial ORDER BY time, uuid) AS entered FROM b
      WHERE st <> was AND (st = 600 OR was = 600))
SELECT batch, serial, count(*) AS stays, round(sum((epoch_us(time) - epoch_us(entered)) / 1e6), 6) AS stay_seconds
FROM t WHERE entered IS NOT NULL AND st <> 600 GROUP BY batch, serial""")
def _(p):
    return rounded(machines.stay_totals(p.general, ["batch", "serial"]))


_GROUPS = """
WITH g AS (SELECT recipe, batch, serial, stddev_samp(net) AS s, avg(net) AS m, count(net) AS n FROM weights
           GROUP BY recipe, batch, serial HAVING count(net) > 1),
t AS (SELECT recipe, sum(n) AS n, sum(n * m) / sum(n) AS mean FROM g GROUP BY recipe)"""


def _group_stats(p):
    stats = p.weights.groupBy("recipe", "batch", "serial").agg(
        F.stddev_samp("net").alias("s"), F.avg("net").alias("m"), F.count("net").alias("n"))
    return stats.where("n > 1")


@query("agg_pooled_stddev", f"""{_GROUPS}
SELECT g.recipe, round(sqrt(sum(g.n * (s * s + (m - mean) * (m - mean))) / any_value(t.n)), 6) AS stddev,
  round(any_value(mean), 6) AS mean, any_value(t.n)::BIGINT AS n
FROM g JOIN t ON t.recipe = g.recipe GROUP BY g.recipe""")
def _(p):
    return rounded(agg.pooled_stddev(_group_stats(p), ["recipe"], "s", "m", "n"))


@query("agg_pooled_stddev_exact", """
SELECT recipe, round(stddev_samp(net), 6) AS stddev, round(avg(net), 6) AS mean, count(net) AS n
FROM (SELECT recipe, net, count(net) OVER (PARTITION BY recipe, batch, serial) AS c FROM weights) WHERE c > 1 GROUP BY recipe""")
def _(p):
    return rounded(agg.pooled_stddev(_group_stats(p), ["recipe"], "s", "m", "n", exact=True))


@query("agg_avg_of_groups", f"{_GROUPS} SELECT recipe, round(avg(s), 6) AS mean_sd, count(*) AS groups FROM g GROUP BY recipe")
def _(p):
    return _group_stats(p).groupBy("recipe").agg(F.round(F.avg("s"), 6).alias("mean_sd"), F.count("*").alias("groups"))


@query("agg_histogram", f"""{_CONSTANTS},
x AS (SELECT w.batch, w.net * c.unit_factor AS x, c.g - c.tu1 * 3 AS lo, c.g + c.tu1 * 3 AS hi, c.tu1
      FROM weights w JOIN c ON c.batch = w.batch),
k AS (SELECT *, CASE WHEN x < lo THEN 0 WHEN x >= hi THEN 7 ELSE floor((x - lo) / (hi - lo) * 6) + 1 END::BIGINT AS bucket FROM x),
h AS (SELECT batch, bucket, min(x) AS mn, max(x) AS mx, count(*) AS frequency, any_value(lo) AS lo, any_value(tu1) AS tu1
      FROM k WHERE x IS NOT NULL GROUP BY batch, bucket)
SELECT batch, bucket, round(mn, 6) AS bucket_min, round(mx, 6) AS bucket_max, frequency,
  round(lo + bucket * tu1, 6) AS bucket_floor, round(lo + (bucket + 1) * tu1, 6) AS bucket_ceiling,
  repeat('■', round(frequency / max(frequency) OVER (PARTITION BY batch) * 30)::INTEGER) AS bar FROM h""")
def _(p):
    return rounded(weighing.weight_histogram(p.weights))


@query("agg_bool_sum", """
SELECT event_type, date_trunc('hour', ts) AS hour, sum((value > 10)::INTEGER)::BIGINT AS high FROM events GROUP BY ALL""")
def _(p):
    high = F.sum((F.col("value") > 10).cast("int"))
    return p.table("events").groupBy("event_type", bucket("ts", 3600).alias("hour")).agg(high.alias("high"))


@query("agg_approx_rows", "SELECT count(*) AS exact, count(l_orderkey) > 0.9 * count(*) AS within_a_tenth FROM lineitem")
def _(p):
    # Both numbers stand in the footers; no row is read.
    lines = footers.table(p.spark, f"{p.folder}/lineitem.parquet")
    known = lines.agg(F.count(F.lit(1)).alias("exact"), F.count("l_orderkey").alias("keys"))
    return known.select("exact", (F.col("keys") > 0.9 * F.col("exact")).alias("within_a_tenth"))


@query("agg_footer_bounds", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, CAST(min({c}) AS DOUBLE) AS least, CAST(max({c}) AS DOUBLE) AS most FROM events"
    for c in ("event_id", "user_id", "value")))
def _(p):
    return footers.bounds(p.spark, f"{p.folder}/events.parquet", ["event_id", "user_id", "value"])


@query("agg_count_per_label", """
SELECT date_trunc('hour', logtime) AS hour, organization || ' / ' || dashboard AS label, count(category) AS refreshes
FROM access_log WHERE category = 'Dashboard' GROUP BY ALL""")
def _(p):
    label = F.concat("organization", F.lit(" / "), "dashboard").alias("label")
    visits = p.access_log.where(F.col("category") == "Dashboard")
    return visits.groupBy(bucket("logtime", 3600).alias("hour"), label).agg(F.count("category").alias("refreshes"))
