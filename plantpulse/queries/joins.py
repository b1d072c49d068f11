"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.operators.joins import asof, interval_join, translate
from plantpulse.operators.ordered import TimeOrder, with_next, with_next_rows
from plantpulse.plans.alarms import BY_ALARM, consolidated, transitions
from plantpulse.plans.machines import recipe_periods
from plantpulse.plans.production import box_production
from plantpulse.queries.alarms import _STEPS
from plantpulse.queries.registry import query
from plantpulse.session import staged
from plantpulse.sources.series import numbered
from plantpulse.sources.sinks import only_new


@query("join_successor", f"WITH {_STEPS} SELECT uuid, time, machine, idx, state FROM t")
def _(p):
    return transitions(p.alarms).select("uuid", "time", "machine", "idx", "state")


@query("join_successor_self", f"WITH {_STEPS} SELECT uuid, time, machine, idx, state FROM t")
def _(p):
    # The join of the table with its successors, kept as a check of the form without a join.
    successors = with_next(p.alarms, BY_ALARM, next_uuid="uuid", next_state="state").where(
        F.col("state") != F.col("next_state")).select(F.col("next_uuid").alias("uuid"))
    return p.alarms.join(successors, "uuid").select("uuid", "time", "machine", "idx", "state")


@query("join_left_successor", """
WITH s AS (SELECT uuid, program_state, lead(uuid) OVER (PARTITION BY serial, batch ORDER BY time, uuid) AS n FROM general)
SELECT g.uuid, g.time, g.serial, g.batch, g.program_state
FROM general g LEFT JOIN s ON s.n = g.uuid WHERE s.program_state <> g.program_state""")
def _(p):
    columns = ["uuid", "time", "serial", "batch", "program_state"]
    rows = p.general.select(*columns).withColumnRenamed("program_state", "state")
    order = TimeOrder(keys=["serial", "batch"])
    return transitions(rows, order).withColumnRenamed("state", "program_state").select(*columns)


@query("join_lateral_next3", f"""
WITH {_STEPS},
f AS (SELECT z.uuid AS anchor, t.uuid, t.state,
        row_number() OVER (PARTITION BY z.uuid ORDER BY t.time, t.uuid) AS pos
      FROM t z JOIN t ON t.machine = z.machine AND t.idx = z.idx AND t.time >= z.time AND t.uuid <> z.uuid WHERE z.state = 0)
SELECT anchor, uuid, state, pos FROM f WHERE pos <= 3""")
def _(p):
    changes = staged(transitions(BY_ALARM.sliced(p.alarms)), "alarm-changes")
    rows = with_next_rows(changes, TimeOrder(keys=["machine", "idx"]), 3, "after", ["uuid", "state"], same_instant=True)
    anchors = rows.where(F.col("state") == 0).select(F.col("uuid").alias("anchor"), F.posexplode("after").alias("i", "r"))
    return anchors.select("anchor", "r.uuid", "r.state", (F.col("i") + 1).cast("bigint").alias("pos"))


@query("join_lateral_point", """
WITH z AS (SELECT uuid, time, serial, lead(uuid) OVER (PARTITION BY serial, idx ORDER BY time, uuid) AS n
           FROM alarms WHERE state = 0)
SELECT z.uuid, z.serial, z.time, a.time AS end_time FROM z JOIN alarms a ON a.uuid = z.n""")
def _(p):
    zeros = with_next(p.alarms.where(F.col("state") == 0), BY_ALARM, end_time="time")
    return zeros.where(F.col("end_time").isNotNull()).select("uuid", "serial", "time", "end_time")


@query("join_anti_delete", """
WITH e AS (SELECT uuid, time, lead(uuid) OVER (PARTITION BY serial, idx ORDER BY time, uuid) AS block_uuid
           FROM alarms WHERE state = 0),
k AS (SELECT uuid AS block_uuid FROM alarms WHERE state = 0 AND time < TIMESTAMP '2024-01-16')
SELECT uuid, time, block_uuid FROM e WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.block_uuid = e.block_uuid)""")
def _(p):
    zeros = p.alarms.where(F.col("state") == 0)
    ends = with_next(zeros, BY_ALARM, block_uuid="uuid").select("uuid", "time", "block_uuid")
    stored = zeros.where(F.col("time") < F.lit("2024-01-16").cast("timestamp_ntz")).select(F.col("uuid").alias("block_uuid"))
    return only_new(ends, stored, ["block_uuid"]).select("uuid", "time", "block_uuid")


@query("join_anti_null_test", """
WITH p AS (SELECT uuid, state, lag(state) OVER (PARTITION BY serial, idx ORDER BY time, uuid) AS was FROM alarms),
c AS (SELECT uuid FROM p WHERE was <> state OR (was IS NOT NULL AND state <> 0))
SELECT a.uuid, a.time, a.state FROM alarms a LEFT JOIN c ON c.uuid = a.uuid WHERE c.uuid IS NULL""")
def _(p):
    return only_new(p.alarms, consolidated(p.alarms), ["uuid"]).select("uuid", "time", "state")


_SPANS = """SELECT serial, recipe, batch, arg_min(uuid, time) AS first_uuid, arg_max(uuid, time) AS last_uuid FROM general"""


@query("join_changed_or_new", f"""
WITH o AS ({_SPANS} WHERE time < TIMESTAMP '2024-01-16' GROUP BY ALL), n AS ({_SPANS} GROUP BY ALL)
SELECT n.* FROM n LEFT JOIN o ON o.first_uuid = n.first_uuid WHERE o.first_uuid IS NULL OR n.last_uuid <> o.last_uuid""")
def _(p):
    columns = ["serial", "recipe", "batch", "first_uuid", "last_uuid"]
    early = p.general.where(F.col("time") < F.lit("2024-01-16").cast("timestamp_ntz"))
    old = box_production(early).select("first_uuid", F.col("last_uuid").alias("_old"))
    new = box_production(p.general).select(*columns)
    changed = F.col("_old").isNull() | (F.col("last_uuid") != F.col("_old"))
    return new.join(old, "first_uuid", "left").where(changed).select(*columns)


@query("join_cross_constants", """
WITH c AS (SELECT batch, avg(net) AS mean, min(setpoint) AS lowest FROM weights GROUP BY batch)
SELECT w.uuid, w.batch, round(w.net - c.mean, 6) AS deviation, w.net - c.lowest AS over_setpoint
FROM weights w JOIN c ON c.batch = w.batch""")
def _(p):
    w = p.weights.select("uuid", "batch", "net")
    c = p.weights.groupBy("batch").agg(F.avg("net").alias("mean"), F.min("setpoint").alias("lowest"))
    return w.join(c, "batch").select("uuid", "batch", F.round(F.col("net") - F.col("mean"), 6).alias("deviation"),
                                     (F.col("net") - F.col("lowest")).alias("over_setpoint"))


PERIODS_SQL = """
r AS (SELECT serial, recipe, time, uuid, row_number() OVER (PARTITION BY serial ORDER BY time, uuid)
        - row_number() OVER (PARTITION BY serial, recipe ORDER BY time, uuid) AS island FROM general),
d AS (SELECT serial, recipe AS period_recipe, min(time) AS time_from, max(time) AS time_to
      FROM r GROUP BY serial, recipe, island HAVING count(*) > 1)"""


@query("join_period_metrics", f"""
WITH {PERIODS_SQL}
SELECT d.serial, d.period_recipe, d.time_from, d.time_to, count(*) AS n, round(sum(w.net), 6) AS total
FROM d JOIN weights w ON w.serial = d.serial AND w.time BETWEEN d.time_from AND d.time_to GROUP BY ALL""")
def _(p):
    periods = recipe_periods(p.general).withColumnRenamed("recipe", "period_recipe")
    inside = interval_join(p.weights.select("serial", "time", "net"), periods, ["serial"], "time_from", "time_to")
    return inside.groupBy("serial", "period_recipe", "time_from", "time_to").agg(
        F.count("*").alias("n"), F.round(F.sum("net"), 6).alias("total"))


@query("join_asof_first_last", """
SELECT g.uuid, g.serial, g.time, min(w.time) FILTER (w.time >= g.time) AS first_after,
  arg_min(w.net, w.time) FILTER (w.time >= g.time) AS net_after, max(w.time) FILTER (w.time <= g.time) AS last_before,
  arg_max(w.net, w.time) FILTER (w.time <= g.time) AS net_before
FROM general g LEFT JOIN weights w ON w.serial = g.serial AND w.result_code = 20
WHERE g.program_state = 600 GROUP BY g.uuid, g.serial, g.time""")
def _(p):
    probes = p.general.where(F.col("program_state") == 600).select("uuid", "serial", "time")
    fills = p.weights.where(F.col("result_code") == 20).select("uuid", "serial", "time", "net")
    after = asof(probes, fills, ["serial"], {"first_after": "time", "net_after": "net"}, forward=True)
    return asof(after, fills, ["serial"], {"last_before": "time", "net_before": "net"})


@query("join_spine_left", """
WITH s AS (SELECT unnest(generate_series(lo, hi)) AS bin FROM (
  SELECT min(floor(c_acctbal / 1000))::BIGINT lo, max(floor(c_acctbal / 1000))::BIGINT hi FROM customer WHERE c_acctbal < 9000))
SELECT s.bin, count(c.c_custkey) AS n, count(c.c_custkey) FILTER (c_mktsegment = 'BUILDING') AS building
FROM s LEFT JOIN customer c ON floor(c.c_acctbal / 1000) = s.bin GROUP BY s.bin""")
def _(p):
    customers = p.table("customer")
    bin_ = F.floor(F.col("c_acctbal") / 1000)
    spine = customers.where("c_acctbal < 9000").agg(F.min(bin_).alias("lo"), F.max(bin_).alias("hi"))
    spine = numbered(spine, F.col("hi") - F.col("lo")).select((F.col("lo") + F.col("i")).alias("bin"))
    counts = customers.groupBy(bin_.alias("bin")).agg(
        F.count("*").alias("n"), F.count_if(F.col("c_mktsegment") == "BUILDING").alias("building"))
    return spine.join(counts, "bin", "left").na.fill(0, ["n", "building"])


@query("join_lookup_fallback", """
WITH k AS (SELECT uuid, skey, '_' || split_part(skey, '_', 2) || '_1_' || split_part(skey, '_', 4) || '_'
             || split_part(skey, '_', 5) AS general_key FROM alarms)
SELECT k.uuid, k.skey, x.translation AS dutch, y.translation AS unknown
FROM k LEFT JOIN translations x ON x.unique_key = 'nl_BE_6' || k.general_key
LEFT JOIN translations y ON y.unique_key = 'en_US_6' || k.general_key""")
def _(p):
    rows = p.alarms.select("uuid", "skey")
    dutch = translate(rows, p.translations, "nl_BE", 6).withColumnRenamed("translation", "dutch")
    return translate(dutch, p.translations, "da_DD", 6).select("uuid", "skey", "dutch", F.col("translation").alias("unknown"))


@query("join_right_status", """
SELECT l.l_partkey, p.p_name, l.n FROM (SELECT * FROM part WHERE p_size > 25) p
RIGHT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) l ON l.l_partkey = p.p_partkey""")
def _(p):
    definitions = p.table("part").where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    status = p.table("lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return definitions.join(status, "l_partkey", "right").select("l_partkey", "p_name", "n")


@query("join_using_multi", """
WITH b AS (SELECT l_suppkey, l_returnflag, count(*) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_discount <= 0.08 GROUP BY ALL),
x AS (SELECT l_suppkey, l_returnflag, count(*) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_discount > 0.08 AND l_quantity > 45 GROUP BY ALL)
SELECT b.l_suppkey, b.l_returnflag, coalesce(b.n, 0) + coalesce(x.n, 0) AS n, round(coalesce(b.q, 0) + coalesce(x.q, 0), 2) AS q
FROM b LEFT JOIN x USING (l_suppkey, l_returnflag)""")
def _(p):
    lines, keys = p.table("lineitem"), ["l_suppkey", "l_returnflag"]

    def sums(rows, name):
        return lines.where(rows).groupBy(*keys).agg(F.count("*").alias(f"n_{name}"), F.sum("l_quantity").alias(f"q_{name}"))

    joined = sums("l_discount <= 0.08", "base").join(sums("l_discount > 0.08 AND l_quantity > 45", "part"), keys, "left")
    joined = joined.na.fill(0)
    return joined.select(*keys, (F.col("n_base") + F.col("n_part")).alias("n"),
                         F.round(F.col("q_base") + F.col("q_part"), 2).alias("q"))


@query("join_key_pair_self", """
SELECT a.uuid, a.machine, a.state, b.time AS other_time FROM alarms a JOIN alarms b ON b.uuid = a.uuid""")
def _(p):
    other = p.alarms.select("uuid", F.col("time").alias("other_time"))
    return p.alarms.select("uuid", "machine", "state").join(other, "uuid")
