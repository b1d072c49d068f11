"""Sorting, top rows and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.operators.ordered import TimeOrder, with_next_rows
from plantpulse.plans.alarms import consolidated
from plantpulse.plans.weighing import nth_row
from plantpulse.queries.registry import query


@query("sort_limit", "SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 25")
def _(p):
    newest_first = [F.col("ts").desc_nulls_first(), F.col("event_id").desc_nulls_first()]
    return p.table("events").select("event_id", "ts", "value").orderBy(*newest_first).limit(25)


@query("limit_offset", """
SELECT 'all' AS scope, uuid, time, unit_code FROM (SELECT * FROM weights WHERE batch = '1' ORDER BY time, uuid LIMIT 1 OFFSET 3)
UNION ALL SELECT batch, uuid, time, unit_code FROM
  (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY time, uuid) AS n FROM weights) WHERE n = 4""")
def _(p):
    w = p.weights.select("batch", "uuid", "time", "unit_code")
    one = w.where(F.col("batch") == "1").orderBy("time", "uuid").offset(3).limit(1)
    columns = ["uuid", "time", "unit_code"]
    per_batch = nth_row(w, ["batch"], 4, columns).select(F.col("batch").alias("scope"), *columns)
    return one.select(F.lit("all").alias("scope"), *columns).unionByName(per_batch)


@query("topk_entities", """
WITH m AS (SELECT serial, max(time) AS t FROM general WHERE program_state IS NOT NULL GROUP BY serial ORDER BY t DESC, serial LIMIT 10)
SELECT count(*) AS machines, min(t) AS earliest FROM m""")
def _(p):
    recent = p.general.where(F.col("program_state").isNotNull()).groupBy("serial").agg(F.max("time").alias("t"))
    top = recent.orderBy(F.col("t").desc_nulls_first(), "serial").limit(10)
    return top.agg(F.count("*").alias("machines"), F.min("t").alias("earliest"))


@query("topk_per_group", """
WITH z AS (SELECT uuid, serial, time FROM alarms WHERE state = 20),
r AS (SELECT z.uuid AS anchor, a.uuid, a.state, row_number() OVER (PARTITION BY z.uuid ORDER BY a.time, a.uuid) AS pos
      FROM z JOIN alarms a ON a.serial = z.serial AND a.time >= z.time AND a.uuid <> z.uuid)
SELECT anchor, uuid, state, pos FROM r WHERE pos <= 3""")
def _(p):
    rows = with_next_rows(p.alarms, TimeOrder(keys=["serial"]), 3, "after", ["uuid", "state"], same_instant=True)
    anchors = rows.where(F.col("state") == 20).select(F.col("uuid").alias("anchor"), F.posexplode("after").alias("i", "r"))
    return anchors.select("anchor", "r.uuid", "r.state", (F.col("i") + 1).cast("bigint").alias("pos"))


@query("sort_text_as_number", """
SELECT day_batch, count(*) AS n FROM general GROUP BY day_batch ORDER BY cast(day_batch AS INTEGER) DESC LIMIT 15""")
def _(p):
    counts = p.general.groupBy("day_batch").agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("day_batch").try_cast("decimal(20,0)").desc_nulls_first()).limit(15)


@query("setop_union_distinct", """
SELECT uuid, time, serial, state FROM alarms WHERE state <> 0
UNION SELECT a.uuid, a.time, a.serial, a.state FROM alarms a
JOIN (SELECT uuid, state, lead(uuid) OVER (PARTITION BY serial, idx ORDER BY time, uuid) AS n FROM alarms) s
  ON s.n = a.uuid WHERE s.state <> a.state""")
def _(p):
    columns = ["uuid", "time", "serial", "state"]
    edges = consolidated(p.alarms).where("edge").select(*columns)
    return p.alarms.where(F.col("state") != 0).select(*columns).union(edges).distinct()


@query("setop_union_counts", """
WITH c AS (SELECT count(*) FILTER (l_quantity > 49) AS hi, count(*) FILTER (l_quantity < 2) AS lo FROM lineitem)
SELECT hi AS too_high, lo AS too_low, hi + lo AS outside,
  (SELECT sum(n)::BIGINT FROM (SELECT hi AS n FROM c UNION SELECT lo FROM c)) AS outside_union FROM c""")
def _(p):
    # A union that drops duplicates loses one of two equal counts; both sums are shown.
    hi, lo = F.count_if(F.col("l_quantity") > 49), F.count_if(F.col("l_quantity") < 2)
    return p.table("lineitem").agg(
        hi.alias("too_high"), lo.alias("too_low"), (hi + lo).alias("outside"),
        F.when(hi == lo, hi).otherwise(hi + lo).alias("outside_union"))


@query("setop_union_all", """
SELECT 'alarm' AS source, uuid, time FROM alarms WHERE state = 10
UNION ALL SELECT 'weight', uuid, time FROM weights WHERE result_code = 20
UNION ALL SELECT 'general', uuid, time FROM general WHERE program_state IS NULL""")
def _(p):
    def labelled(df, label):
        return df.select(F.lit(label).alias("source"), "uuid", "time")

    return (
        labelled(p.alarms.where(F.col("state") == 10), "alarm")
        .unionByName(labelled(p.weights.where(F.col("result_code") == 20), "weight"))
        .unionByName(labelled(p.general.where(F.col("program_state").isNull()), "general")))


@query("setop_union_limited", """
(SELECT time, machine, recipe FROM general ORDER BY time DESC, uuid DESC LIMIT 1)
UNION (SELECT time, machine, recipe FROM weights ORDER BY time, uuid LIMIT 1)""")
def _(p):
    last = p.general.orderBy(F.col("time").desc_nulls_first(), F.col("uuid").desc()).limit(1)
    first = p.weights.orderBy(F.col("time").asc_nulls_last(), "uuid").limit(1)
    return last.select("time", "machine", "recipe").union(first.select("time", "machine", "recipe")).distinct()
