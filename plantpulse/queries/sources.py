"""Scans, series and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.plans.alarms import with_previous_state
from plantpulse.plans.production import box_production, merge_production_into
from plantpulse.plans.tenants import production, update_production
from plantpulse.queries.registry import query
from plantpulse.session import shared_folder
from plantpulse.sources import commits, series, sinks, tables

_DAY = 86_400


@query("scan_time_range", """
SELECT event_id, ts, user_id, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-12 12:00:00'""")
def _(p):
    return tables.time_range(
        p.table("events"), "2024-01-05 00:00:00", "2024-01-12 12:00:00",
        ["event_id", "ts", "user_id", "value"], time="ts")


@query("scan_recent", """
SELECT uuid, time, serial, net, tare, setpoint FROM weights
WHERE time > (SELECT max(time) FROM weights) - INTERVAL 60 MINUTE
ORDER BY time, uuid LIMIT 10""")
def _(p):
    w = p.weights.select("uuid", "time", "serial", "net", "tare", "setpoint")
    return tables.recent(w, tables.newest(w), minutes=90, limit=10, most_minutes=60)


@query("latest_snapshot", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def _(p):
    o = p.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return tables.latest_snapshot(o, "o_orderdate")


@query("series_numbers", """
WITH s AS (SELECT unnest(generate_series(0, cast(floor((hi - lo) / 0.5) AS BIGINT))) * 0.5 + lo AS value
           FROM (SELECT min(l_quantity) lo, max(l_quantity) hi FROM lineitem))
SELECT cast(s.value AS DOUBLE) AS value, count(l.l_quantity) AS n
FROM s LEFT JOIN lineitem l ON l.l_quantity = s.value GROUP BY s.value""")
def _(p):
    lines = p.table("lineitem")
    counts = lines.groupBy(F.col("l_quantity").alias("value")).agg(F.count("*").alias("n"))
    spine = series.number_series(lines, "l_quantity", 0.5)
    return spine.join(counts, "value", "left").select("value", F.coalesce("n", F.lit(0)).alias("n"))


@query("series_timestamps", """
WITH s AS (SELECT unnest(generate_series(date_trunc('hour', lo), hi, INTERVAL 1 HOUR)) AS moment
           FROM (SELECT min(ts) lo, max(ts) hi FROM events))
SELECT s.moment, cast(s.moment AS DATE) AS day, strftime(s.moment, '%H:%M:%S') AS clock, count(e.ts) AS n
FROM s LEFT JOIN events e ON date_trunc('hour', e.ts) = s.moment GROUP BY s.moment""")
def _(p):
    events = p.table("events")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    counts = events.groupBy(hour.alias("moment")).agg(F.count("*").alias("n"))
    return series.time_series(events, "ts", 3600).join(counts, "moment", "left").select(
        "moment", F.to_date("moment").alias("day"), F.date_format("moment", "HH:mm:ss").alias("clock"),
        F.coalesce("n", F.lit(0)).alias("n"))


@query("synthetic_batches", """
WITH b AS (SELECT o_orderkey AS batch_id, unnest(generate_series(1, o_orderkey % 5 + 1)) AS box_no FROM orders),
h AS (SELECT *, md5(batch_id || '-' || box_no) AS digest FROM b),
d AS (SELECT *, cast('0x' || substr(digest, 1, 6) AS BIGINT) AS draw FROM h)
SELECT batch_id, box_no, 10.0::DOUBLE + (draw % 1000)::DOUBLE / 100 AS weight, substr(digest, 1, 5) AS label,
  draw % 2 = 0 AS flag, CASE draw % 3 WHEN 0 THEN 'red' WHEN 1 THEN 'green' ELSE 'blue' END AS category
FROM d""")
def _(p):
    return series.synthetic_boxes(p.table("orders"), "o_orderkey")


@query("clone_slice", """
SELECT uuid, time, machine, state FROM alarms
UNION ALL SELECT -uuid - 1, time, 'clone-7', state FROM alarms WHERE state <> 0""")
def _(p):
    a = p.alarms.select("uuid", "time", "machine", "state")
    return series.clone_machine(a, F.col("state") != 0, "clone-7", -F.col("uuid") - 1)


@query("tenant_union", """
SELECT 'plant' || (cast(serial AS BIGINT) % 3) AS tenant, line, serial, recipe, batch,
  min(time) AS batch_start, max(time) AS batch_end, max(total_cases) - min(total_cases) + 1 AS boxes
FROM general GROUP BY ALL""")
def _(p):
    g = p.general
    plant = F.col("serial").cast("bigint") % 3
    all_plants = tables.tenants({f"plant{i}": g.where(plant == i) for i in range(3)})
    return box_production(all_plants, extra_keys=["tenant"]).select(
        "tenant", "line", "serial", "recipe", "batch", "batch_start", "batch_end", "boxes")


@query("sink_append_new", "SELECT uuid, time, machine, state FROM alarms")
def _(p):
    a = p.alarms.select("uuid", "time", "machine", "state")
    folder = shared_folder(p.spark, "append-new")
    a.where(F.col("time") < F.lit("2024-01-16").cast("timestamp_ntz")).write.parquet(folder)
    sinks.append_new(a, folder, ["uuid"])
    return p.spark.read.schema(a.schema).parquet(folder)


_BOXES = """
  SELECT line, machine, serial, recipe, batch, min(time) AS batch_start, max(time) AS batch_end,
    max(total_cases) - min(total_cases) + 1 AS boxes,
    arg_min(uuid, time) AS first_uuid, arg_max(uuid, time) AS last_uuid
  FROM general"""


@query("sink_merge_batches", f"""
WITH old AS ({_BOXES} WHERE time < TIMESTAMP '2024-01-16' GROUP BY ALL),
new AS ({_BOXES} GROUP BY ALL)
SELECT old.line, old.machine, old.serial, old.recipe, old.batch, old.batch_start,
  CASE WHEN new.last_uuid <> old.last_uuid THEN new.batch_end ELSE old.batch_end END AS batch_end,
  CASE WHEN new.last_uuid <> old.last_uuid THEN new.boxes ELSE old.boxes END AS boxes, old.first_uuid,
  CASE WHEN new.last_uuid <> old.last_uuid THEN new.last_uuid ELSE old.last_uuid END AS last_uuid
FROM old LEFT JOIN new ON old.first_uuid = new.first_uuid
UNION ALL
SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.first_uuid = new.first_uuid)""")
def _(p):
    columns = ["line", "machine", "serial", "recipe", "batch", "batch_start", "batch_end", "boxes",
               "first_uuid", "last_uuid"]
    early = p.general.where(F.col("time") < F.lit("2024-01-16").cast("timestamp_ntz"))
    stored, new = (box_production(x).select(*columns) for x in (early, p.general))
    return sinks.merge_batches(stored, new, "first_uuid", "last_uuid", ["batch_end", "boxes", "last_uuid"])


# As above, into a stored table in which only the days with a changed batch are written.
@query("sink_merge_parts", f"""
WITH old AS ({_BOXES} WHERE time < TIMESTAMP '2024-01-16' GROUP BY ALL),
new AS ({_BOXES} GROUP BY ALL)
SELECT new.line, new.machine, new.serial, new.recipe, new.batch, new.batch_start, new.batch_end, new.boxes, new.first_uuid, new.last_uuid
FROM new
UNION ALL
SELECT * FROM old WHERE old.first_uuid NOT IN (SELECT first_uuid FROM new)""")
def _(p):
    columns = ["line", "machine", "serial", "recipe", "batch", "batch_start", "batch_end", "boxes",
               "first_uuid", "last_uuid"]
    folder = shared_folder(p.spark, "production")
    early = p.general.where(F.col("time") < F.lit("2024-01-16").cast("timestamp_ntz"))
    for rows in (early, p.general):
        new = box_production(rows)
        merge_production_into(folder, new)
    return commits.read(p.spark, folder, new.schema).select(*columns)


# Two tenants; the second delivery of each brings its later rows and, half a day late, some of the earlier ones.
@query("job_tenant_production", """
SELECT 'plant' || (cast(serial AS BIGINT) % 2) AS tenant, line, serial, recipe, batch,
  min(time) AS batch_start, max(time) AS batch_end, max(total_cases) - min(total_cases) + 1 AS boxes,
  arg_min(uuid, (time, uuid)) AS first_uuid, arg_max(uuid, (time, uuid)) AS last_uuid
FROM general GROUP BY ALL""")
def _(p):
    folder, target = shared_folder(p.spark, "deliveries"), shared_folder(p.spark, "tenant-production")
    border, late = F.lit("2024-01-16").cast("timestamp_ntz"), F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    first = (F.col("time") < late) | ((F.col("time") < border) & (F.col("uuid") % 3 != 0))
    rows = p.general.select("uuid", "time", "line", "machine", "serial", "recipe", "batch", "total_cases")
    sources = {f"plant{i}": f"{folder}/plant{i}" for i in range(2)}
    for part in (first, ~first):
        for i, (_, path) in enumerate(sources.items()):
            rows.where(part & (F.col("serial").cast("bigint") % 2 == i)).write.mode("append").parquet(path)
        update_production(p.spark, {"target": target, "tenants": sources, "overlap_hours": 24})
    return production(p.spark, target).select(
        "tenant", "line", "serial", "recipe", "batch", "batch_start", "batch_end", "boxes", "first_uuid", "last_uuid")


@query("sink_backfill_column", """
SELECT g.uuid, g.serial, coalesce(a.state, g.mode_state) AS mode_state
FROM general g LEFT JOIN (SELECT uuid, nullif(state, 0) AS state FROM alarms) a ON a.uuid = g.uuid""")
def _(p):
    values = p.alarms.select("uuid", F.nullif(F.col("state"), F.lit(0.0)).alias("mode_state"))
    return sinks.backfill(p.general.select("uuid", "serial", "mode_state"), values, "uuid", "mode_state")


@query("sink_mark_rows", """
WITH p AS (SELECT uuid, state, lag(state) OVER (PARTITION BY serial, idx ORDER BY time, uuid) AS was FROM alarms)
SELECT a.uuid, a.state, CASE WHEN p.state = 0 AND p.was = 0 THEN 'out' END AS mark
FROM alarms a JOIN p ON p.uuid = a.uuid""")
def _(p):
    seen = with_previous_state(p.alarms.select("uuid", "time", "serial", "idx", "state"))
    both = (F.col("state") == 0) & (F.col("previous_state") == 0)
    return sinks.mark(seen, both).select("uuid", "state", "mark")


@query("sink_time_partitioned", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%dT%H-%M-%S') AS chunk, count(*) AS n,
  min(ts) AS first_time, max(ts) AS last_time FROM events GROUP BY 1""")
def _(p):
    events = p.table("events").select("event_id", F.col("ts").alias("time"), "user_id")
    folder = shared_folder(p.spark, "chunks")
    sinks.write_chunks(events, folder, _DAY)
    return sinks.read_chunks(p.spark, folder, events.schema).groupBy("chunk").agg(
        F.count("*").alias("n"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))


@query("apply_retention", """
SELECT event_id, ts FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY > (SELECT max(ts) FROM events) - INTERVAL 10 DAY""")
def _(p):
    events = p.table("events").select("event_id", "ts")
    return sinks.retain(events, tables.newest(events, "ts"), 10, _DAY, time="ts")


@query("stage_result", """
WITH per_machine AS (SELECT serial, recipe, count(*) AS n, sum(net) AS total FROM weights GROUP BY ALL)
SELECT 'machine' AS label, serial AS name, sum(n)::BIGINT AS n, round(sum(total), 4) AS total
FROM per_machine GROUP BY serial
UNION ALL
SELECT 'recipe', recipe, sum(n)::BIGINT, round(sum(total), 4) FROM per_machine GROUP BY recipe""")
def _(p):
    staged = p.weights.groupBy("serial", "recipe").agg(F.count("*").alias("n"), F.sum("net").alias("total"))

    def by(column, label):
        return staged.groupBy(F.col(column).alias("name")).agg(
            F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total")
        ).select(F.lit(label).alias("label"), "name", "n", "total")

    return by("serial", "machine").unionByName(by("recipe", "recipe"))


@query("delete_matching", """
SELECT uuid, mode_state, program_state FROM general
WHERE NOT coalesce(program_state = 600 OR mode_state = 2, false)""")
def _(p):
    g = p.general.select("uuid", "mode_state", "program_state")
    return sinks.delete_where(g, (F.col("program_state") == 600) | (F.col("mode_state") == 2))
