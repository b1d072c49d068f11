"""Stream jobs and their incremental counterparts, run over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.operators import digests
from plantpulse.plans import weighing
from plantpulse.plans.alarms import alarm_lines
from plantpulse.queries.alarms import _LINE_COLUMNS, _LINES, _STEPS, _rounded
from plantpulse.queries.registry import query
from plantpulse.queries.weights import _HOUR, _rollup_sql, rounded
from plantpulse.session import shared_folder
from plantpulse.sources.tables import newest
from plantpulse.streaming import jobs, rollups

_THIRDS = ["2024-01-11", "2024-01-21"]


def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


def _events_stream(p):
    schema = p.table("events").schema
    return jobs.read_stream(p.spark, p.folder, schema, "events.parquet")


def _delivered(p, parts, run):
    """Deliver parts of a table one after the other, and run the job on what is there after each.

    ``run`` takes the stream and starts the job; the job takes up where it stopped.
    """
    folder = shared_folder(p.spark, "feed")
    for part in parts:
        part.write.mode("append").parquet(folder)
        run(jobs.read_stream(p.spark, folder, parts[0].schema)).awaitTermination()


def _thirds():
    first, second = (_ts(t) for t in _THIRDS)
    at = F.col("time")
    return [at < first, (at >= first) & (at < second), at >= second]


def _by_time(df):
    return [df.where(third) for third in _thirds()]


@query("stream_weight_hourly", f"""
SELECT * FROM ({_rollup_sql(weighing.HOURLY_KEYS, _HOUR)})
WHERE bucket + INTERVAL 1 HOUR <= (SELECT max(time) FROM weights) - INTERVAL 10 DAY""")
def _(p):
    stream = rollups.stream_rollup(p.view("weights", _events_stream(p)))
    out = shared_folder(p.spark, "stream-hourly")
    rollups.write_stream(stream, out, shared_folder(p.spark, "stream-hourly-state")).awaitTermination()
    return rounded(p.spark.read.schema(stream.schema).parquet(out))


# The stored rollup lacks the late rows, which only the refreshed window gets to see.
_LATE = "uuid % 20 = 0"


@query("stream_refresh_window", f"""
WITH lim AS (SELECT max(time) - INTERVAL 10 DAY AS lo, max(time) - INTERVAL 24 HOUR AS hi FROM weights),
early AS (SELECT * FROM weights WHERE NOT ({_LATE})),
o AS ({_rollup_sql(weighing.HOURLY_KEYS, _HOUR, source="early")}),
n AS ({_rollup_sql(weighing.HOURLY_KEYS, _HOUR)})
SELECT n.* FROM n, lim WHERE bucket >= lo AND bucket + INTERVAL 1 HOUR <= hi
UNION ALL SELECT o.* FROM o, lim WHERE NOT (bucket >= lo AND bucket + INTERVAL 1 HOUR <= hi)""")
def _(p):
    w = p.weights
    folder = shared_folder(p.spark, "rollup")
    rollups.stored_rollup(w.where(f"NOT ({_LATE})"), folder)
    as_of = newest(w)
    start, end = as_of - F.expr("INTERVAL '10' DAY"), as_of - F.expr("INTERVAL '24' HOUR")
    rollups.refresh_window(w, folder, start, end)
    return rounded(p.spark.read.parquet(folder).drop("day"))


# Late rows come in two deliveries; each refresh computes the buckets that the ledger names, and no other.
@query("stream_refresh_ledger", f"SELECT * FROM ({_rollup_sql(weighing.HOURLY_KEYS, _HOUR)})")
def _(p):
    w = p.weights
    folder, ledger = shared_folder(p.spark, "rollup"), shared_folder(p.spark, "ledger")
    rollups.stored_rollup(w.where("uuid % 20 > 1"), folder)
    for run, come in enumerate(("uuid % 20 = 1", "uuid % 20 = 0")):
        rollups.note_touched(w.where(come), ledger, run)
        rollups.refresh_touched(w.where(f"uuid % 20 > 1 OR {come} OR uuid % 20 = 1"), folder, ledger)
    return rounded(p.spark.read.parquet(folder).drop("day"))


@query("stream_late_repair", """
SELECT g.uuid, g.serial, g.time, known.program_state AS carried FROM general g LEFT JOIN general known
  ON known.serial = g.serial AND known.program_state IS NOT NULL AND (known.time, known.uuid) <= (g.time, g.uuid)
QUALIFY row_number() OVER (PARTITION BY g.uuid ORDER BY known.time DESC NULLS LAST, known.uuid DESC) = 1""")
def _(p):
    g = p.general.select("uuid", "time", "serial", "program_state")
    late = F.col("uuid") % 20 == 0
    folder, state = shared_folder(p.spark, "carried"), shared_folder(p.spark, "carried-state")
    parts = [*_by_time(g.where(~late)), g.where(late)]
    _delivered(p, parts, lambda feed: jobs.each_batch(feed, jobs.late_repair(folder), state))
    return p.spark.read.parquet(folder).select("uuid", "serial", "time", "carried")


@query("stream_alarm_blocks", f"""
WITH {_STEPS},
z AS (SELECT uuid, serial, idx, time, lag(time) OVER w AS since, lag(uuid) OVER w AS anchor FROM t WHERE state = 0
      WINDOW w AS (PARTITION BY serial, idx ORDER BY time, uuid)),
f AS (SELECT t.*, z.uuid AS block_uuid FROM z JOIN t ON t.serial = z.serial AND t.idx = z.idx
      AND (t.time, t.uuid) > (z.since, z.anchor) AND (t.time, t.uuid) <= (z.time, z.uuid) WHERE z.anchor IS NOT NULL),
k AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY block_uuid, state ORDER BY time, uuid) = 1),
n AS (SELECT *, lead(time) OVER (PARTITION BY block_uuid ORDER BY time, uuid) AS next_time FROM k),
{_LINES}{_LINE_COLUMNS}""")
def _(p):
    lines, held = (shared_folder(p.spark, name) for name in ("alarm-lines", "alarm-held"))
    step, state = jobs.alarm_blocks(lines, held), shared_folder(p.spark, "alarm-state")
    # Some rows come one part late.
    a, late = p.alarms, F.col("uuid") % 20 == 0
    first, second, third = _thirds()
    parts = [a.where(first & ~late), a.where(second & ~late | first & late), a.where(third | second & late)]
    _delivered(p, parts, lambda feed: jobs.each_batch(feed, step, state))
    return _rounded(jobs.current_lines(p.spark, lines))


@query("stream_append_dedupe", "SELECT uuid, time, serial, program_state FROM general")
def _(p):
    g = p.general.select("uuid", "time", "serial", "program_state")
    parts = _by_time(g)
    # Every part is delivered again together with the one after it.
    again = [parts[0], parts[0].unionByName(parts[1]), parts[1].unionByName(parts[2])]
    out, state = shared_folder(p.spark, "unique"), shared_folder(p.spark, "unique-state")
    jobs.on_disk(p.spark)
    _delivered(p, again, lambda feed: rollups.write_stream(jobs.drop_repeats(feed, late="40 days"), out, state))
    return p.spark.read.schema(g.schema).parquet(out)


@query("stream_locf", """
SELECT serial, max(time) AS time, arg_max(program_state, time) AS program_state FROM general
WHERE program_state IS NOT NULL GROUP BY serial""")
def _(p):
    parts = _by_time(p.general.select("uuid", "time", "serial", "program_state"))
    folder, state = shared_folder(p.spark, "last-state"), shared_folder(p.spark, "last-state-state")
    step = jobs.store_updates(folder)
    _delivered(p, parts, lambda feed: jobs.each_batch(jobs.last_known_state(feed), step, state, mode="update"))
    jobs.compact_updates(p.spark, folder, "serial")
    return jobs.latest_updates(p.spark, folder, "serial")


# Hourly digests of three deliveries, merged into whole batches.
@query("stream_digests", """
WITH c AS (SELECT line, batch, recipe, count(*) AS times FROM weights WHERE recipe IS NOT NULL GROUP BY ALL),
m AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY line, batch ORDER BY times DESC, recipe) = 1)
SELECT w.line, w.batch, count(*) AS n, count(DISTINCT w.setpoint) AS distinct_setpoint,
  count(DISTINCT w.module_key) AS distinct_module_key, any_value(m.recipe) AS frequent_recipe, any_value(m.times) AS times_recipe
FROM weights w LEFT JOIN m ON m.line = w.line AND m.batch = w.batch GROUP BY w.line, w.batch""")
def _(p):
    columns = ["line", "batch", "time", "setpoint", "module_key", "recipe"]
    folder, state = shared_folder(p.spark, "digests"), shared_folder(p.spark, "digests-state")

    def made(rows):
        return digests.digest(rows, ["line", "batch"], weighing.HOUR, ["setpoint", "module_key"], ["recipe"])

    step = digests.store_digests(folder, made)
    _delivered(p, _by_time(p.weights.select(*columns)), lambda feed: jobs.each_batch(feed, step, state))
    whole = digests.combine(p.spark.read.parquet(folder), ["line", "batch"])
    return digests.answers(whole)


@query("stream_realtime_union", _rollup_sql(weighing.HOURLY_KEYS, _HOUR))
def _(p):
    w = p.weights
    folder = shared_folder(p.spark, "realtime")
    border = _ts("2024-01-20")
    rollups.stored_rollup(w.where(F.col("time") < border), folder)
    stored = p.spark.read.parquet(folder).drop("day")
    return rounded(rollups.realtime_union(stored, w, border, weighing.hourly))


@query("incremental_append", f"""
WITH {_STEPS},
e AS (SELECT uuid, time, machine, idx, lead(uuid) OVER (PARTITION BY serial, idx ORDER BY time, uuid) AS block_uuid
      FROM t WHERE state = 0),
x AS (SELECT uuid FROM t WHERE state = 0 AND time < TIMESTAMP '2024-01-16'),
f AS (SELECT t.*, e.block_uuid, e.uuid AS anchor, row_number() OVER (PARTITION BY e.uuid ORDER BY t.time, t.uuid) AS pos
      FROM e JOIN t ON t.machine = e.machine AND t.idx = e.idx AND t.time >= e.time AND t.uuid <> e.uuid
      WHERE e.block_uuid IS NULL OR e.block_uuid NOT IN (SELECT uuid FROM x)),
k AS (SELECT * FROM f WHERE pos <= 3 QUALIFY row_number() OVER (PARTITION BY anchor, state ORDER BY pos) = 1),
n AS (SELECT *, lead(time) OVER (PARTITION BY serial, idx ORDER BY time, uuid, block_uuid NULLS LAST) AS next_time FROM k),
{_LINES}{_LINE_COLUMNS}""")
def _(p):
    a = p.alarms
    stored = a.where((F.col("state") == 0) & (F.col("time") < _ts("2024-01-16"))).select(F.col("uuid").alias("block_uuid"))
    return _rounded(alarm_lines(a, stored))
