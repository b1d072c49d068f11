"""Usage, translation and storage reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.operators.joins import translate
from plantpulse.plans import profiles, usage
from plantpulse.plans.alarms import transitions
from plantpulse.plans.weighing import hourly
from plantpulse.queries.alarms import _STEPS
from plantpulse.queries.filters import _unsafe_sql
from plantpulse.queries.registry import query
from plantpulse.queries.scalars import _SIZE
from plantpulse.queries.weights import rounded
from plantpulse.session import shared_folder


@query("usage_hourly", """
SELECT date_trunc('hour', logtime) AS hour, organization, count(*) AS refreshes FROM access_log
WHERE category = 'Dashboard' GROUP BY ALL""")
def _(p):
    return usage.usage_hourly(p.access_log)


@query("usage_hourly_dashboard", """
SELECT date_trunc('hour', logtime) AS hour, organization, dashboard, count(*) AS refreshes FROM access_log
WHERE category = 'Dashboard' GROUP BY ALL""")
def _(p):
    return usage.usage_hourly(p.access_log, by_dashboard=True)


@query("usage_capture", f"""
SELECT conv_id, turn, role, {_unsafe_sql('text')} = 1 AS accepted FROM conversations""")
def _(p):
    events = p.table("conversations").select("conv_id", "turn", "role", "text")
    folder = shared_folder(p.spark, "usage-log")
    rejected = usage.capture(events, "text", folder)
    stored = p.spark.read.schema(events.schema).parquet(folder)
    columns = ["conv_id", "turn", "role"]
    return stored.select(*columns, F.lit(True).alias("accepted")).unionByName(
        rejected.select(*columns, F.lit(False).alias("accepted")))


@query("translate_alarms", f"""
WITH {_STEPS},
k AS (SELECT uuid, serial, state, skey, '_' || split_part(skey, '_', 2) || '_1_' || split_part(skey, '_', 4) || '_'
        || split_part(skey, '_', 5) AS general_key FROM t)
SELECT k.uuid, k.serial, k.state, k.skey, x.translation FROM k LEFT JOIN translations x ON x.unique_key = 'pl_PL_6' || k.general_key""")
def _(p):
    return translate(transitions(p.alarms), p.translations, "pl_PL", 6).select(
        "uuid", "serial", "state", "skey", "translation")


_TIMED = (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
_CHUNKS = " UNION ALL ".join(f"""
SELECT '{table}' AS name, date_trunc('day', {time})::TIMESTAMP AS chunk_start, date_trunc('day', {time})::TIMESTAMP + INTERVAL 1 DAY AS chunk_end,
  count(*) AS rows, min({time}) AS first_time, max({time}) AS last_time
FROM {table} GROUP BY ALL""" for table, time in _TIMED)
_SUMMARY = f"""
d AS ({_CHUNKS}),
c AS (SELECT name, count(*) AS chunks, sum(rows)::BIGINT AS rows, min(chunk_start) AS range_start,
  max(chunk_end) AS range_end, 86400.0::DOUBLE AS chunk_seconds,
  (epoch_us(max(chunk_end)) - epoch_us(min(chunk_start))) / 1e6::DOUBLE AS span_seconds FROM d GROUP BY name)"""


def _details(p):
    parts = [profiles.chunk_details(p.table(name), name, time) for name, time in _TIMED]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("chunk_details", _CHUNKS)
def _(p):
    return _details(p)


@query("chunk_profile", f"WITH {_SUMMARY} SELECT * FROM c")
def _(p):
    return profiles.chunk_summary(_details(p))


_GROWTH = """
WITH a AS (SELECT event_type AS relation, date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS n FROM events GROUP BY ALL),
s AS (SELECT relation, day + INTERVAL 1 DAY AS time, (sum(n) OVER (PARTITION BY relation ORDER BY day))::BIGINT AS rows, n AS growth FROM a)"""


@query("size_snapshot_trend", f"{_GROWTH} SELECT * FROM s")
def _(p):
    return profiles.row_growth(p.table("events"), "event_type", "ts")


@query("size_snapshot_latest", f"""{_GROWTH},
l AS (SELECT * FROM s WHERE time = (SELECT max(time) FROM s))
SELECT relation, time, rows, round(rows / sum(rows) OVER (), 6) AS share FROM l""")
def _(p):
    return rounded(profiles.latest_rows(profiles.row_growth(p.table("events"), "event_type", "ts")))


_FILES = ("events", "orders", "lineitem", "documents")


@query("size_file_snapshot", " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) AS rows, true AS has_files, true AS has_bytes FROM {name}" for name in _FILES))
def _(p):
    # Files and bytes depend on how a table was written; that they are found can be checked.
    parts = [profiles.file_sizes(p.table(name), name) for name in _FILES]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select("name", "rows", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


_RETENTION = [("events", '{"drop_after": "365 days", "table_id": 31}'), ("lineitem", '{"drop_after": "10 years"}'),
              ("part", '{"compress_after": "7 days"}')]


@query("dataset_overview", f"""
WITH {_SUMMARY},
h AS (SELECT logger, machine, serial, recipe, batch, module_index, result_code, struct_version, date_trunc('hour', time) AS b
      FROM weights WHERE net IS NOT NULL GROUP BY ALL),
t AS (SELECT 'Table' AS type, name, rows FROM c
  UNION ALL SELECT 'Table', 'part', count(*) FROM part
  UNION ALL SELECT 'Summary', 'weight_hourly', count(*) FROM h),
r AS (SELECT * FROM (VALUES {', '.join(f"('{n}', '{c}')" for n, c in _RETENTION)}) AS v(name, config))
SELECT t.type, t.name, t.rows, coalesce(c.chunks, 0) AS chunks, c.range_start, c.range_end,
  coalesce(c.span_seconds, 0.0) AS span_seconds, r.config ->> '$.drop_after' AS retention
FROM t LEFT JOIN c ON c.name = t.name LEFT JOIN r ON r.name = t.name""")
def _(p):
    base = profiles.relation_rows({name: p.table(name) for name in ("events", "orders", "lineitem", "part")})
    summaries = profiles.relation_rows({"weight_hourly": hourly(p.weights)})
    retention = p.spark.createDataFrame(_RETENTION, "name string, config string")
    return profiles.dataset_overview(base, summaries, profiles.chunk_summary(_details(p)), retention)
