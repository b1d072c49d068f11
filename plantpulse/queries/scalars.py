"""Scalar expressions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse import sql
from plantpulse.functions import text, time, values
from plantpulse.queries.registry import query


@query("fn_epoch_ms", "SELECT event_id, epoch_us(ts) / 1000.0::DOUBLE AS ms FROM events")
def _(p):
    return p.table("events").select("event_id", time.epoch_ms("ts").alias("ms"))


@query("fn_from_epoch", "SELECT event_id, date_trunc('second', ts) AS at FROM events")
def _(p):
    ms = F.floor(time.epoch_ms("ts"))
    return p.table("events").select("event_id", time.from_epoch_ms(ms).alias("at"))


@query("fn_interval_seconds", """
SELECT o_orderkey, ((epoch_us(TIMESTAMP '2024-01-01 12:00:00.25') - epoch_us(o_orderdate)) / 1e6)::DOUBLE AS seconds FROM orders""")
def _(p):
    end = F.lit("2024-01-01 12:00:00.25").cast("timestamp_ntz")
    return p.table("orders").select("o_orderkey", time.seconds_between(F.col("o_orderdate"), end).alias("seconds"))


@query("fn_interval_arith", """
SELECT event_id, ts + INTERVAL 3 HOUR AS later, ts - to_days(cast(user_id % 7 AS INTEGER)) AS earlier FROM events""")
def _(p):
    days = F.make_dt_interval(days=(F.col("user_id") % 7).cast("int"))
    return p.table("events").select(
        "event_id", (F.col("ts") + F.expr("INTERVAL '3' HOUR")).alias("later"), (F.col("ts") - days).alias("earlier"))


@query("fn_trunc_cast", """
SELECT event_id, date_trunc('day', ts)::DATE AS day, strftime(ts, '%H:%M:%S') AS clock,
  date_trunc('hour', ts) AS hour FROM events""")
def _(p):
    return p.table("events").select(
        "event_id", F.to_date("ts").alias("day"), F.date_format("ts", "HH:mm:ss").alias("clock"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))


@query("fn_age_span", """
SELECT user_id, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE AS span_seconds,
  date_diff('day', min(ts)::DATE, max(ts)::DATE) AS span_days FROM events GROUP BY user_id""")
def _(p):
    return p.table("events").groupBy("user_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).select(
        "user_id", time.seconds_between("lo", "hi").alias("span_seconds"),
        F.datediff(F.to_date("hi"), F.to_date("lo")).cast("bigint").alias("span_days"))


@query("fn_round_decimal", """
SELECT event_id, round(value::DECIMAL(38, 10), 1)::DOUBLE AS one, round((value / 3)::DECIMAL(38, 10), 3)::DOUBLE AS three,
  round((-value)::DECIMAL(38, 10), 0)::DOUBLE AS whole FROM events""")
def _(p):
    v = F.col("value")
    return p.table("events").select(
        "event_id", values.fixed(v, 1).alias("one"), values.fixed(v / 3, 3).alias("three"),
        values.fixed(-v, 0).alias("whole"))


@query("fn_math", """
SELECT event_id, round(sqrt(value), 6) AS root, round(pow(value, 2), 6) AS square, round(value * pow(10, 3), 6) AS thousand
FROM events""")
def _(p):
    v = F.col("value")
    return p.table("events").select(
        "event_id", F.round(F.sqrt(v), 6).alias("root"), F.round(F.pow(v, F.lit(2)), 6).alias("square"),
        F.round(v * F.pow(F.lit(10), F.lit(3)), 6).alias("thousand"))


@query("fn_string_parts", """
SELECT uuid, skey, split_part(skey, '_', 2) AS module, split_part(skey, '_', 5) AS number, split_part(skey, '_', 9) AS missing
FROM alarms""")
def _(p):
    key = F.col("skey")
    return p.alarms.select("uuid", "skey", *[
        text.part(key, "_", n).alias(name) for n, name in ((2, "module"), (5, "number"), (9, "missing"))])


@query("fn_string_trim_slice", """
SELECT o_orderkey, rtrim(left(o_orderpriority, length(o_orderpriority) - 3)) AS head, length(o_orderpriority) AS n,
  lower(trim('  ' || o_orderpriority || ' ')) AS low FROM orders""")
def _(p):
    c = F.col("o_orderpriority")
    head = F.rtrim(F.left(c, F.length(c) - 3))
    low = F.lower(F.trim(F.concat(F.lit("  "), c, F.lit(" "))))
    return p.table("orders").select(
        "o_orderkey", head.alias("head"), F.length(c).cast("bigint").alias("n"), low.alias("low"))


@query("fn_string_regex", r"""
SELECT page_id, regexp_extract(url, 'https?://(.*?)/', 1) AS host, regexp_replace(url, '[^A-Za-z0-9_ ,]', '', 'g') AS plain
FROM pages""")
def _(p):
    return p.table("pages").select(
        "page_id", F.regexp_extract("url", "https?://(.*?)/", 1).alias("host"),
        F.regexp_replace("url", "[^A-Za-z0-9_ ,]", "").alias("plain"))


@query("fn_string_concat", """
SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS names, repeat('ab', max(n_regionkey) + 1) AS repeated,
  md5(string_agg(n_name, ', ' ORDER BY n_name)) AS digest, 'region ' || n_regionkey || ' has ' || count(*) AS label
FROM nation GROUP BY n_regionkey""")
def _(p):
    names = F.array_join(F.array_sort(F.collect_list("n_name")), ", ")
    region = F.col("n_regionkey")
    return p.table("nation").groupBy("n_regionkey").agg(names.alias("names"), F.count("*").alias("n")).select(
        "n_regionkey", "names", F.repeat(F.lit("ab"), region + 1).alias("repeated"), F.md5("names").alias("digest"),
        F.format_string("region %d has %d", region, "n").alias("label"))


@query("fn_json_field", """
SELECT event_id, props ->> '$.k' AS k, (props ->> '$.k') IS NOT NULL AS has_k, (props ->> '$.drop_after') IS NOT NULL AS has_drop
FROM events""")
def _(p):
    k, drop = (F.get_json_object("props", f"$.{name}") for name in ("k", "drop_after"))
    return p.table("events").select(
        "event_id", k.alias("k"), k.isNotNull().alias("has_k"), drop.isNotNull().alias("has_drop"))


@query("fn_array_access", """
WITH a AS (SELECT vec_id, label, embedding, [min(x), max(x)] AS ends FROM
  (SELECT vec_id, label, embedding, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY ALL)
SELECT vec_id, embedding[1]::DOUBLE AS first_value, len(embedding) AS n, ends[2] AS largest, pos, ends[pos] AS value
FROM a, (SELECT unnest([1, 2]) AS pos)""")
def _(p):
    e = F.col("embedding")
    ends = F.array(F.array_min(e).cast("double"), F.array_max(e).cast("double"))
    rows = p.table("embeddings").select("vec_id", e.getItem(0).cast("double").alias("first_value"),
                                        F.size(e).cast("bigint").alias("n"), ends.alias("ends"))
    largest = F.element_at("ends", 2).alias("largest")
    return rows.select("vec_id", "first_value", "n", largest, F.posexplode("ends").alias("pos", "value")).withColumn(
        "pos", F.col("pos") + 1)


@query("fn_null_logic", """
SELECT uuid, coalesce(mode_state, program_state) AS state, mode_state <> coalesce(program_state, mode_state) AS differs,
  program_state <> mode_state AS strict FROM general""")
def _(p):
    mode, state = F.col("mode_state"), F.col("program_state")
    return p.general.select("uuid", F.coalesce(mode, state).alias("state"),
                            (mode != F.coalesce(state, mode)).alias("differs"), (state != mode).alias("strict"))


@query("fn_cast", """
SELECT doc_id, lang, try_cast(split_part(source, 'src', 2) AS INTEGER) AS number, try_cast(lang AS INTEGER) AS none,
  cast(n_chars AS DOUBLE) AS chars, cast(n_chars % 2 AS BOOLEAN) AS odd FROM documents""")
def _(p):
    number = F.split_part(F.col("source"), F.lit("src"), F.lit(2)).try_cast("int")
    return p.table("documents").select(
        "doc_id", "lang", number.alias("number"), F.col("lang").try_cast("int").alias("none"),
        F.col("n_chars").cast("double").alias("chars"), (F.col("n_chars") % 2).cast("boolean").alias("odd"))


@query("fn_random_id", "SELECT event_id, 36 AS length, true AS well_formed FROM events")
def _(p):
    # Random by nature, so what can be checked of each id is given.
    ids = p.table("events").select("event_id", F.uuid().alias("uuid"))
    form = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return ids.select("event_id", F.length("uuid").alias("length"), F.col("uuid").rlike(form).alias("well_formed"))


_SIZE = """CASE WHEN {0} < 10 * 1024 THEN {0} || ' bytes'
  WHEN {0} < 10 * 1024 ** 2 THEN floor({0} / 1024 + 0.5)::BIGINT || ' kB'
  WHEN {0} < 10 * 1024 ** 3 THEN floor({0} / 1024 ** 2 + 0.5)::BIGINT || ' MB'
  ELSE floor({0} / 1024 ** 3 + 0.5)::BIGINT || ' GB' END"""


@query("fn_pretty_bytes", f"""
SELECT doc_id, {_SIZE.format("(n_chars * n_chars * 20)")} AS size, {_SIZE.format("n_chars")} AS chars FROM documents""")
def _(p):
    n = F.col("n_chars")
    return p.table("documents").select(
        "doc_id", values.pretty_bytes(n * n * 20).alias("size"), values.pretty_bytes(n).alias("chars"))


@query("fn_timezone", """
SELECT event_id, ts AS utc, ts + INTERVAL 1 HOUR AS brussels FROM events""")
def _(p):
    # The test data lies in winter, where the zone is one hour ahead of UTC.
    local = F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Europe/Brussels")
    return p.table("events").select("event_id", time.utc("ts").alias("utc"), local.cast("timestamp_ntz").alias("brussels"))


_GRAMS = "CASE unit_code WHEN 0 THEN 1000.0 WHEN 1 THEN 1.0 WHEN 2 THEN 1000000.0 WHEN 3 THEN 453.59237 END::DOUBLE"


@query("sql_scalar_functions", f"""
SELECT uuid, epoch_us(time) / 1000.0::DOUBLE AS ms, date_trunc('second', time) AS at, {_GRAMS} AS grams,
  CASE WHEN unit_code IN (1, 2) THEN 0 ELSE 1 END AS safe, CASE WHEN setpoint * 10 > 200 AND setpoint * 10 <= 300 THEN 9.0
    WHEN setpoint * 10 > 100 AND setpoint * 10 <= 200 THEN setpoint * 10 * 0.045 END::DOUBLE AS tolerance
FROM weights""")
def _(p):
    sql.register(p.spark)
    p.weights.createOrReplaceTempView("weights_for_sql")
    return p.spark.sql("""
        SELECT uuid, utc2epoch(time) AS ms, epoch2utc(utc2epoch(time)) AS at, grams_per_unit(unit_code) AS grams,
          check_string(concat(module_key, CASE unit_code WHEN 1 THEN ' -- ' WHEN 2 THEN '@' ELSE '' END)) AS safe, tolerance_grams(setpoint * 10) AS tolerance
        FROM weights_for_sql""")


@query("sql_table_functions", """
SELECT serial, recipe, min(time) AS batch_start, max(time) AS batch_end, (max(total_cases) - min(total_cases) + 1)::DOUBLE AS boxes
FROM general WHERE batch = '1' AND line IS NOT NULL AND serial IS NOT NULL AND recipe IS NOT NULL GROUP BY line, machine, serial, recipe""")
def _(p):
    sql.register_tables(p.general)
    return p.spark.sql("SELECT * FROM production_of('1')")


@query("sql_recipe_periods", """
WITH r AS (SELECT recipe, time, uuid, row_number() OVER (ORDER BY time, uuid) - row_number() OVER (PARTITION BY recipe ORDER BY time, uuid) AS run
           FROM general WHERE serial = '7')
SELECT recipe, min(time) AS time_from, max(time) AS time_to FROM r GROUP BY recipe, run HAVING count(*) > 1""")
def _(p):
    sql.register_tables(p.general)
    return p.spark.sql("SELECT * FROM recipe_periods_of('7')")
