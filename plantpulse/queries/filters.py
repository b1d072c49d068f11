"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantpulse.functions.text import UNSAFE_SUBSTRINGS, is_safe
from plantpulse.functions.values import grams_per_unit, tolerance_grams
from plantpulse.plans.weighing import latest_limits
from plantpulse.queries.registry import query


@query("filter_not_null", """
SELECT uuid, line, serial, recipe, mode_state, program_state FROM general
WHERE line IS NOT NULL AND serial IS NOT NULL AND (mode_state IS NOT NULL OR program_state IS NOT NULL)""")
def _(p):
    keys = F.col("line").isNotNull() & F.col("serial").isNotNull()
    sampled = F.col("mode_state").isNotNull() | F.col("program_state").isNotNull()
    return p.general.where(keys & sampled).select("uuid", "line", "serial", "recipe", "mode_state", "program_state")


@query("filter_pattern", """
SELECT p_partkey, p_name, p_type, p_brand FROM part
WHERE lower(p_name) LIKE lower('%RING%') OR p_type ILIKE 'eco%' OR NOT regexp_matches(p_brand, '^Brand#[1-4]')""")
def _(p):
    like = F.lower("p_name").like("%ring%") | F.col("p_type").ilike("eco%") | ~F.col("p_brand").rlike("^Brand#[1-4]")
    return p.table("part").where(like).select("p_partkey", "p_name", "p_type", "p_brand")


@query("filter_in_list", "SELECT uuid, unit_id, recipe, net FROM weights WHERE unit_id IN ('W1') AND recipe IN ('J1', 'J3')")
def _(p):
    w = p.weights.where(F.col("unit_id").isin("W1") & F.col("recipe").isin("J1", "J3"))
    return w.select("uuid", "unit_id", "recipe", "net")


@query("filter_in_subquery", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT max(o_orderkey) FROM orders GROUP BY o_custkey)""")
def _(p):
    last = p.table("orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("l_orderkey"))
    lines = p.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return lines.join(last, "l_orderkey", "left_semi")


@query("filter_not_in", """
SELECT c_custkey, c_name, c_nationkey FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_custkey IS NOT NULL)""")
def _(p):
    busy = p.table("orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return p.table("customer").select("c_custkey", "c_name", "c_nationkey").join(busy, "c_custkey", "left_anti")


@query("filter_scalar_max", """
SELECT uuid, day_batch, 'text' AS kind FROM general WHERE day_batch = (SELECT max(day_batch) FROM general)
UNION ALL SELECT uuid, day_batch, 'number' FROM general
WHERE cast(day_batch AS INTEGER) = (SELECT max(cast(day_batch AS INTEGER)) FROM general)""")
def _(p):
    # As text '9' sorts above '30'; the numeric form is the one usually wanted.
    g = p.general.select("uuid", "day_batch")
    number = F.col("day_batch").try_cast("int")
    as_text = g.where(F.col("day_batch") == g.agg(F.max("day_batch")).scalar())
    as_number = g.where(number == g.agg(F.max(number)).scalar())
    return as_text.withColumn("kind", F.lit("text")).unionByName(as_number.withColumn("kind", F.lit("number")))


@query("filter_latest_param", """
WITH l AS (SELECT setpoint - max_under AS lo, setpoint + max_over AS hi FROM weights ORDER BY time DESC, uuid DESC LIMIT 1)
SELECT uuid, net FROM weights WHERE net > (SELECT lo FROM l) AND net < (SELECT hi FROM l)""")
def _(p):
    low, high = latest_limits(p.weights)
    return p.weights.where((F.col("net") > low) & (F.col("net") < high)).select("uuid", "net")


@query("filter_exists", """
SELECT count(*) AS n, min(time) AS first_time FROM weights
WHERE EXISTS (SELECT 1 FROM weights WHERE batch = '2' AND result_code = 20) HAVING count(*) > 0""")
def _(p):
    w = p.weights
    found = w.where((F.col("batch") == "2") & (F.col("result_code") == 20)).agg(F.count("*") > 0).scalar()
    return w.where(found).agg(F.count("*").alias("n"), F.min("time").alias("first_time")).where("n > 0")


@query("case_bands", """
SELECT uuid, net * 100 AS nominal, round(CASE
  WHEN net * 100 > 15000 THEN net * 100 * 0.01 WHEN net * 100 > 10000 THEN 150
  WHEN net * 100 > 1000 THEN net * 100 * 0.015 WHEN net * 100 > 500 THEN 15 WHEN net * 100 > 300 THEN net * 100 * 0.03
  WHEN net * 100 > 200 THEN 9 WHEN net * 100 > 100 THEN net * 100 * 0.045 WHEN net * 100 > 50 THEN 4.5
  WHEN net * 100 > 5 THEN net * 100 * 0.09 END::DOUBLE, 4) AS tolerance FROM weights""")
def _(p):
    nominal = F.col("net") * 100
    return p.weights.select("uuid", nominal.alias("nominal"), F.round(tolerance_grams(nominal), 4).alias("tolerance"))


@query("case_unit_factor", """
SELECT uuid, unit_code, CASE unit_code WHEN 0 THEN 1000 WHEN 1 THEN 1 WHEN 2 THEN 1000000 WHEN 3 THEN 453.59237 END::DOUBLE
  AS factor FROM weights""")
def _(p):
    return p.weights.select("uuid", "unit_code", grams_per_unit(F.col("unit_code")).alias("factor"))


@query("distinct_rows", """
SELECT DISTINCT cast(day_batch AS INTEGER) AS batch FROM general ORDER BY batch DESC LIMIT 10""")
def _(p):
    batches = p.general.select(F.col("day_batch").try_cast("int").alias("batch")).distinct()
    return batches.orderBy(F.col("batch").desc_nulls_first()).limit(10)


@query("literal_columns", """
SELECT uuid, 'fixed_target' AS recipe, 15.0::DOUBLE AS nominal, machine AS metric, net AS produced FROM weights""")
def _(p):
    return p.weights.select(
        "uuid", F.lit("fixed_target").alias("recipe"), F.lit(15.0).alias("nominal"),
        F.col("machine").alias("metric"), F.col("net").alias("produced"))


def _unsafe_sql(column):
    hits = " OR ".join(f"contains({column}, '{s.replace(chr(39), chr(39) * 2)}')" for s in UNSAFE_SUBSTRINGS)
    return f"CASE WHEN {hits} OR ends_with({column}, '@') THEN 0 ELSE 1 END"


@query("screen_unsafe_text", f"""
SELECT 'document' AS kind, doc_id AS id, 0::BIGINT AS turn, {_unsafe_sql('text')} AS safe FROM documents
UNION ALL SELECT 'conversation', conv_id, turn, {_unsafe_sql('text')} FROM conversations
UNION ALL SELECT 'page', page_id, 0, {_unsafe_sql('html')} FROM pages""")
def _(p):
    def screened(table, kind, ident, text, turn=None):
        number = F.col(turn) if turn else F.lit(0).cast("bigint")
        return p.table(table).select(
            F.lit(kind).alias("kind"), F.col(ident).alias("id"), number.alias("turn"), is_safe(F.col(text)).alias("safe"))

    return (
        screened("documents", "document", "doc_id", "text")
        .unionByName(screened("conversations", "conversation", "conv_id", "text", "turn"))
        .unionByName(screened("pages", "page", "page_id", "html")))


@query("coalesce_null_label", """
SELECT coalesce(organization, 'NULL') AS organization, count(*) AS n FROM access_log GROUP BY organization""")
def _(p):
    label = F.coalesce("organization", F.lit("NULL")).alias("organization")
    return p.access_log.groupBy(label).agg(F.count("*").alias("n"))
