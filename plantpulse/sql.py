"""SQL functions of the session: what analysts call by name in SQL text.

Scalar functions are SQL expressions that Spark puts into the calling query, so they cost no more than being written there. Table
functions select from named results; their argument becomes a filter on these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.functions.text import UNSAFE_ENDING, UNSAFE_SUBSTRINGS
from plantpulse.functions.values import TOLERANCE_BANDS, UNIT_GRAMS
from plantpulse.plans.machines import recipe_periods
from plantpulse.plans.production import box_production


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _tolerance() -> str:
    whens = []
    for low, high, grams, share in TOLERANCE_BANDS:
        upto = "" if high is None else f" AND nominal <= {high}"
        whens.append(f"WHEN nominal > {low}{upto} THEN {f'{grams}D' if grams is not None else f'nominal * {share}D'}")
    return f"CASE {' '.join(whens)} END"


def _screen() -> str:
    parts = [f"contains(words, {_text(s)})" for s in UNSAFE_SUBSTRINGS] + [f"endswith(words, {_text(UNSAFE_ENDING)})"]
    return f"CASE WHEN coalesce({' OR '.join(parts)}, false) THEN 0 ELSE 1 END"


#: Signature and expression of each scalar function.
SCALARS = {
    "utc2epoch(at TIMESTAMP_NTZ) RETURNS DOUBLE": "unix_micros(CAST(at AS TIMESTAMP)) / 1000D",
    "epoch2utc(ms DOUBLE) RETURNS TIMESTAMP_NTZ": "CAST(timestamp_seconds(floor(ms / 1000D)) AS TIMESTAMP_NTZ)",
    "check_string(words STRING) RETURNS INT": _screen(),
    "general_key(alarm STRING) RETURNS STRING":
        "concat('_', split_part(alarm, '_', 2), '_1_', split_part(alarm, '_', 4), '_', split_part(alarm, '_', 5))",
    "grams_per_unit(code INT) RETURNS DOUBLE":
        f"CASE code {' '.join(f'WHEN {k} THEN {v}D' for k, v in UNIT_GRAMS.items())} END",
    "tolerance_grams(nominal DOUBLE) RETURNS DOUBLE": _tolerance(),
}
#: Signature and statement of each table function, over the views of :func:`register_tables`.
TABLES = {
    "recipe_periods_of(machine_serial STRING) RETURNS TABLE (recipe STRING, time_from TIMESTAMP_NTZ, time_to TIMESTAMP_NTZ)":
        "SELECT p.recipe, p.time_from, p.time_to FROM recipe_period_rows p WHERE p.serial = machine_serial",
    "production_of(wanted_batch STRING) RETURNS TABLE (serial STRING, recipe STRING, batch_start TIMESTAMP_NTZ, batch_end TIMESTAMP_NTZ, boxes DOUBLE)":
        "SELECT b.serial, b.recipe, b.batch_start, b.batch_end, b.boxes FROM box_production_rows b WHERE b.batch = wanted_batch",
}


def register(spark: SparkSession) -> None:
    """Make the scalar functions known to the session."""
    for signature, expression in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {expression}")


def register_tables(general: DataFrame) -> None:
    """Make the table functions known to the session, over one table of machine states."""
    spark = general.sparkSession
    recipe_periods(general).createOrReplaceTempView("recipe_period_rows")
    box_production(general).withColumn("boxes", F.col("boxes").cast("double")).createOrReplaceTempView("box_production_rows")
    for signature, statement in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {statement}")
