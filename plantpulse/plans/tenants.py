"""Jobs over all tenants, each from its own high-water mark.

A job takes one dictionary, as a scheduler hands it over. It reads from every tenant the rows since its mark, in one plan for all,
and writes the result and the new marks in one commit: a run that was broken off has done nothing, and a
run that is repeated changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.plans.production import BATCH_KEYS, batch_sums, merge_sums, production_of_sums
from plantpulse.schemas import from_raw
from plantpulse.session import discard, stored
from plantpulse.sources import commits
from plantpulse.sources.tables import tenants

_CONFIG = {"target", "tenants", "overlap_hours"}
_COLUMNS = ["uuid", "time", *BATCH_KEYS, "batch", "total_cases"]
_TENANT = ["tenant"]
_KEY = [*_TENANT, *BATCH_KEYS, "batch"]


def _checked(config: Mapping[str, Any]) -> tuple[str, dict[str, Any], float]:
    unknown = set(config) - _CONFIG
    missing = {"target", "tenants"} - set(config)
    if unknown or missing or not config["tenants"]:
        raise ValueError(f"config: unknown {sorted(unknown)}, missing {sorted(missing)}, tenants {sorted(config.get('tenants', []))}")
    return config["target"], dict(config["tenants"]), float(config.get("overlap_hours", 24))


def update_production(spark: SparkSession, config: Mapping[str, Any]) -> list[str]:
    """Bring the production of all tenants up to date; returns the parts of the table that were written.

    ``target`` is the folder of the table, ``tenants`` a mapping of names to the folders of their machine states (or to
    DataFrames), ``overlap_hours`` (24) how far before its mark a tenant is read again, for late rows; rows later than that
    are not seen. Rows without a time are left out. A tenant that is new starts with all its rows, and one that is not named keeps what it has.
    The mark is the newest time read. Sums of the rows read are merged with the stored ones, so rows that are read twice count once.
    """
    target, sources, overlap = _checked(config)
    before = commits.newest(spark, target)
    read = {}
    for name, source in sources.items():
        rows = from_raw(source if isinstance(source, DataFrame) else spark.read.parquet(source)).select(*_COLUMNS)
        rows = rows.where(F.col("time").isNotNull())
        if name in before.marks:
            since = F.lit(before.marks[name]).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(overlap * 3600))
            rows = rows.where(F.col("time") >= since)
        read[name] = rows
    sums, made = stored(batch_sums(tenants(read), extra_keys=_TENANT), "tenant-sums")
    # One row per tenant.
    newest = sums.groupBy("tenant").agg(F.max("batch_end").cast("string").alias("mark")).collect()
    marks = {r["tenant"]: max(r["mark"], before.marks.get(r["tenant"], "")) for r in newest}
    known = commits.read(spark, target, sums.schema, before).drop("part")
    met = known.join(commits.as_old(sums, _KEY), commits.equal(_KEY), "left_semi")
    merged = merge_sums(sums.unionByName(met), extra_keys=_TENANT)
    day = F.concat_ws("_", "tenant", F.to_date("batch_start"))
    written = commits.upsert(merged, target, _KEY, day, marks=marks)
    discard(spark, made)
    return written


def production(spark: SparkSession, target: str) -> DataFrame:
    """The production of all tenants, as the newest commit has it. Raises ``ValueError`` where no run has stored any."""
    runs = sorted(set(commits.newest(spark, target).parts.values()))
    if not runs:
        raise ValueError(f"no production stored in {target}")
    # All writes have the same columns.
    schema = spark.read.parquet(f"{target}/data/run={runs[0]}").drop("part").schema
    return production_of_sums(commits.read(spark, target, schema), _TENANT)
