"""Tables in parts, with a commit list.

A table is a folder with rows below ``data``, one folder per write and part, and a list in ``commits`` that names for each
part the write that holds its rows. A write goes to a folder of its own and is seen only when its list is published, so a
run that was broken off leaves the table as it was, and is simply done again. Parts that a merge doesn't change keep their files.
One job at a time writes into a table; of two that do, the second one fails and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from plantpulse.session import discard, stored
from plantpulse.sources.sinks import write_by

_RESERVED = ("part", "run")


@dataclass(frozen=True)
class Commit:
    """What a table consists of: the write of each part, and the marks of the jobs that fill it."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, files = _at(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []


def newest(spark: SparkSession, folder: str) -> Commit:
    """The newest commit; of a table that nobody wrote yet an empty one."""
    lists = [n for n in _names(spark, f"{folder}/commits") if n.endswith(".json") and not n.startswith((".", "_"))]
    if not lists:
        return Commit()
    text = spark.read.text(f"{folder}/commits/{max(lists)}", wholetext=True).first()[0]
    return Commit(**json.loads(text))


def publish(spark: SparkSession, folder: str, commit: Commit) -> None:
    """Make a commit the newest one. The list is complete under another name before it gets its own."""
    target, files = _at(spark, f"{folder}/commits/{commit.number:010d}.json")
    draft, _ = _at(spark, f"{folder}/commits/_{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(json.dumps({"number": commit.number, "parts": commit.parts, "marks": commit.marks}).encode())
    out.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise RuntimeError(f"commit {commit.number} of {folder} is taken: another job wrote meanwhile")


def read(
    spark: SparkSession, folder: str, schema: StructType, commit: Commit | None = None, parts: Sequence[str] | None = None
) -> DataFrame:
    """The rows of a commit (the newest one, if none is given) with their ``part``; of some parts only, if they are named."""
    held = (commit or newest(spark, folder)).parts
    wanted = held if parts is None else {p: held[p] for p in parts if p in held}
    by_run: dict[str, list[str]] = {}
    for part, run in wanted.items():
        by_run.setdefault(run, []).append(part)
    whole = _with(schema, *_RESERVED)
    if not by_run:
        return spark.createDataFrame([], whole).drop("run")
    folders = [f"{folder}/data/run={run}" for run in by_run]
    rows = spark.read.schema(whole).option("basePath", f"{folder}/data").parquet(*folders)
    # Both are folder names, so other parts of these writes are not read.
    named = [(F.col("run") == run) & F.col("part").isin(names) for run, names in by_run.items()]
    return rows.where(reduce(Column.__or__, named)).drop("run")


def _with(schema: StructType, *texts: str) -> StructType:
    return StructType([*schema.fields, *[StructField(name, StringType()) for name in texts]])


def _old(c: str) -> str:
    return f"_old_{c}"


def equal(columns: Sequence[str]) -> Column:
    """Equality with the columns of the same names after ``_old_``; NULLs are equal."""
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(_old(c))) for c in columns])


def as_old(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """These columns, with ``_old_`` before their names."""
    return df.select(*[F.col(c).alias(_old(c)) for c in columns])


def _values(df: DataFrame, column: str) -> set[str]:
    # One value for each folder, whatever the number of rows.
    return {r[0] for r in df.select(column).distinct().collect() if r[0] is not None}


def upsert(
    new: DataFrame, folder: str, key: Sequence[str], part: Column, version: Sequence[str] | None = None,
    updated: Sequence[str] | None = None, marks: Mapping[str, str] | None = None,
) -> list[str]:
    """Merge rows into a table, one row per key; returns the parts that were written.

    An unknown key is inserted. A known one is changed where a column of ``version`` differs (all others than the key, if not given),
    and then takes over the columns ``updated`` (likewise). ``part`` tells from the columns of a row where it belongs; NULL and
    empty text make the part ``none``. A changed row may move to another part. Only keys and versions are read of the
    whole table; whole rows are read, and files written, in parts with a changed key alone. The marks are noted in the same commit,
    and without a changed row or mark there is none. NULLs of a key are equal. ``new`` has to hold each key once.
    """
    if clash := [c for c in _RESERVED if c in new.columns]:
        raise ValueError(f"reserved column names: {clash}")
    spark, columns, schema = new.sparkSession, new.columns, new.schema
    others = [c for c in columns if c not in key]
    version, updated = list(version or others), list(updated or others)
    before = newest(spark, folder)
    told = {**before.marks, **(marks or {})}

    known = read(spark, folder, schema, before)
    known = as_old(known, [*key, *[c for c in version if c not in key], "part"])
    same = F.col(_old("part")).isNotNull() & equal(version) if version else F.col(_old("part")).isNotNull()
    met = new.join(known, equal(key), "left").where(~same)
    fresh, met_folder = stored(met.select(*columns, F.col(_old("part")).alias("_home")), "upsert-met")
    homes = _values(fresh, "_home")

    before_rows = read(spark, folder, schema, before, sorted(homes))
    pairs = fresh.join(as_old(before_rows, columns), equal(key), "left")
    taken = [c if c in updated else F.when(F.col("_home").isNull(), F.col(c)).otherwise(F.col(_old(c))).alias(c) for c in columns]
    merged = pairs.select(*taken).withColumn("part", F.coalesce(F.nullif(part.cast("string"), F.lit("")), F.lit("none")))
    changed, changed_folder = stored(merged, "upsert-changed")
    dirty = sorted(homes | _values(changed, "part"))

    if dirty:
        run = uuid.uuid4().hex
        untouched = read(spark, folder, schema, before, dirty).join(as_old(changed, key), equal(key), "left_anti")
        write_by(untouched.unionByName(changed), f"{folder}/data/run={run}", "part")
        written = spark.read.schema(_with(schema, "part")).parquet(f"{folder}/data/run={run}")
        parts = {p: r for p, r in before.parts.items() if p not in dirty} | {p: run for p in _values(written, "part")}
    else:
        parts = before.parts
    if dirty or told != before.marks:
        publish(spark, folder, Commit(before.number + 1, parts, told))
    discard(spark, met_folder, changed_folder)
    return dirty


def vacuum(spark: SparkSession, folder: str) -> list[str]:
    """Delete the writes and lists that the newest commit doesn't need, those of broken runs too; the writes deleted.

    To be run while no job writes and nobody reads an older commit.
    """
    commit = newest(spark, folder)
    needed = {f"run={run}" for run in commit.parts.values()}
    unused = [n for n in _names(spark, f"{folder}/data") if n.startswith("run=") and n not in needed]
    lists = [n for n in _names(spark, f"{folder}/commits") if n != f"{commit.number:010d}.json" and not n.startswith(".")]
    discard(spark, *[f"{folder}/data/{n}" for n in unused], *[f"{folder}/commits/{n}" for n in lists])
    return sorted(unused)
