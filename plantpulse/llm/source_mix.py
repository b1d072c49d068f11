"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, its source's target over its
source's size. The documents of a source are put in order, the expected copies are summed up along
it from one random offset, and a document is taken once for each whole number its stretch crosses. So
a source gives its target up to the size of a document, and no document more than the largest
expectation rounded up. In order of size the taken words stay closest to the target.

The order is made by a range partitioning over (source, size, id): a large source spreads over many
partitions, each counts its own rows, and a window over these counts gives where each begins.

Cases: a NULL text has size 0; a NULL source is a source of its own, last in order; sources of size
0 have target 0 and are not taken; equal ids, repeated rows and extra columns are kept apart by
their order; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.llm.common import partitions, text_key, written


def words() -> Column:
    """Number of runs without ASCII white space."""
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``; one row per source.

    The level is raised until all targets together are ``share`` times all sizes. A source takes its
    weight times the level, at most ``most`` times its size. Sources run full in order of limit
    over weight; the level is right at the first source that it leaves below its limit.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", "place")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    filled = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(turn, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
        .withColumn("limit", most * F.col("source_size").cast("double"))
        .withColumn("fill", F.col("limit") / F.col("weight"))
        .withColumn("full", F.coalesce(F.sum("limit").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("all", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("level", (share * F.col("all").cast("double") - F.col("full")) / F.col("open"))
    )
    fits = F.when(F.col("level") <= F.col("fill"), F.struct("fill", "place", "level"))
    level = F.min(fits).over(Window.partitionBy())["level"]
    return filled.withColumn("right", level).select(
        "source", "source_size", F.least("limit", F.col("weight") * F.col("right")).alias("target"))


def offset(seed: str) -> Column:
    """The random offset of a source, from 0 to below 1."""
    drawn = F.md5(F.concat(F.lit(seed), F.coalesce("source", F.lit(""))).cast("binary"))
    return F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") / 4294967296.0


def copies(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix"
) -> DataFrame:
    """``doc_id, text_key, source, size, source_size, target, copies`` of every row."""
    spark = docs.sparkSession
    sized = docs.select("doc_id", text_key().alias("text_key"), "source", words().alias("size"))
    order = ["source", "size", "doc_id", "text_key"]
    # Written, as a range partitioning may fall out otherwise when it is made again.
    dealt = sized.repartitionByRange(partitions(spark), *order).withColumn("part", F.spark_partition_id())
    placed, _ = written(dealt, "mix")
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    per_source = targets(sizes, weights, share, most)
    # One row for each part and each source that it holds.
    held = placed.groupBy("part", "source").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = held.select("part", F.col("source").alias("_source"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    begins = begins.join(per_source, begins["_source"].eqNullSafe(per_source["source"])).drop("source")
    inside = Window.partitionBy("part", "source").orderBy("size", "doc_id", "text_key")
    ranked = placed.withColumn("at", F.row_number().over(inside)).withColumnRenamed("part", "_part")
    same = (ranked["_part"] == begins["part"]) & ranked["source"].eqNullSafe(begins["_source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(0.0)
    end = (F.col("begin") + F.col("at")).cast("double")
    taken = F.floor(F.col("offset") + F.col("rate") * end) - F.floor(F.col("offset") + F.col("rate") * (end - 1.0))
    return (
        ranked.join(begins, same).withColumn("rate", rate).withColumn("offset", offset(f"{seed}:"))
        .select("doc_id", "text_key", "source", "size", "source_size", "target", taken.alias("copies"))
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken."""
    key = ["doc_id", "text_key", "source"]
    plan = copies(docs, **settings).select(*[F.col(c).alias(f"_p_{c}") for c in key], "size", "copies")
    # Rows that agree in all of the key are told apart by their number.
    number = Window.partitionBy(*[f"_p_{c}" for c in key]).orderBy("copies")
    plan = plan.select(*[f"_p_{c}" for c in key], F.col("copies").alias("_p_copies"), F.row_number().over(number).alias("_p_no"))
    keyed = docs.withColumn("_k_text_key", text_key())
    own = [keyed["doc_id"], keyed["_k_text_key"], keyed["source"]]
    rows = keyed.withColumn("_k_no", F.row_number().over(Window.partitionBy("doc_id", "_k_text_key", "source").orderBy(F.lit(0))))
    same = F.col("_k_no") == F.col("_p_no")
    for c, mine in zip(key, ["doc_id", "_k_text_key", "source"]):
        same = same & F.col(mine).eqNullSafe(F.col(f"_p_{c}"))
    out = rows.join(plan.where("_p_copies > 0"), same)
    return out.withColumn("_each", F.explode(F.expr("sequence(1L, _p_copies)"))).select(*docs.columns)
