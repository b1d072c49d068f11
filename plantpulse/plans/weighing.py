"""Weighing: rollups, batch summaries, e-mark metrology and accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plantpulse.functions.time import bucket, seconds_between
from plantpulse.functions.values import fixed, grams_per_unit, ratio, tolerance_grams
from plantpulse.operators.aggregates import histogram, most_frequent
from plantpulse.operators.ordered import TimeOrder
from plantpulse.session import staged

HOURLY_KEYS = ["logger", "machine", "serial", "recipe", "batch", "module_index", "result_code", "struct_version"]
DAILY_KEYS = ["machine", "serial", "recipe", "batch", "logger", "unit_id", "result_code"]
HOUR, DAY, QUARTER = 3600, 86_400, 900


def rollup_measures() -> dict[str, Column]:
    """Measures of the weight rollups.

    ``filling_first_time`` is the time of the lightest box and ``filling_last_time`` of the
    heaviest, as the original views compute them; ``first_time`` and ``last_time`` are the
    earliest and latest box.
    """
    by_weight = F.struct("net", "time", "uuid")
    return {
        "results": F.count("result_code"),
        "setpoint": F.max("setpoint"),
        "max_over": F.max("max_over"),
        "max_under": F.max("max_under"),
        "boxes": F.count("net"),
        "total_weight": F.sum("net"),
        "min_weight": F.min("net"),
        "max_weight": F.max("net"),
        "avg_weight": F.avg("net"),
        "stddev_weight": F.stddev_samp("net"),
        "filling_first_time": F.min(by_weight)["time"],
        "filling_last_time": F.max(F.struct("net", "time", "uuid"))["time"],
        "first_time": F.min("time"),
        "last_time": F.max("time"),
        "avg_tare": F.avg("tare"),
        "module_key": F.max("module_key"),
    }


def rollup(
    weights: DataFrame, keys: Sequence[str], seconds: int, extra: dict[str, Column] | None = None
) -> DataFrame:
    """Aggregate boxes into time buckets; rows without a net weight are left out."""
    measures = {**rollup_measures(), **(extra or {})}
    boxes = weights.where(F.col("net").isNotNull())
    return boxes.groupBy(*keys, bucket("time", seconds).alias("bucket")).agg(
        *[e.alias(name) for name, e in measures.items()])


def hourly(weights: DataFrame) -> DataFrame:
    return rollup(weights, HOURLY_KEYS, HOUR)


def daily(weights: DataFrame) -> DataFrame:
    return rollup(weights, DAILY_KEYS, DAY)


def hourly_with_ids(weights: DataFrame) -> DataFrame:
    """Hourly rollup by custom fields too, with the id of the first row."""
    first = {"uuid": F.min(F.struct("time", "uuid"))["uuid"]}
    return rollup(weights, [*HOURLY_KEYS, "custom_1", "custom_2"], HOUR, first)


def quarter_hourly(weights: DataFrame, unit_id: str) -> DataFrame:
    """15-minute rollup of one weighing unit."""
    last = F.max(F.struct("time", "uuid", "setpoint"))["setpoint"]
    unit = weights.where(F.col("unit_id") == unit_id)
    return unit.groupBy("recipe", "batch", "unit_id", bucket("time", QUARTER).alias("bucket")).agg(
        F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.count("net").alias("boxes"),
        F.avg("net").alias("avg_net"), F.sum("net").alias("total_net"), F.avg("tare").alias("avg_tare"),
        last.alias("last_setpoint"))


def batch_summary(rollups: DataFrame, pattern: str = "%", limit: int | None = None) -> DataFrame:
    """Per batch: recipe, times, target, tonnes, speed in tonnes per hour, boxes, average weight.

    Newest first, by the id as text; with ``limit`` the newest ones only.
    """
    chosen = rollups.where(F.lower("recipe").like(pattern.lower()))
    sums = chosen.groupBy("batch").agg(
        F.min("filling_first_time").alias("batch_start"), F.max("filling_last_time").alias("batch_end"),
        F.sum("total_weight").alias("_kg"), F.sum("boxes").alias("boxes"))
    seconds = seconds_between("batch_start", "batch_end")
    newest = (
        sums.join(most_frequent(chosen, ["batch"], "recipe", "recipe"), "batch", "left")
        .join(most_frequent(chosen, ["batch"], "setpoint", "target_weight"), "batch", "left")
        .select(
            F.col("batch").try_cast("int").alias("id"), "recipe", "batch_start", "batch_end",
            seconds.alias("duration_seconds"), "target_weight", (F.col("_kg") / 1000).alias("tonnes"),
            ratio(F.col("_kg") * 3.6, seconds).alias("tonnes_per_hour"), "boxes",
            fixed(ratio(F.col("_kg"), F.col("boxes")), 2).alias("avg_weight"), "batch")
        .orderBy(F.col("batch").desc_nulls_first())
    )
    return (newest if limit is None else newest.limit(limit)).drop("batch")


def batch_throughput(rollups: DataFrame) -> DataFrame:
    """Per recipe and batch: duration, boxes, tonnes, and both per time."""
    sums = rollups.groupBy("recipe", "batch").agg(
        F.min("first_time").alias("batch_start"), F.max("last_time").alias("batch_end"),
        F.sum("results").alias("boxes"), F.sum("total_weight").alias("_kg"))
    hours = seconds_between("batch_start", "batch_end") / 3600
    tonnes = F.col("_kg") / 1000
    return sums.select(
        "recipe", "batch", "batch_start", "batch_end", hours.alias("hours"), "boxes",
        fixed(tonnes, 3).alias("tonnes"), fixed(ratio(tonnes, hours), 2).alias("tonnes_per_hour"),
        fixed(ratio(F.col("boxes"), hours), 0).alias("boxes_per_hour"),
        fixed(ratio(F.col("boxes"), hours * 60), 0).alias("boxes_per_minute"))


def batch_start(rollups: DataFrame) -> DataFrame:
    """First filling time of each batch."""
    return rollups.groupBy("batch").agg(F.min("filling_first_time").alias("batch_start"))


def nth_row(df: DataFrame, keys: Sequence[str], n: int, columns: Sequence[str]) -> DataFrame:
    """The n-th row by time of each key; keys with fewer rows are left out.

    Each slice of a key keeps its first n rows, and the n-th is picked among these.
    """
    order = TimeOrder(keys=list(keys))
    wanted = list(dict.fromkeys([*keys, "time", "uuid", *columns]))
    heads = order.dealt(df.select(*wanted)).withColumn("_n", F.row_number().over(order.within()))
    heads = heads.where(F.col("_n") <= n).drop("_n")
    overall = F.row_number().over(W.partitionBy(*keys).orderBy(*order.sort()))
    # Spark stops a rank filter after n rows per key, before the shuffle.
    return heads.withColumn("_n", overall).where(F.col("_n") == n).select(*wanted)


def batch_constants(weights: DataFrame) -> DataFrame:
    """Target weight, tolerance and borders in grams of each batch, and what describes it.

    The unit factor is that of the batch's fourth row, so shorter batches have none. The target
    is the most frequent setpoint; the giveaway is measured against the smallest one.
    """
    base = weights.groupBy("batch").agg(
        F.count("net").alias("boxes"), F.avg("net").alias("_avg"), F.stddev_samp("net").alias("_sd"),
        F.min("setpoint").alias("_set"), F.min("unit_code").alias("unit_code"),
        F.min("time").alias("time"), F.max("time").alias("end_time"), F.min("machine").alias("machine"),
        F.min("serial").alias("serial"), F.min("line").alias("line"), F.min("recipe").alias("recipe"))
    factor = nth_row(weights, ["batch"], 4, ["unit_code"]).select(
        "batch", grams_per_unit(F.col("unit_code")).alias("unit_factor"))
    target = most_frequent(weights, ["batch"], "setpoint", "_mode")
    named = base.join(factor, "batch", "left").join(target, "batch", "left").withColumn(
        "target_weight", F.col("_mode") * F.col("unit_factor"))
    tu1 = named.withColumn("tu1", tolerance_grams(F.col("target_weight")))
    nominal, step = F.col("target_weight"), F.col("tu1")
    return tu1.select(
        "batch", "time", "end_time", "line", "machine", "serial", "recipe", "target_weight", "boxes",
        (F.col("_avg") * F.col("unit_factor")).alias("avg_weight"),
        (F.col("_sd") * F.col("unit_factor")).alias("stddev_grams"),
        (ratio(F.col("_avg") - F.col("_set"), F.col("_set")) * 100).alias("giveaway_percent"),
        "unit_code", "unit_factor", "tu1", (step * 2).alias("tu2"), *_borders(nominal, step))


def _borders(nominal: Column, step: Column) -> list[Column]:
    return [
        (nominal - step * 2).alias("min_tu2"), (nominal - step).alias("min_tu1"), nominal.alias("qn"),
        (nominal + step).alias("max_to1"), (nominal + step * 2).alias("max_to2")]


# Counts between the borders, in ascending order of weight.
BAND_COUNTS = ["below_tu2", "below_tu1", "below_qn", "below_to1", "below_to2", "above_to2"]


def band_counts(weights: DataFrame, constants: DataFrame, grams: Column) -> DataFrame:
    """Boxes of each batch per tolerance band."""
    borders = [F.col(c) for c in ("min_tu2", "min_tu1", "qn", "max_to1", "max_to2")]
    bands = [grams < borders[0]]
    bands += [(grams >= low) & (grams < high) for low, high in zip(borders, borders[1:])]
    bands.append(grams >= borders[-1])
    columns = ["batch", "unit_factor", "min_tu2", "min_tu1", "qn", "max_to1", "max_to2"]
    placed = weights.select("batch", "net").join(constants.select(*columns), "batch")
    return placed.groupBy("batch").agg(*[F.count_if(b).alias(n) for n, b in zip(BAND_COUNTS, bands)])


def metrology(weights: DataFrame) -> DataFrame:
    """E-mark report of every batch: target, borders, counts per band and their percentages."""
    constants = staged(batch_constants(weights), "batch-constants")
    counts = band_counts(weights, constants, F.col("net") * F.col("unit_factor"))
    shares = {f"{c}_percent": ratio(F.col(c), F.col("boxes")) * 100 for c in BAND_COUNTS}
    return constants.join(counts, "batch").withColumns(shares)


def metrology_borders(weights: DataFrame) -> DataFrame:
    """The earlier form: nominal weight from the smallest setpoint and unit, weights in kilograms.

    Boxes and the tolerance take a factor of 1000 whatever the unit; only the nominal weight
    follows the unit code, where pounds are unknown.
    """
    base = weights.groupBy("batch").agg(
        F.count("net").alias("boxes"), (F.avg("net") * 1000).alias("avg_weight"),
        F.min("setpoint").alias("_set"), F.min("unit_code").alias("_unit"))
    known = F.when(F.col("_unit") != 3, grams_per_unit(F.col("_unit")))
    nominal, step = F.col("nominal"), F.col("tu1")
    constants = base.withColumns({
        "nominal": F.col("_set") * known, "tu1": tolerance_grams(F.col("_set") * 1000),
        "unit_factor": F.lit(1000.0)})
    constants = constants.select(
        "batch", "boxes", "avg_weight", "unit_factor", "tu1", (step * 2).alias("tu2"), *_borders(nominal, step),
        (ratio(F.col("avg_weight") - nominal, nominal) * 100).alias("giveaway_percent"))
    counts = band_counts(weights, constants, F.col("net") * 1000)
    return constants.drop("unit_factor").join(counts, "batch")


def weight_histogram(weights: DataFrame, buckets: int = 6, bar_length: int = 30) -> DataFrame:
    """Histogram of each batch's boxes, three tolerances around the target, with a text bar."""
    columns = ["batch", "unit_factor", "target_weight", "tu1"]
    constants = staged(batch_constants(weights).select(*columns), "batch-constants")
    low = F.col("target_weight") - F.col("tu1") * 3
    high = F.col("target_weight") + F.col("tu1") * 3
    placed = weights.select("batch", "net").join(constants, "batch").withColumns({"_low": low, "_high": high})
    bins = histogram(placed, ["batch", "_low", "tu1"], F.col("net") * F.col("unit_factor"),
                     F.col("_low"), F.col("_high"), buckets)
    bins = staged(bins, "bins")
    top = bins.groupBy("batch").agg(F.max("frequency").alias("_top"))
    bar = F.round(F.col("frequency") / F.col("_top") * bar_length).cast("int")
    return bins.join(top, "batch").select(
        "batch", "bucket", "bucket_min", "bucket_max", "frequency",
        (F.col("_low") + F.col("bucket") * F.col("tu1")).alias("bucket_floor"),
        (F.col("_low") + (F.col("bucket") + 1) * F.col("tu1")).alias("bucket_ceiling"),
        F.repeat(F.lit("■"), bar).alias("bar"))


def latest_limits(weights: DataFrame) -> tuple[Column, Column]:
    """Lower and upper limit of the most recent row, as one-value subqueries."""
    row = weights.agg(F.max(F.struct("time", "uuid", "setpoint", "max_under", "max_over")).alias("r"))
    low = row.select(F.col("r.setpoint") - F.col("r.max_under")).scalar()
    high = row.select(F.col("r.setpoint") + F.col("r.max_over")).scalar()
    return low, high


def accuracy_ratio(weights: DataFrame, rows: Column) -> DataFrame:
    """Share of boxes strictly inside the latest limits, among the chosen rows."""
    low, high = latest_limits(weights)
    inside = (F.col("net") > low) & (F.col("net") < high)
    chosen = weights.where(rows & F.col("net").isNotNull())
    good, total = F.count_if(inside), F.count("net")
    return chosen.agg(total.alias("total"), good.alias("inside"), ratio(good, total).alias("share"))


def setpoint_conflicts(weights: DataFrame) -> DataFrame:
    """Batches with more than one setpoint."""
    counts = weights.groupBy("batch").agg(
        F.count_distinct("setpoint").alias("setpoints"), F.min("setpoint").alias("smallest"),
        F.max("setpoint").alias("largest"), F.count("*").alias("rows"))
    return counts.where(F.col("setpoints") > 1)


def batch_profile(weights: DataFrame) -> DataFrame:
    """Count, mean, setpoints, units, nominal and actual total of each batch."""
    sums = weights.groupBy("batch").agg(
        F.count("net").alias("boxes"), F.avg("net").alias("avg_net"), F.min("setpoint").alias("min_setpoint"),
        F.max("setpoint").alias("max_setpoint"), F.min("unit_code").alias("min_unit"),
        F.max("unit_code").alias("max_unit"), F.sum("net").alias("total"))
    mode = most_frequent(weights, ["batch"], "setpoint", "mode_setpoint")
    return sums.join(mode, "batch", "left").withColumn("nominal_total", F.col("min_setpoint") * F.col("boxes"))


def period_throughput(weights: DataFrame, start: Column, end: Column) -> DataFrame:
    """Tonnes and tonnes per hour in a closed period.

    ``period_hours`` is seconds / 3.6 as in the original report, which is hours times 1000;
    ``period_hours_true`` is the length in hours.
    """
    seconds = seconds_between(start, end)
    kilograms = F.sum("net")
    return weights.where(F.col("time").between(start, end)).agg(
        (kilograms / 1000).alias("tonnes"), F.first(seconds / 3.6).alias("period_hours"),
        F.first(seconds / 3600).alias("period_hours_true"),
        (kilograms / F.first(seconds / 3.6)).alias("tonnes_per_hour"))
