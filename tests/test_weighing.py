"""Weights, tolerances and pooled deviations."""

import math

import pytest
from pyspark.sql import functions as F

from plantpulse.functions.values import grams_per_unit, pretty_bytes, tolerance_grams
from plantpulse.operators.aggregates import most_frequent, pooled_stddev
from plantpulse.plans import metrics, weighing as plan

from .fixtures import at, values

WEIGHT = "uuid long, time timestamp_ntz, line string, machine string, serial string, recipe string, batch string, " \
         "net double, setpoint double, unit_code int"


def boxes(spark, nets, setpoint=1.0, batch="b", unit=0, first=0):
    rows = [(first + i, at(first + i), "L", "m", "m", "r", batch, n, setpoint, unit) for i, n in enumerate(nets)]
    return spark.createDataFrame(rows, WEIGHT)


def test_tolerance_bands(spark):
    # Tolerance in grams at each nominal weight.
    bands = [(5, None), (50, 4.5), (100, 4.5), (200, 9), (300, 9), (500, 15), (1000, 15), (10000, 150), (15000, 150), (20000, 200)]
    df = spark.createDataFrame([(float(t),) for t, _ in bands], "t double")
    got = [r[0] for r in df.select(tolerance_grams(F.col("t"))).collect()]
    assert [None if g is None else round(g, 9) for g in got] == [e for _, e in bands]


def test_unit_codes(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (9,)], "u int")
    assert [r[0] for r in df.select(grams_per_unit(F.col("u"))).collect()] == [1000.0, 1.0, 1e6, 453.59237, None]


def test_short_batch_has_no_factor(spark):
    df = boxes(spark, [1.0, 1.01, 0.99])
    (row,) = plan.metrology(df).collect()
    assert row["boxes"] == 3 and row["unit_factor"] is None and row["target_weight"] is None and row["below_qn"] == 0


def test_band_counts_sum_to_the_batch(spark):
    nets = [0.95, 0.96, 0.971, 0.984, 0.986, 0.999, 1.0, 1.014, 1.016, 1.04, 1.2]
    (row,) = plan.metrology(boxes(spark, nets)).collect()
    assert [row[c] for c in plan.BAND_COUNTS] == [2, 2, 2, 2, 1, 2]
    assert sum(row[c] for c in plan.BAND_COUNTS) == row["boxes"] == len(nets)
    assert math.isclose(sum(row[f"{c}_percent"] for c in plan.BAND_COUNTS), 100)
    assert row["target_weight"] == 1000 and row["tu1"] == 15


def test_histogram_counts_sum_to_the_batch(spark):
    df = boxes(spark, [0.9 + i / 500 for i in range(100)]).unionByName(boxes(spark, [2.0] * 7, batch="c", first=500))
    got = plan.weight_histogram(df).groupBy("batch").agg(F.sum("frequency").alias("n"), F.max(F.length("bar")).alias("bar"))
    assert sorted(map(tuple, got.collect())) == [("b", 100, 30), ("c", 7, 30)]


def test_nth_row_across_slices(spark):
    rows = [(i, at(i * 50_000), "L", "m", "m", "r", "b", float(i), 1.0, i) for i in range(8)]
    df = spark.createDataFrame(rows, WEIGHT)
    assert values(plan.nth_row(df, ["batch"], 4, ["unit_code"]), "unit_code") == [(3,)]


# Seven groups as (count, deviation, batch, mean); FOUR and TWO both make up ALL.
GROUPS = [(9.0, 50, "A", 63.0), (6.0, 40, "A", 54.0)]


@pytest.mark.parametrize("flip", [False, True])
def test_pooled_deviation_of_two_groups(spark, flip):
    rows = [(g[2], g[0], g[3], g[1]) for g in (reversed(GROUPS) if flip else GROUPS)]
    df = spark.createDataFrame(rows, "k string, s double, m double, n long")
    ((sd, mean, n),) = values(pooled_stddev(df, ["k"], "s", "m", "n"), "stddev", "mean", "n")
    assert (round(sd, 9), round(mean, 9), n) == (9.0, 59.0, 90)


def test_pooling_is_associative(spark):
    parts = [(0.3, 25.1, 10), (0.2, 25.7, 15), (0.25, 25.4, 12), (0.1, 25.5, 13)]
    df = spark.createDataFrame([(i // 2, *p) for i, p in enumerate(parts)], "k int, s double, m double, n long")
    twice = pooled_stddev(df, ["k"], "s", "m", "n").withColumn("all", F.lit(1))
    ((a, am),) = values(pooled_stddev(twice, ["all"], "stddev", "mean", "n"), "stddev", "mean")
    ((b, bm),) = values(pooled_stddev(df.withColumn("all", F.lit(1)), ["all"], "s", "m", "n"), "stddev", "mean")
    assert math.isclose(a, b, abs_tol=1e-12) and math.isclose(am, bm, abs_tol=1e-12)


def test_missing_deviation_makes_the_result_null(spark):
    df = spark.createDataFrame([("k", None, 1.0, 2), ("k", 1.0, 1.0, 2)], "k string, s double, m double, n long")
    assert values(pooled_stddev(df, ["k"], "s", "m", "n"), "stddev") == [(None,)]


def test_exact_pooling_equals_the_deviation_of_all_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), ("b", 9.0), ("b", 4.0)], "g string, x double")
    stats = df.groupBy("g").agg(F.stddev_samp("x").alias("s"), F.avg("x").alias("m"), F.count("x").alias("n")).withColumn("k", F.lit(1))
    ((sd,),) = values(pooled_stddev(stats, ["k"], "s", "m", "n", exact=True), "stddev")
    assert math.isclose(sd, df.agg(F.stddev_samp("x")).first()[0])


def test_most_frequent(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b"), ("k", "a"), ("k", None), ("k", None), ("k", None)], "k string, v string")
    assert values(most_frequent(df, ["k"], "v", "v"), "v") == [("a",)]


def test_metric_texts(spark):
    spec = metrics.parse("weights | net | AVG | net > 1")
    assert (spec.label, spec.condition) == ("avg_net", "net > 1")
    with pytest.raises(ValueError):
        metrics.parse("weights|net|drop")
    wide = metrics.metric_columns(boxes(spark, [1.0, 3.0]), [spec, metrics.parse("w|net|avg|net > 9")], ["batch"], columns=7)
    assert values(wide, "d1", "d2", "d3", "d7") == [(3.0, None, 0.0, 0.0)]


def test_more_metrics_than_usual(spark):
    specs = [metrics.parse(f"w|net|max|net < {i}") for i in range(9)]
    wide = metrics.metric_columns(boxes(spark, [1.0, 3.0]), specs, ["batch"])
    assert values(wide, "d1", "d3", "d9") == [(None, 1.0, 3.0)] and len(wide.columns) == 10


def test_pretty_bytes(spark):
    df = spark.createDataFrame([(10239,), (10240,), (3768 * 1024,), (25 * 1024 * 1024,), (5_000_000_000_000,)], "n long")
    assert [r[0] for r in df.select(pretty_bytes(F.col("n"))).collect()] == [
        "10239 bytes", "10 kB", "3768 kB", "25 MB", "4657 GB"]
