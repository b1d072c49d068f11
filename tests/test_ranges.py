"""Range aggregates from buckets against all rows inside."""

import random

import pytest
from pyspark.sql import functions as F

from plantpulse.operators.ranges import range_totals

from .fixtures import at


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_the_rows_inside(spark, seed):
    rng = random.Random(seed)
    spots = [0, 3_600, 7_200, 86_400, 2 * 86_400, 3 * 86_400 + 3_600]
    pick = lambda: rng.choice([rng.choice(spots), rng.randrange(5 * 86_400), rng.randrange(9_000)])
    rows = [(at(pick()), rng.choice(["a", "b", None]), rng.choice([None, 1.0, 2.5, 4.0])) for _ in range(400)]
    ranges = [(rng.choice(["a", "b", "c", None]), n, *sorted((at(pick()), at(pick())))) for n in range(60)]
    ranges += [("a", 100, at(50), at(20)), ("a", 101, at(3_600), at(3_600)), ("a", 101, at(3_600), at(3_600))]
    df = spark.createDataFrame(rows, "time timestamp_ntz, serial string, v double")
    asked = spark.createDataFrame(ranges, "serial string, name long, time_from timestamp_ntz, time_to timestamp_ntz")
    add = F.sum
    partials = {"rows": (F.count(F.lit(1)), add), "n": (F.count("v"), add), "s": (F.sum("v"), add), "lo": (F.min("v"), F.min), "hi": (F.max("v"), F.max)}
    got = {(r.serial, r.name): (r.rows, r.n, r.s, r.lo, r.hi) for r in range_totals(df, asked, ["serial"], "time_from", "time_to", partials).collect()}
    want = {}
    for serial, name, low, high in ranges:
        inside = [v for t, s, v in rows if s is not None and s == serial and low <= t <= high]
        known = [v for v in inside if v is not None]
        if inside:
            want[serial, name] = (len(inside), len(known), sum(known) if known else None, min(known, default=None), max(known, default=None))
    assert got == want and len(want) > 20


def test_rows_meet_ranges_only_in_broken_hours(spark):
    rows = spark.range(0, 10 * 24 * 60).selectExpr("timestamp_ntz'2024-03-01' + make_dt_interval(0, 0, cast(id as int), 0) AS time", "'a' AS serial", "1.0 AS v")
    asked = spark.createDataFrame([("a", at(90), at(9 * 86_400 + 90))], "serial string, time_from timestamp_ntz, time_to timestamp_ntz")
    totals = range_totals(rows, asked, ["serial"], "time_from", "time_to", {"n": (F.count("v"), F.sum)})
    assert totals.first()["n"] == 9 * 24 * 60
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 3
