"""Merged summaries of stretches against plain loops, and how often the file is read."""

import random

import pytest
from pyspark.sql import functions as F

from plantpulse.operators.aggregates import transition_count
from plantpulse.operators.ordered import TimeOrder
from plantpulse.operators.stretches import state_totals, stay_totals
from plantpulse.queries import all_queries
from plantpulse.sources.standins import Plant

from .fixtures import at

SCHEMA = "uuid long, time timestamp_ntz, serial string, batch string, state double"
END = 900_000


def make_rows(seed, n=220):
    rng = random.Random(seed)
    return [
        (i, at(rng.choice([rng.randrange(30), rng.randrange(300_000)])), rng.choice(["a", "a", "b", None]), rng.choice(["1", "1", "2"]),
         rng.choice([None, 300.0, 300.0, 600.0])) for i in range(n)]


def groups(rows, *places):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        out.setdefault(tuple(r[p] for p in places), []).append(r)
    return out


@pytest.fixture(scope="module", params=[1, 2, 3])
def rows(request):
    return make_rows(request.param)


@pytest.mark.parametrize("width", [600, 3_600, 86_400, 10_000_000])
@pytest.mark.parametrize("within", [None, ["batch"]])
def test_state_totals(spark, rows, width, within):
    df = spark.createDataFrame(rows, SCHEMA)
    as_of = F.lit(at(END).isoformat()).cast("timestamp_ntz")
    got = {
        (r.serial, r.batch, r.state): (r.entries, round(r.seconds, 6))
        for r in state_totals(df, ["serial", "batch"], "state", as_of, within, TimeOrder(keys=[], slice_seconds=width)).collect()}
    want = {}
    for (serial, batch), line in groups(rows, 2, 3).items():
        for i, r in enumerate(line):
            entries, seconds = want.get((serial, batch, r[4]), (0, 0.0))
            want[serial, batch, r[4]] = (entries + (i == 0 or line[i - 1][4] != r[4]), seconds)
    for line in groups(rows, *([3] if within else [2, 3])).values():
        for i, r in enumerate(line):
            until = line[i + 1][1] if i + 1 < len(line) else at(END)
            entries, seconds = want[r[2], r[3], r[4]]
            want[r[2], r[3], r[4]] = (entries, round(seconds + (until - r[1]).total_seconds(), 6))
    assert got == want


@pytest.mark.parametrize("width", [600, 3_600, 86_400, 10_000_000])
def test_stays(spark, rows, width):
    df = spark.createDataFrame(rows, SCHEMA).where("state IS NOT NULL")
    got = {
        r.serial: (r.stays, round(r.stay_seconds, 6))
        for r in stay_totals(df, ["serial"], F.col("state") == 600, TimeOrder(keys=[], slice_seconds=width)).collect()}
    want = {}
    for (serial,), line in groups([r for r in rows if r[4] is not None], 2).items():
        entered = None
        for before, r in zip(line, line[1:]):
            if r[4] == 600 and before[4] != 600:
                entered = r[1]
            if r[4] != 600 and before[4] == 600 and entered is not None:
                n, seconds = want.get(serial, (0, 0.0))
                want[serial], entered = (n + 1, round(seconds + (r[1] - entered).total_seconds(), 6)), None
    assert got == want


def test_long_stays_across_many_stretches(spark):
    states = [600] * 5 + [300] + [600] * 30 + [300] * 2 + [600] * 4
    df = spark.createDataFrame([(i, at(i * 5_000), "a", "1", float(s)) for i, s in enumerate(states)], SCHEMA)
    got = stay_totals(df, ["serial"], F.col("state") == 600).collect()
    assert [tuple(r) for r in got] == [("a", 1, 150_000.0)]
    never = df.where("uuid < 5")
    assert stay_totals(never, ["serial"], F.col("state") == 600).count() == 0
    assert state_totals(df.limit(0), ["serial"], "state").count() == 0


def test_transitions_without_any_entry_are_zero(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.serial: r.n for r in transition_count(df, TimeOrder(keys=["serial"]), "state", 300, "n").collect()}
    want = {
        serial: sum(r[4] == 300 and (i == 0 or line[i - 1][4] != 300) for i, r in enumerate(line)) for (serial,), line in groups(rows, 2).items()}
    assert got == want
    assert {r.n for r in transition_count(df, TimeOrder(keys=["serial"]), "state", 7, "n").collect()} == {0}


def reads(spark, key):
    """File scans in the plan, reused exchanges not counted again."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plant = Plant(spark, "/root/testdata/sf0.001")
        return all_queries()[key].build(plant)._jdf.queryExecution().executedPlan().toString().count("FileScan")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


@pytest.mark.parametrize("key, most", [
    ("win_locf_count", 1), ("win_lead_state", 1), ("alarm_edges", 1), ("agg_transition_count", 1), ("agg_state_count_duration", 1),
    ("alarm_count_time", 1), ("state_durations", 2), ("state_durations_machine", 2), ("join_asof_first_last", 4), ("batch_moments", 4),
])
def test_how_often_files_are_read(spark, key, most):
    assert reads(spark, key) <= most
