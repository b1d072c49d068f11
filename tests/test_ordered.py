"""The sliced operators against plain loops, with slices small enough to be crossed often."""

import random

import pytest
from pyspark.sql import functions as F

from plantpulse.operators.ordered import SLICE, TimeOrder, carry, islands, with_neighbours, with_next, with_next_rows, with_previous

from .fixtures import at

SCHEMA = "uuid long, time timestamp_ntz, key string, value double"


def make_rows(seed, n=240):
    """One key holds half of the rows, one is NULL, and many rows share their time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice(["hot", "hot", "hot", "b", None, "c"])
        rows.append((i, at(rng.choice([rng.randrange(40), rng.randrange(400_000)])), key, rng.choice([None, 1.0, 2.0])))
    return rows


def ordered(rows):
    keys = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        keys.setdefault(r[2], []).append(r)
    return keys


ORDERS = [
    TimeOrder(keys=["key"]),
    TimeOrder(keys=["key"], slice_seconds=600, rows_per_slice=None),
    TimeOrder(keys=["key"], slice_seconds=86_400, rows_per_slice=3),
]


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return make_rows(request.param)


@pytest.mark.parametrize("order", ORDERS)
def test_neighbours(spark, rows, order):
    df = spark.createDataFrame(rows, SCHEMA)
    got = with_neighbours(df, order, {"p": "value", "pu": "uuid"}, {"nu": "uuid"}, seen="seen", more="more")
    expected = {}
    for group in ordered(rows).values():
        for i, r in enumerate(group):
            before = group[i - 1] if i else None
            after = group[i + 1] if i + 1 < len(group) else None
            expected[r[0]] = (before and before[3], before and before[0], after and after[0], before is not None, after is not None)
    assert {r["uuid"]: (r["p"], r["pu"], r["nu"], r["seen"], r["more"]) for r in got.collect()} == expected


@pytest.mark.parametrize("order", ORDERS)
def test_next_rows(spark, rows, order):
    df = spark.createDataFrame(rows, SCHEMA)
    got = with_next_rows(df, order, 3, "after", ["uuid"])
    expected = {r[0]: [x[0] for x in g[i + 1:i + 4]] for g in ordered(rows).values() for i, r in enumerate(g)}
    assert {r["uuid"]: [x["uuid"] for x in r["after"]] for r in got.collect()} == expected


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("backward", [False, True])
def test_carry(spark, rows, order, backward):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["uuid"]: r["c"] for r in carry(df, order, backward=backward, c="value").collect()}
    expected = {}
    for group in ordered(rows).values():
        last = None
        for r in reversed(group) if backward else group:
            last = r[3] if r[3] is not None else last
            expected[r[0]] = last
    assert got == expected


@pytest.mark.parametrize("order", ORDERS)
def test_islands_split_the_rows(spark, rows, order):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["uuid"]: r["island"]["uuid"] for r in islands(df, order, ["value"]).collect()}
    expected = {}
    for group in ordered(rows).values():
        start = None
        for i, r in enumerate(group):
            if i == 0 or group[i - 1][3] != r[3]:
                start = r[0]
            expected[r[0]] = start
    assert got == expected


def test_order_without_keys(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["uuid"]: r["n"] for r in with_next(df, TimeOrder(keys=[], slice_seconds=600), n="uuid").collect()}
    line = sorted(rows, key=lambda r: (r[1], r[0]))
    assert got == {r[0]: (line[i + 1][0] if i + 1 < len(line) else None) for i, r in enumerate(line)}


def test_slices_carry_over_to_another_key(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    sliced = TimeOrder(keys=["key"], rows_per_slice=3).sliced(df)
    assert SLICE in with_previous(sliced, TimeOrder(keys=["key"]), p="uuid").columns
    got = {r["uuid"]: r["p"] for r in with_previous(sliced, TimeOrder(keys=[]), p="uuid").collect()}
    line = sorted(rows, key=lambda r: (r[1], r[0]))
    assert got == {r[0]: (line[i - 1][0] if i else None) for i, r in enumerate(line)}


def test_dense_days_and_minutes_are_cut(spark):
    even = [(i, at(i * 60), "hot", 1.0) for i in range(1000)]
    burst = [(2000 + i, at(200_000 + i / 100), "hot", 1.0) for i in range(1000)]
    sparse = [(4000 + i, at(400_000 + i * 3600), "b", 1.0) for i in range(10)]
    df = spark.createDataFrame(even + burst + sparse, SCHEMA)
    order = TimeOrder(keys=["key"], rows_per_slice=100)
    sizes = order.sliced(df).groupBy("key", SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= 150
    assert sizes.where("key = 'b'").count() == 2
    got = {r["uuid"]: r["p"] for r in with_previous(df, order, p="uuid").where("key = 'hot'").collect()}
    line = [r[0] for r in even + burst]
    assert got == {u: (line[i - 1] if i else None) for i, u in enumerate(line)}


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert with_previous(df, ORDERS[0], p="value").count() == 0
    assert carry(df, ORDERS[0], c="value").count() == 0
    assert with_next_rows(df, ORDERS[0], 3, "after", ["uuid"]).count() == 0


def test_no_window_over_a_whole_key(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    plan = with_previous(df, ORDERS[0], p="value")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    windows = [x for x in plan.split("\n") if "Window [lag" in x and "_w0" in x]
    assert windows and all(SLICE in x for x in windows)


def test_staged_rows_lie_in_the_shared_folder(spark, rows):
    from plantpulse.session import staged

    kept = staged(spark.createDataFrame(rows, SCHEMA), "kept")
    assert kept.count() == len(rows)
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in kept.inputFiles())


def test_rows_of_the_same_instant_count_as_next(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for order in ORDERS:
        got = with_next_rows(df, order, 3, "after", ["uuid"], same_instant=True)
        expected = {}
        for group in ordered(rows).values():
            for r in group:
                expected[r[0]] = [x[0] for x in group if x[1] >= r[1] and x[0] != r[0]][:3]
        assert {r["uuid"]: [x["uuid"] for x in r["after"]] for r in got.collect()} == expected


def test_no_job_runs_while_the_plan_is_built(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    spark.sparkContext.setJobGroup("plan", "building")
    for order in ORDERS:
        carry(df, order, c="value")
        with_neighbours(df, order, {"p": "value"}, {"n": "uuid"})
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs
