"""Machine state on hand-built sequences."""

from datetime import timedelta

from pyspark.sql import functions as F

from plantpulse.operators.aggregates import transition_count
from plantpulse.operators.gapfill import gapfill, gapfill_carried
from plantpulse.operators.joins import asof, interval_join
from plantpulse.operators.ordered import TimeOrder, carry
from plantpulse.plans import machines as plan
from plantpulse.plans.production import box_production, merge_box_production

from .fixtures import START, at, general, values


def test_entries_into_a_state(spark):
    df = general(spark, [(i, "m", s) for i, s in enumerate([300, 300, None, 300, 100, 300])])
    assert values(transition_count(df, TimeOrder(keys=["serial"]), "program_state", 300, "n"), "n") == [(3,)]


def test_open_stay_is_not_counted(spark):
    df = general(spark, [(i * 10, "m", s) for i, s in enumerate([100, 600, 600, 100, 600])])
    assert values(plan.stay_totals(df, ["serial"]), "stays", "stay_seconds") == [(1, 20.0)]


def test_null_states_hide_a_transition_until_carried(spark):
    df = general(spark, [(i, "m", s) for i, s in enumerate([300, None, 500, 300, 100])])
    df = df.withColumn("mode_state", F.lit(1.0))
    assert len(values(plan.state_timeline(df), "uuid")) == 1
    filled = carry(df, plan.BY_MACHINE, program_state="program_state")
    assert sorted(values(plan.state_timeline(filled), "uuid", "duration_seconds")) == [(2, 1.0), (3, 1.0)]


def test_carry_forward_leaves_leading_nulls(spark):
    df = general(spark, [(0, "m", 300), (1, "m", None), (2, "m", None), (3, "m", 500), (4, "n", None), (5, "m", None)])
    got = dict(values(plan.carry_forward(df, "program_state", "carried"), "uuid", "carried"))
    assert got == {0: 300.0, 1: 300.0, 2: 300.0, 3: 500.0, 4: None, 5: 500.0}


def test_carry_forward_in_two_halves_equals_one_run(spark):
    rows = [(i, "ab"[i % 2], s) for i, s in enumerate([300, 500, None, None, 100, None, None, 300, None, None])]
    df = general(spark, rows)
    once = dict(values(plan.carry_forward(df, "program_state", "carried"), "uuid", "carried"))
    half = plan.carry_forward(df.where("uuid < 5"), "program_state", "carried")
    whole = half.unionByName(df.where("uuid >= 5"))
    assert dict(values(plan.carry_forward(whole, "program_state", "carried"), "uuid", "carried")) == once


def test_runs(spark):
    df = general(spark, [(i, "m", 1) for i in range(6)]).withColumn(
        "recipe", F.element_at(F.array(*[F.lit(x) for x in "aabbba"]), F.col("uuid").cast("int") + 1))
    got = sorted(values(plan.runs(df, plan.BY_MACHINE, "recipe"), "recipe", "time_from", "time_to", "single_row"))
    assert got == [("a", at(0), at(1), False), ("a", at(5), at(5), True), ("b", at(2), at(4), False)]
    assert plan.recipe_periods(df).count() == 2


def test_runs_cover_all_rows(spark):
    df = general(spark, [(i * 7000, "ab"[i % 3 == 0], s % 3) for i, s in enumerate([1, 4, 2, 2, 2, 5, 0, 3, 3, 1] * 5)])
    runs = plan.runs(df.withColumn("recipe", F.col("program_state").cast("string")), plan.BY_MACHINE, "recipe")
    inside = interval_join(df.select("serial", "time", "uuid"), runs, ["serial"], "time_from", "time_to")
    assert inside.groupBy("uuid").count().agg(F.count("*"), F.max("count")).first()[:] == (50, 1)


def test_single_row_batch(spark):
    got = box_production(general(spark, [(0, "m", 1)]))
    assert values(got, "boxes", "boxes_per_hour", "first_uuid", "last_uuid") == [(1, None, 0, 0)]


def test_merge_equals_one_run(spark):
    df = general(spark, [(i * 60, "ab"[i % 2], 1) for i in range(20)])
    merged = merge_box_production(box_production(df.where("uuid < 9")), box_production(df))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, box_production(df).collect()))


def test_state_durations(spark):
    df = general(spark, [(0, "m", 100), (10, "m", 100), (30, "m", 600), (35, "m", 100)])
    as_of = F.lit(at(60).isoformat()).cast("timestamp_ntz")
    for within in (None, ["batch"]):
        got = values(plan.state_durations(df, as_of, next_within=within), "program_state", "runs", "total_seconds")
        assert sorted(got) == [(100.0, 2, 55.0), (600.0, 1, 5.0)]


def test_durations_stop_at_other_machines_in_the_literal_form(spark):
    df = general(spark, [(0, "m", 100), (10, "n", 300), (40, "m", 600)])
    as_of = F.lit(at(50).isoformat()).cast("timestamp_ntz")
    literal = plan.state_durations(df, as_of, next_within=["batch"])
    assert sorted(values(literal, "serial", "total_seconds")) == [("m", 10.0), ("m", 10.0), ("n", 30.0)]
    own = plan.state_durations(df, as_of)
    assert sorted(values(own, "serial", "total_seconds")) == [("m", 10.0), ("m", 40.0), ("n", 40.0)]


def test_asof_sees_rows_at_the_same_moment(spark):
    schema = "uuid long, time timestamp_ntz, serial string, v double"
    probes = spark.createDataFrame([(1, at(10), "m"), (2, at(15), "m"), (3, at(0), "m")], "uuid long, time timestamp_ntz, serial string")
    rows = spark.createDataFrame([(9, at(10), "m", 1.0), (8, at(20), "m", 2.0), (7, at(12), "n", 3.0)], schema)
    before = dict(values(asof(probes, rows, ["serial"], {"x": "v"}), "uuid", "x"))
    after = dict(values(asof(probes, rows, ["serial"], {"x": "v"}, forward=True), "uuid", "x"))
    assert before == {1: 1.0, 2: 1.0, 3: None}
    assert after == {1: 1.0, 2: 2.0, 3: 1.0}


def test_gapfill(spark):
    df = general(spark, [(0, "m", 1), (10, "m", 3), (3 * 3600, "m", 5), (3600, "n", 7)])
    measures = {"x": F.avg("program_state")}
    every = gapfill(df, ["serial"], 3600, measures)
    assert every.count() == 8 and every.where("x is null").count() == 5
    got = sorted(values(gapfill_carried(df, ["serial"], 3600, measures), "serial", "bucket", "x"), key=str)
    hours = [START + timedelta(hours=h) for h in range(4)]
    assert got == sorted([("m", h, v) for h, v in zip(hours, [2.0, 2.0, 2.0, 5.0])]
                         + [("n", h, v) for h, v in zip(hours, [None, 7.0, 7.0, 7.0])], key=str)


def test_carry_forward_reaches_every_machine(spark):
    # Twenty machines with a known state each, the oldest far back, then rows without one.
    known = [(i * 100, f"m{i:02}", 100 + i) for i in range(20)]
    unknown = [(10_000 + i, f"m{i:02}", None) for i in range(20)]
    df = general(spark, known + unknown)
    df = df.withColumn("carried", F.when(F.col("uuid") < 20, F.col("program_state")))
    got = dict(values(plan.carry_forward(df, "program_state", "carried"), "uuid", "carried"))
    assert all(got[20 + i] == 100.0 + i for i in range(20))
    # The original's ten newest machines, only if asked for.
    few = dict(values(plan.carry_forward(df, "program_state", "carried", machines=10), "uuid", "carried"))
    assert few[39] == 119.0 and few[20] is None


def test_carry_forward_bound_reaches_the_scan(spark, tmp_path):
    df = general(spark, [(0, "m", 100), (86_400, "m", None), (90_000, "m", 300)])
    df = df.withColumn("carried", F.when(F.col("uuid") < 1, F.col("program_state")))
    df.write.parquet(str(tmp_path / "general"))
    stored = spark.read.parquet(str(tmp_path / "general"))
    filled = plan.carry_forward(stored, "program_state", "carried")
    text = filled._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time,2024-03-01T00:00)" in text and "LessThan(time,2024-03-01T00:00)" in text
    assert dict(values(filled, "uuid", "carried")) == {0: 100.0, 1: 100.0, 2: 300.0}


def test_flags_of_machines_of_one_type_do_not_mix(spark):
    rows = [(i, at(t), "type", str(i % 2), "b", float(i % 2)) for i, t in enumerate([0, 10, 100, 110])]
    status = spark.createDataFrame(rows, "uuid long, time timestamp_ntz, machine string, machine_index string, batch string, on double")
    batches = spark.createDataFrame([("b", at(0), at(200))], "batch string, start_time timestamp_ntz, end_time timestamp_ntz")
    got = plan.flag_durations(status, batches, F.lit(at(200)), ["on"])
    assert sorted(values(got, "machine_index", "state", "duration_seconds")) == [("0", 0.0, 200.0), ("1", 1.0, 190.0)]


def test_flags_of_a_batch_that_the_list_lacks(spark):
    # 9 and 10 in counter order, not in that of text; 8 takes the times of 9, 95 those of 100, 200 has none after it.
    asked = ["8", "9", "95", "100", "200", "x", None]
    rows = [(2 * i + j, at(20 + 10 * j), "m", "1", b, 1.0) for i, b in enumerate(asked) for j in (0, 1)]
    status = spark.createDataFrame(rows, "uuid long, time timestamp_ntz, machine string, machine_index string, batch string, on double")
    listed = [("9", at(10), at(60)), ("10", at(60), at(90)), ("100", at(90), None)]
    batches = spark.createDataFrame(listed, "batch string, start_time timestamp_ntz, end_time timestamp_ntz")
    got = plan.flag_durations(status, batches, F.lit(at(200)), ["on"])
    assert {r[0]: r[1:] for r in values(got, "batch", "start_time", "end_time", "duration_seconds", "batch_seconds")} == {
        "8": (at(10), at(60), 40.0, 50.0), "9": (at(10), at(60), 40.0, 50.0),
        "95": (at(90), at(200), 180.0, 110.0), "100": (at(90), at(200), 180.0, 110.0),
        "200": (None, None, 10.0, None), "x": (None, None, 10.0, None)}


def test_state_durations_within_dense_batches(spark):
    # All machines of a batch count where the next row is looked for among them.
    from dataclasses import replace

    from plantpulse.operators.ordered import SLICE

    rows = [(i, f"m{i % 40}", 100) for i in range(2000)]
    order = replace(TimeOrder(keys=["batch"]), rows_per_slice=100)
    sizes = order.sliced(general(spark, rows)).groupBy("batch", SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= 150
