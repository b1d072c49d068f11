"""Alarm blocks on hand-built state sequences."""

from plantpulse.plans import alarms as plan
from plantpulse.sources.sinks import mark, unmarked

from .fixtures import alarms, timed_alarms, values

SECONDS = ("active_seconds", "waiting_seconds", "alarm_seconds")


def test_three_state_block(spark):
    rows = [(0, "23:30:00", 0), (0, "23:40:00", 10), (0, "23:50:45", 0), (1, "00:04:34", 10), (1, "00:08:15", 20),
            (1, "00:08:16", 0), (1, "00:32:52", 10)]
    df = timed_alarms(spark, rows)
    for lines in (plan.alarm_lines(df), plan.alarm_lines_strict(df)):
        assert values(lines, *SECONDS, "max_state", "block_uuid") == [(221.0, 1.0, 222.0, 20.0, 5)]


def test_two_state_block_shares_rows_in_the_literal_form(spark):
    df = alarms(spark, [0, 1, 0, 1, 0, 10, 0])
    rows = plan.block_rows(df)
    shared = rows.where("state = 10").select("block_uuid").distinct().count()
    assert shared == 2
    strict = plan.alarm_lines_strict(df)
    assert sorted(values(strict, "block_uuid", "max_state")) == [(4, 1.0), (6, 10.0)]


def test_oscillation(spark):
    df = alarms(spark, [10, 0, 10, 20, 10, 0])
    assert values(plan.alarm_lines(df), "alarm_end") == [(None,)]
    (strict,) = values(plan.alarm_lines_strict(df), *SECONDS)
    assert strict == (60.0, 120.0, 180.0)


def test_first_and_open_blocks_are_left_out(spark):
    df = alarms(spark, [0, 10, 0, 10, 0, 10])
    assert [b for (b,) in values(plan.alarm_lines_strict(df), "block_uuid")] == [4]
    assert [b for (b,) in values(plan.alarm_lines(df), "block_uuid")] == [4]


def test_consolidated_keeps_edges_and_repeated_states(spark):
    got = sorted(values(plan.consolidated(alarms(spark, [0, 0, 0, 10, 10, 0])), "uuid", "edge"))
    assert got == [(3, True), (4, False), (5, True)]


def test_null_state_is_never_a_transition(spark):
    assert values(plan.transitions(alarms(spark, [0, None, 10, 10, 0])), "uuid") == [(4,)]


def test_pruning_zeros_keeps_the_lines(spark):
    df = alarms(spark, [0, 0, 0, 10, 0, 0, 20, 20, 0, 0, 10, 0])
    seen = plan.with_previous_state(df)
    pruned = unmarked(mark(seen, (seen["state"] == 0) & (seen["previous_state"] == 0))).drop("mark", "previous_state")
    assert pruned.count() < df.count()
    assert sorted(values(plan.without_redundant_zeros(df), "uuid")) == sorted(values(pruned, "uuid"))
    assert values(plan.alarm_lines_strict(pruned), "block_uuid", *SECONDS) == values(
        plan.alarm_lines_strict(df), "block_uuid", *SECONDS)


def test_stored_blocks_are_skipped(spark):
    df = alarms(spark, [0, 10, 0, 10, 0, 20, 0])
    every = {b for (b,) in values(plan.alarm_lines(df), "block_uuid")}
    stored = spark.createDataFrame([(4,)], "block_uuid long")
    assert {b for (b,) in values(plan.alarm_lines(df, stored), "block_uuid")} == every - {4}


def test_machines_do_not_mix(spark):
    one, two = alarms(spark, [0, 10, 0, 10, 0], "a"), alarms(spark, [0, 0, 20, 0, 20, 0, 0], "b", first=100)
    both = plan.alarm_lines(one.unionByName(two))
    assert sorted(values(both, "serial", "block_uuid")) == [("a", 4), ("b", 105)]


def test_modal_interval_takes_the_smallest_on_a_tie(spark):
    df = timed_alarms(spark, [(0, "00:00:00", 0), (0, "00:00:10", 0), (0, "00:00:30", 0), (0, "00:00:40", 0), (0, "00:01:00", 0)])
    assert values(plan.modal_interval(df, "idx"), "idx", "interval_ms") == [("1", 10_000)]
