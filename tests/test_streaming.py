"""Stream jobs against their batch counterparts."""

import random

from pyspark.sql import functions as F

from plantpulse.plans.alarms import alarm_lines_strict
from plantpulse.plans.machines import BY_MACHINE
from plantpulse.operators import ordered
from plantpulse.operators.ordered import carry
from plantpulse.streaming import jobs

from .fixtures import alarms, general, values


def run_steps(step, parts, repeat=()):
    for number, part in enumerate(parts):
        step(part, number)
        if number in repeat:
            step(part, number)


def test_alarm_blocks_over_batches(spark, tmp_path):
    rng = random.Random(5)
    tables = [alarms(spark, [rng.choice([0, 0, 10, 20]) for _ in range(60)], s, first=f, step=1800)
              for s, f in (("a", 0), ("b", 1000))]
    whole = tables[0].unionByName(tables[1])
    quarters = [whole.where(F.floor(F.col("uuid") % 1000 / 15) == i) for i in range(4)]
    step = jobs.alarm_blocks(str(tmp_path / "lines"), str(tmp_path / "open"))
    run_steps(step, quarters, repeat=[1, 3])
    got = jobs.current_lines(spark, str(tmp_path / "lines"))
    expected = alarm_lines_strict(whole)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.select(*got.columns).collect()))


def test_history_is_read_for_late_alarms_only(spark, tmp_path, monkeypatch):
    whole = alarms(spark, [0, 10, 0, 20, 0, 10, 0, 0], "a").unionByName(
        alarms(spark, [0, 10, 0, 20, 0, 10, 0, 0], "b", first=1000)).unionByName(
        alarms(spark, [0, 10, 0, 20, 0, 10, 0, 0], "c", first=2000))
    late = F.col("uuid") == 1003
    half = F.col("uuid") % 1000 < 4
    reads, plain = [], jobs.delivered_rows

    def noted(spark, folder, schema, number, slots):
        found = plain(spark, folder, schema, number, slots)
        reads.append((number, len(slots), set(values(found, "serial")), found.count()))
        return found

    monkeypatch.setattr(jobs, "delivered_rows", noted)
    step = jobs.alarm_blocks(str(tmp_path / "lines"), str(tmp_path / "open"))
    run_steps(step, [whole.where(half & ~late), whole.where(~half), whole.where(late)])
    # The three alarms lie in slots of their own.
    assert reads == [(2, 1, {("b",)}, 8)]
    got = jobs.current_lines(spark, str(tmp_path / "lines"))
    assert sorted(map(str, got.collect())) == sorted(map(str, alarm_lines_strict(whole).select(*got.columns).collect()))


def test_rows_of_a_batch_are_put_in_order_once(spark, tmp_path, monkeypatch):
    """The lines and the held rows start from one order over the rows, which are stored once."""
    whole = alarms(spark, [0, 10, 0, 20, 0, 10, 0, 0], "a").unionByName(alarms(spark, [0, 10, 0, 20, 0, 10, 0, 0], "b", first=1000))
    late = F.col("uuid") == 1003
    orders, sizes, in_order, kept = [], [], ordered.with_neighbours, jobs.stored

    def noted_order(df, *args, **kwargs):
        orders.append(df.count())
        return in_order(df, *args, **kwargs)

    def noted_rows(df, purpose):
        found = kept(df, purpose)
        sizes.append(found[0].count())
        return found

    monkeypatch.setattr(ordered, "with_neighbours", noted_order)
    monkeypatch.setattr(jobs, "stored", noted_rows)
    step = jobs.alarm_blocks(str(tmp_path / "lines"), str(tmp_path / "open"))
    run_steps(step, [whole.where(~late), whole.where(late)])
    # The second delivery has one late alarm of eight rows; of the other one five rows are held.
    assert orders[0] == 15 and len(orders) == 2 and sizes == [15, 1, orders[1]]
    got = jobs.current_lines(spark, str(tmp_path / "lines"))
    assert sorted(map(str, got.collect())) == sorted(map(str, alarm_lines_strict(whole).select(*got.columns).collect()))


def test_late_rows_of_alarm_blocks(spark, tmp_path):
    rng = random.Random(6)
    whole = alarms(spark, [rng.choice([0, 0, 10, 20]) for _ in range(60)], "a", step=1800).unionByName(
        alarms(spark, [rng.choice([0, 10, 20]) for _ in range(60)], "b", first=1000, step=1800))
    late = F.col("uuid") % 6 == 1
    half = F.col("uuid") % 1000 < 30
    parts = [whole.where(half & ~late), whole.where(~half & ~late), whole.where(late)]
    step = jobs.alarm_blocks(str(tmp_path / "lines"), str(tmp_path / "open"))
    run_steps(step, parts, repeat=[2])
    got = jobs.current_lines(spark, str(tmp_path / "lines"))
    expected = alarm_lines_strict(whole)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.select(*got.columns).collect()))


def test_late_rows_repair_what_follows(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i * 5000, rng.choice("abb"), rng.choice([None, None, 100, 300])) for i in range(80)]
    whole = general(spark, rows).select("uuid", "time", "serial", "program_state")
    late = F.col("uuid") % 7 == 0
    on_time = whole.where(~late)
    parts = [on_time.where("uuid < 40"), on_time.where("uuid >= 40"), whole.where(late)]
    folder = str(tmp_path / "carried")
    run_steps(jobs.late_repair(folder), parts, repeat=[2])
    got = dict(values(spark.read.parquet(folder), "uuid", "carried"))
    assert got == dict(values(carry(whole, BY_MACHINE, carried="program_state"), "uuid", "carried"))


def test_repeated_deliveries_appear_once(spark, tmp_path):
    df = general(spark, [(i, "m", 1) for i in range(10)]).select("uuid", "time", "serial")
    feed = str(tmp_path / "feed")
    for part in (df.where("uuid < 6"), df.where("uuid >= 3")):
        part.coalesce(1).write.mode("append").parquet(feed)
    unique = jobs.drop_repeats(jobs.read_stream(spark, feed, df.schema))
    writer = unique.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert sorted(values(spark.read.parquet(str(tmp_path / "out")), "uuid")) == [(i,) for i in range(10)]


def test_last_state_over_batches(spark, tmp_path):
    df = general(spark, [(0, "m", 1), (5, "m", None), (3, "n", 4), (4, "n", 2)]).select("uuid", "time", "serial", "program_state")
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    for part in (df.where("uuid >= 2"), df.where("uuid < 2")):
        part.write.mode("append").parquet(feed)
        stream = jobs.last_known_state(jobs.read_stream(spark, feed, df.schema))
        jobs.each_batch(stream, jobs.store_updates(out), str(tmp_path / "c"), mode="update").awaitTermination()
    before = sorted(map(tuple, jobs.latest_updates(spark, out, "serial").collect()))
    jobs.compact_updates(spark, out, "serial")
    assert len(list((tmp_path / "out").glob("run=*"))) == 1
    assert sorted(map(tuple, jobs.latest_updates(spark, out, "serial").collect())) == before
    assert sorted(values(jobs.latest_updates(spark, out, "serial"), "serial", "program_state")) == [("m", 1.0), ("n", 2.0)]


def weighings(spark, days, first=0):
    from .fixtures import at

    rows = [(first + i, at(day * 86_400 + hour * 3_600 + i), "L", "m", "m", "G", "W", "J", "b", 10.0 + i % 7, 20.0, 5.0, 5.0, 1.0, 1, 10, 1, "K", 1, "C", "D")
            for i, (day, hour) in enumerate((d, h) for d in days for h in (0, 5, 5, 23))]
    names = ("uuid long, time timestamp_ntz, line string, machine string, serial string, logger string, unit_id string, recipe string, "
             "batch string, net double, setpoint double, max_over double, max_under double, tare double, unit_code int, result_code int, "
             "module_index int, module_key string, struct_version int, custom_1 string, custom_2 string")
    return spark.createDataFrame(rows, names)


def test_only_touched_days_are_refreshed(spark, tmp_path):
    from pathlib import Path

    from plantpulse.plans.weighing import HOUR, HOURLY_KEYS, rollup
    from plantpulse.streaming.rollups import note_touched, refresh_touched, stored_rollup

    on_time, late = weighings(spark, range(30)), weighings(spark, [4, 17], first=10_000)
    folder, ledger = str(tmp_path / "rollup"), str(tmp_path / "ledger")
    files = lambda: {str(f): f.stat().st_mtime_ns for f in Path(folder).rglob("*.parquet")}
    stored_rollup(on_time, folder)
    before = files()
    for _ in range(2):  # a delivery that is repeated changes nothing
        note_touched(late, ledger, 0)
    days = refresh_touched(on_time.unionByName(late), folder, ledger)
    after = files()
    changed = {f.split("day=")[1][:10] for f in before if after.get(f) != before[f]}
    assert changed == {str(d) for d in days} and len(changed) == 2
    expected = rollup(on_time.unionByName(late), HOURLY_KEYS, HOUR)
    got = spark.read.parquet(folder).select(*expected.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    Path(ledger).mkdir(exist_ok=True)
    assert refresh_touched(on_time, folder, ledger) == [] and files() == after


def test_a_refresh_that_broke_off_is_done_again(spark, tmp_path, monkeypatch):
    from plantpulse.plans.weighing import HOUR, HOURLY_KEYS, rollup
    from plantpulse.streaming import rollups

    on_time, late = weighings(spark, range(3)), weighings(spark, [1], first=10_000)
    folder, ledger = str(tmp_path / "rollup"), str(tmp_path / "ledger")
    rollups.stored_rollup(on_time, folder)
    rollups.note_touched(late, ledger, 7)

    def broken(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(rollups, "write_by", broken)
        try:
            rollups.refresh_touched(on_time.unionByName(late), folder, ledger)
        except RuntimeError:
            pass
    assert len(rollups.refresh_touched(on_time.unionByName(late), folder, ledger)) == 1
    expected = rollup(on_time.unionByName(late), HOURLY_KEYS, HOUR)
    assert sorted(map(str, spark.read.parquet(folder).select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
