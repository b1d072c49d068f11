"""Writing, merging and retention."""

from pyspark.sql import functions as F

from plantpulse.plans.usage import capture
from plantpulse.sources import series, sinks, tables

from .fixtures import at, general, values


def test_append_twice_adds_nothing(spark, tmp_path):
    df = general(spark, [(i, "m", i) for i in range(6)]).select("uuid", "time", "serial")
    folder = str(tmp_path / "t")
    df.where("uuid < 3").write.parquet(folder)
    for _ in range(2):
        sinks.append_new(df, folder, ["uuid"])
    assert sorted(values(spark.read.parquet(folder), "uuid")) == [(i,) for i in range(6)]


def test_a_null_key_counts_as_new(spark):
    new = spark.createDataFrame([(None, 1), (2, 2)], "k long, v int")
    assert values(sinks.only_new(new, new, ["k"]), "v") == [(1,)]


def test_merge_keeps_unchanged_and_fixed_columns(spark):
    schema = "k long, version long, fixed string, value double"
    stored = spark.createDataFrame([(1, 10, "old", 1.0), (2, 20, "old", 2.0), (4, 40, "old", 4.0)], schema)
    new = spark.createDataFrame([(1, 10, "new", 9.0), (2, 21, "new", 9.0), (3, 30, "new", 3.0)], schema)
    merged = sinks.merge_batches(stored, new, "k", "version", ["value", "version"])
    assert sorted(map(tuple, merged.collect())) == [
        (1, 10, "old", 1.0), (2, 21, "old", 9.0), (3, 30, "new", 3.0), (4, 40, "old", 4.0)]


def test_backfill_never_writes_null(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "uuid long, x double")
    new = spark.createDataFrame([(1, None), (2, 5.0)], "uuid long, x double")
    assert sorted(values(sinks.backfill(df, new, "uuid", "x"), "uuid", "x")) == [(1, 1.0), (2, 5.0), (3, 3.0)]


def test_chunks_round_trip(spark, tmp_path):
    df = general(spark, [(i * 40_000, "m", 1) for i in range(7)]).select("uuid", "time")
    folder = str(tmp_path / "chunks")
    sinks.write_chunks(df, folder, 86_400)
    back = sinks.read_chunks(spark, folder, df.schema)
    assert back.count() == 7 and back.select("chunk").distinct().count() == 3
    plan = back.where("chunk = '2024-03-01T00-00-00'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan


def test_retention_drops_whole_chunks(spark):
    df = general(spark, [(i * 43_200, "m", 1) for i in range(8)])
    kept = sinks.retain(df, tables.newest(df), 1, 86_400)
    assert sorted(u for (u,) in values(kept, "uuid")) == [4, 5, 6, 7]


def test_delete_keeps_rows_of_unknown_condition(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0), (3, 2.0)], "uuid long, x double")
    assert sorted(values(sinks.delete_where(df, F.col("x") > 1), "uuid")) == [(1,), (2,)]


def test_recent_is_clamped_to_an_hour(spark):
    df = general(spark, [(i * 600, "m", 1) for i in range(20)])
    got = values(tables.recent(df, tables.newest(df), minutes=500, limit=100, most_minutes=60), "uuid")
    assert [u for (u,) in got] == [14, 15, 16, 17, 18, 19]
    assert tables.recent(df, tables.newest(df), minutes=500).count() == 20


def test_filter_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = tables.time_range(events, "2024-01-05 00:00:00", "2024-01-06 00:00:00", ["event_id", "ts"], "ts")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_series(spark):
    df = spark.createDataFrame([(1.0, at(1800)), (3.0, at(7200))], "x double, time timestamp_ntz")
    assert [v for (v,) in values(series.number_series(df, "x", 0.5), "value")] == [1.0, 1.5, 2.0, 2.5, 3.0]
    assert [v for (v,) in values(series.time_series(df, "time", 3600), "moment")] == [at(0), at(3600), at(7200)]


def test_a_long_series_is_made_in_chunks(spark):
    bounds = spark.createDataFrame([(0.0,), (10_000_000.0,)], "x double")
    made = series.number_series(bounds, "x", 1.0)
    got = made.withColumn("part", F.spark_partition_id()).agg(F.count("value"), F.sum("value"), F.countDistinct("part")).first()
    assert (got[0], got[1]) == (10_000_001, 10_000_000 * 10_000_001 / 2) and got[2] > 1
    assert series.number_series(bounds.where("x < 0"), "x", 1.0).count() == 0


def pushed(df):
    return "".join(x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "PushedFilters" in x)


def test_time_bounds_reach_the_scan(spark):
    as_of = F.lit("2024-01-31").cast("timestamp_ntz")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "user_id")
    assert "GreaterThanOrEqual(ts,2024-01-21T00:00)" in pushed(sinks.retain(events, as_of, 10, 86_400, "ts"))


def test_capture_keeps_every_event_once(spark, tmp_path):
    events = spark.createDataFrame([(1, "fine"), (2, "drop it"), (3, None)], "id long, text string")
    rejected = capture(events, "text", str(tmp_path / "log"))
    assert values(rejected, "id") == [(2,)]
    assert sorted(values(spark.read.parquet(str(tmp_path / "log")), "id")) == [(1,), (3,)]
