"""SQL functions against their DataFrame forms, and answers from footers."""

from pyspark.sql import functions as F

from plantpulse import sql
from plantpulse.functions import text, time, values
from plantpulse.sources import footers

FOLDER = "/root/testdata/sf0.001"


def test_scalar_functions_equal_the_columns(spark):
    sql.register(spark)
    texts = ["plain", "a'b", "it -- is", "/* x", "selects", "SELECT", "x@", "x@y", "sys", "", None, "open door", "back\\slash"]
    rows = [(t, i % 5, v) for i, (t, v) in enumerate(zip(texts, [5.0, 5.5, 50.0, 60.0, 150.0, 250.0, 400.0, 900.0, 2e3, 1.2e4, 2e4, None, 0.0]))]
    df = spark.createDataFrame(rows, "t string, code int, nominal double").withColumn("key", F.lit("_29_3_39_4"))
    df = df.withColumn("at", F.lit("2024-02-03 04:05:06.789").cast("timestamp_ntz"))
    df.createOrReplaceTempView("given")
    got = spark.sql("SELECT check_string(t), grams_per_unit(code), tolerance_grams(nominal), general_key(key), utc2epoch(at), "
                    "epoch2utc(utc2epoch(at)) FROM given").collect()
    ms = time.epoch_ms("at")
    want = df.select(
        text.is_safe(F.col("t")), values.grams_per_unit(F.col("code")), values.tolerance_grams(F.col("nominal")),
        text.general_key(F.col("key")), ms, time.from_epoch_ms(ms)).collect()
    assert list(map(tuple, got)) == list(map(tuple, want))


def test_footers_answer_without_rows(spark):
    for name, column in (("lineitem", "l_orderkey"), ("events", "user_id")):
        path = f"{FOLDER}/{name}.parquet"
        plain = spark.read.parquet(path).agg(F.count("*"), F.count(column), F.min(column), F.max(column)).first()
        assert footers.rows(spark, path).first()["n"] == plain[0]
        bounds = footers.bounds(spark, path, [column])
        assert tuple(bounds.first()) == (column, plain[1], float(plain[2]), float(plain[3]))
        for df in (bounds, footers.rows(spark, path)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "PushedAggregation: [COUNT(" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
