"""Mergeable digests against exact counts."""

from pyspark.sql import functions as F

from plantpulse.operators import digests

from .fixtures import START

HOUR, DAY = 3600, 86_400


def rows(spark, n=4000, values=40):
    at = F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 60)
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("serial"), at.alias("time"),
        F.when(F.col("id") % 5 != 0, F.col("id") % values).alias("x"), F.lit(None).cast("double").alias("none"),
        F.when(F.col("id") % 7 < 3, "often").when(F.col("id") % 7 < 5, "rare").alias("word"))


def made(df, seconds=HOUR):
    return digests.digest(df, ["serial"], seconds, ["x", "word", "none"], ["word", "x", "none"])


def told(df):
    return sorted(tuple(r) for r in digests.answers(df).collect())


def test_small_counts_are_exact(spark):
    df = rows(spark)
    got = {r["serial"]: r for r in digests.answers(digests.combine(made(df), ["serial"])).collect()}
    exact = df.groupBy("serial").agg(
        F.count("*").alias("n"), F.countDistinct("x").alias("x"), F.countDistinct("word").alias("word"),
        F.count_if(F.col("word") == "often").alias("often")).collect()
    counts = df.where("x IS NOT NULL").groupBy("serial", "x").count().collect()
    for e in exact:
        r = got[e["serial"]]
        assert (r["n"], r["distinct_x"], r["distinct_word"], r["distinct_none"]) == (e["n"], e["x"], e["word"], 0)
        assert (r["frequent_word"], r["times_word"]) == ("often", e["often"])
        assert (r["frequent_none"], r["times_none"]) == (None, 0)
        own = [(str(c["x"]), c["count"]) for c in counts if c["serial"] == e["serial"]]
        most = max(n for _, n in own)
        assert (r["times_x"], r["frequent_x"]) == (most, min(x for x, n in own if n == most))


def test_merging_in_steps_and_parts_gives_the_same(spark, tmp_path):
    df = rows(spark)
    step = digests.store_digests(str(tmp_path / "d"), made)
    # Parts that share buckets, one of them repeated and one empty.
    for number, part in enumerate([df.where("x < 9"), df.where("x >= 9"), df.where("x IS NULL"), df.where("false")]):
        for _ in range(2):
            step(part, number)
    stored = spark.read.parquet(str(tmp_path / "d")).drop("run")
    assert told(digests.combine(stored, ["serial", "bucket"])) == told(made(df))
    by_day = digests.combine(stored.withColumn("bucket", F.date_trunc("day", "bucket").cast("timestamp_ntz")), ["serial", "bucket"])
    assert told(by_day) == told(made(df, DAY))
    assert told(digests.combine(by_day, ["serial"])) == told(digests.combine(made(df), ["serial"]))


def test_large_counts_are_within_their_error(spark):
    df = rows(spark, n=60_000, values=50_021)
    got = digests.answers(digests.combine(digests.digest(df, ["serial"], 10 * DAY, ["x"]), ["serial"]))
    exact = {r["serial"]: r["n"] for r in df.groupBy("serial").agg(F.countDistinct("x").alias("n")).collect()}
    error = 3 * 1.04 / 2 ** (digests.LG_CELLS / 2)
    assert all(abs(r["distinct_x"] / exact[r["serial"]] - 1) <= error for r in got.collect()) and len(exact) == 2


def test_frequent_values_among_very_many(spark):
    df = rows(spark, n=60_000, values=50_021).withColumn("x", F.when(F.col("word") == "often", -1).otherwise(F.col("x")))
    got = digests.answers(digests.combine(digests.digest(df, [], 10 * DAY, [], ["x"]), [])).first()
    exact = df.where("x = -1").count()
    assert got["frequent_x"] == "-1" and exact <= got["times_x"] <= exact + 60_000 / digests.TRACKED
