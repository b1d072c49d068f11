"""Jobs over all tenants: marks, broken runs, and equality with one run over everything."""

import pytest
from pyspark.sql import functions as F

from plantpulse.plans.production import box_production
from plantpulse.plans.tenants import production, update_production
from plantpulse.sources import commits

from .fixtures import general

HOUR = 3600


def rows(spark, *seconds, serial="m", batch="r1"):
    df = general(spark, [(s, serial, 1) for s in seconds]).withColumn("batch", F.lit(batch))
    # Ids and counters that grow with the time, whatever the delivery.
    return df.withColumn("uuid", F.lit(list(seconds))[F.col("uuid").cast("int")].cast("long")).withColumn("total_cases", F.col("uuid"))


def content(df):
    columns = sorted(c for c in df.columns)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture
def plant(spark, tmp_path):
    """Config of two tenants, and a function that delivers rows to one of them."""
    config = {"target": str(tmp_path / "target"), "tenants": {t: str(tmp_path / t) for t in ("a", "b")}, "overlap_hours": 2}

    def deliver(tenant, df):
        df.write.mode("append").parquet(config["tenants"][tenant])

    deliver("a", rows(spark, 0, HOUR, 2 * HOUR))
    deliver("b", rows(spark, 0, 30 * HOUR, serial="n").unionByName(rows(spark, 40 * HOUR, serial="n", batch=None)))
    return config, deliver


def whole(spark, config):
    every = [spark.read.parquet(path).withColumn("tenant", F.lit(t)) for t, path in config["tenants"].items()]
    return content(box_production(every[0].unionByName(every[1]), extra_keys=["tenant"]))


def test_two_runs_equal_one(spark, plant):
    config, deliver = plant
    assert update_production(spark, config) == ["a_2024-03-01", "b_2024-03-01", "b_2024-03-02"]
    assert content(production(spark, config["target"])) == whole(spark, config)
    # Tenant a: later rows, one that comes late, and the next batch. Tenant b stays as it is.
    deliver("a", rows(spark, HOUR // 2, 3 * HOUR).unionByName(rows(spark, 26 * HOUR, 27 * HOUR, batch="r2")))
    assert update_production(spark, config) == ["a_2024-03-01", "a_2024-03-02"]
    assert content(production(spark, config["target"])) == whole(spark, config)
    marks = commits.newest(spark, config["target"]).marks
    assert marks == {"a": "2024-03-02 03:00:00", "b": "2024-03-02 16:00:00"}


def test_a_late_first_row_moves_the_batch(spark, plant):
    config, deliver = plant
    config["overlap_hours"] = 48
    update_production(spark, config)
    deliver("a", rows(spark, -HOUR))
    assert update_production(spark, config) == ["a_2024-02-29", "a_2024-03-01"]
    assert content(production(spark, config["target"])) == whole(spark, config)
    assert commits.newest(spark, config["target"]).marks["a"] == "2024-03-01 02:00:00"


def test_a_run_killed_before_its_commit_is_done_again(spark, plant, monkeypatch):
    config, deliver = plant
    update_production(spark, config)
    before = commits.newest(spark, config["target"])
    deliver("a", rows(spark, 5 * HOUR))
    deliver("b", rows(spark, 41 * HOUR, serial="n"))

    def fail(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(commits, "publish", fail)
        with pytest.raises(KeyboardInterrupt):
            update_production(spark, config)
    assert commits.newest(spark, config["target"]) == before
    update_production(spark, config)
    assert content(production(spark, config["target"])) == whole(spark, config)
    after = commits.newest(spark, config["target"])
    assert update_production(spark, config) == [] and commits.newest(spark, config["target"]) == after


def test_rows_before_the_mark_are_not_read_again(spark, plant):
    config, deliver = plant
    update_production(spark, config)
    # Three hours before the mark of b, which reads two again.
    deliver("b", rows(spark, 37 * HOUR, serial="late"))
    assert update_production(spark, config) == []
    assert {r["serial"] for r in production(spark, config["target"]).collect()} == {"m", "n"}


def test_a_new_tenant_starts_with_all_its_rows(spark, plant):
    config, _ = plant
    alone = config | {"tenants": {"a": config["tenants"]["a"]}}
    update_production(spark, alone)
    assert update_production(spark, config) == ["b_2024-03-01", "b_2024-03-02"]
    assert update_production(spark, alone) == []
    assert content(production(spark, config["target"])) == whole(spark, config)


def test_odd_configs(spark, tmp_path):
    empty = rows(spark, 0).where("false")
    target = str(tmp_path / "t")
    assert update_production(spark, {"target": target, "tenants": {"a": empty}}) == []
    with pytest.raises(ValueError, match="no production"):
        production(spark, target)
    without_time = rows(spark, 0).withColumn("time", F.lit(None).cast("timestamp_ntz"))
    assert update_production(spark, {"target": target, "tenants": {"a": without_time}}) == []
    for config in ({"target": target}, {"target": target, "tenants": {}}, {"target": target, "tenants": {"a": empty}, "x": 1}):
        with pytest.raises(ValueError, match="config"):
            update_production(spark, config)
