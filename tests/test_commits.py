"""Tables in parts with a commit list: merges, broken runs, and what stays where it is."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plantpulse.sources import commits

SCHEMA = "k long, day string, version long, fixed string, value double"


def rows(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


def merge(df, folder, **options):
    return commits.upsert(df, folder, ["k"], F.col("day"), version=["version"], updated=["version", "value"], **options)


def table(spark, folder):
    found = commits.read(spark, folder, rows(spark).schema)
    return sorted((tuple(r) for r in found.collect()), key=str)


def files(folder):
    return {str(f) for f in Path(folder, "data").rglob("*.parquet")}


@pytest.fixture
def start(spark, tmp_path):
    folder = str(tmp_path / "t")
    merge(rows(spark, (1, "a", 10, "old", 1.0), (2, "a", 20, "old", 2.0), (3, "b", 30, "old", 3.0), (None, "c", 40, "old", 4.0)), folder)
    return folder


def test_only_parts_with_a_changed_key_are_written(spark, start):
    before, held = commits.newest(spark, start), files(start)
    new = rows(spark, (1, "a", 11, "new", 9.0), (3, "b", 30, "new", 9.0), (5, "d", 50, "new", 5.0), (None, "c", 40, "new", 9.0))
    assert merge(new, start) == ["a", "d"]
    after = commits.newest(spark, start)
    assert {p for p in before.parts if after.parts[p] == before.parts[p]} == {"b", "c"}
    assert held <= files(start)
    assert table(spark, start) == sorted([
        (1, "a", 11, "old", 9.0, "a"), (2, "a", 20, "old", 2.0, "a"), (3, "b", 30, "old", 3.0, "b"),
        (5, "d", 50, "new", 5.0, "d"), (None, "c", 40, "old", 4.0, "c")], key=str)


def test_a_repeated_merge_writes_nothing(spark, start):
    new = rows(spark, (1, "a", 11, "new", 9.0), (None, "c", 41, "new", 8.0))
    assert merge(new, start) == ["a", "c"]
    held, commit = files(start), commits.newest(spark, start)
    assert merge(new, start) == [] and files(start) == held and commits.newest(spark, start) == commit


def test_a_run_broken_off_before_its_commit_is_not_seen(spark, start, monkeypatch):
    new = rows(spark, (1, "a", 11, "new", 9.0), (6, "b", 60, "new", 6.0))
    before = table(spark, start)

    def fail(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(commits, "publish", fail)
        with pytest.raises(KeyboardInterrupt):
            merge(new, start)
    assert table(spark, start) == before
    assert merge(new, start) == ["a", "b"]
    assert (1, "a", 11, "old", 9.0, "a") in table(spark, start) and len(table(spark, start)) == 5
    rest = table(spark, start)
    # The broken run's write, and the first one's only as long as a part still needs it.
    assert len(commits.vacuum(spark, start)) == 1 and table(spark, start) == rest
    assert commits.vacuum(spark, start) == []


def test_a_row_can_move_to_another_part(spark, start):
    new = rows(spark, (3, "a", 31, "new", 9.0))
    written = commits.upsert(new, start, ["k"], F.col("day"))
    assert written == ["a", "b"] and "b" not in commits.newest(spark, start).parts
    assert [r for r in table(spark, start) if r[0] == 3] == [(3, "a", 31, "new", 9.0, "a")]
    assert len(table(spark, start)) == 4


def test_a_second_writer_fails(spark, start):
    with pytest.raises(RuntimeError, match="taken"):
        commits.publish(spark, start, commits.newest(spark, start))
    assert len(table(spark, start)) == 4


def test_marks_are_part_of_the_commit(spark, start):
    assert merge(rows(spark), start, marks={"x": "1"}) == []
    merge(rows(spark, (9, None, 1, None, None)), start, marks={"y": "2"})
    commit = commits.newest(spark, start)
    assert commit.marks == {"x": "1", "y": "2"} and (9, None, 1, None, None, "none") in table(spark, start)


def test_odd_part_names_and_reserved_columns(spark, tmp_path):
    folder = str(tmp_path / "odd")
    given = rows(spark, (1, "a/b=c %", 1, "x", 1.0), (2, "", 1, "x", 1.0), (3, "2024-01-01", 1, "x", 1.0), (4, "007", 1, "x", 1.0))
    assert merge(given, folder) == sorted(["a/b=c %", "none", "2024-01-01", "007"])
    assert merge(given, folder) == [] and len(table(spark, folder)) == 4
    with pytest.raises(ValueError, match="reserved"):
        commits.upsert(given.withColumn("part", F.lit(1)), folder, ["k"], F.col("day"))


def test_the_scan_reads_only_the_parts_asked_for(spark, start):
    found = commits.read(spark, start, rows(spark).schema, parts=["b"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and [r["k"] for r in found.collect()] == [3]
