from collections import Counter

import pytest

from plantpulse.llm.source_mix import copies, mixed, targets

from .helpers import AWKWARD, FOLDER, awkward, clashing, nothing


def filled(sizes, weights, share, most):
    """Targets by cutting off and sharing again, as the contract tells it."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    full, out = {}, {}
    while True:
        rest = share * sum(sizes.values()) - sum(full.values())
        open_ = [n for n in names if n not in full]
        total = sum(weight[n] for n in open_)
        out = {n: rest * weight[n] / total for n in open_}
        above = [n for n in open_ if out[n] > most * sizes[n]]
        if not above:
            return out | full
        full |= {n: most * sizes[n] for n in above}


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 50, None: 7}, {"a": 1}, {"b": 0, "a": 0}, {f"s{i}": i * i for i in range(20)}, {"é": 5, "z": 5, "Z": 900}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(df, (5, 2, 1), 1.5, 2.0).collect()}
    assert got == pytest.approx(filled(sizes, (5, 2, 1), 1.5, 2.0))


def test_each_source_comes_near_its_target(spark):
    rows = copies(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r["size"]
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)


def test_reruns_agree_and_mixed_rows_match(spark):
    docs = clashing(spark)
    first, second = (sorted(map(repr, copies(docs).collect())) for _ in range(2))
    assert first == second and len(first) == len(AWKWARD)
    out = mixed(docs)
    assert out.columns == docs.columns
    want = Counter()
    for r in copies(awkward(spark)).collect():
        want[r.doc_id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in out.collect()) == +want


def test_a_source_spread_over_many_partitions(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', 3) AS text", "'one' AS source")
    rows = copies(docs).collect()
    assert sum(r.copies for r in rows) == 4500 and {r.copies for r in rows} == {1, 2}


def test_empty_table(spark):
    assert copies(nothing(spark)).count() == 0 and mixed(nothing(spark)).count() == 0
