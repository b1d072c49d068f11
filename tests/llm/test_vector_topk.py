import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from plantpulse.llm.vector_topk import quantised, shard_best, shard_count, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, queries, k):
    out = []
    for q, own in queries.items():
        found = sorted((-int(np.dot(own, v)), i) for i, v in vectors.items() if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(found, 1)]
    return sorted(out)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=1, max_size=40), st.integers(1, 6), st.integers(1, 9))
def test_one_shard(vectors, k, block):
    x, ids = np.array(vectors, dtype=float), np.arange(len(vectors))
    names, scores = shard_best(x, ids, x[0], 0, k, block)
    want = brute(dict(enumerate(vectors)), {0: vectors[0]}, k)
    assert [(0, n, i, int(s)) for n, (i, s) in enumerate(zip(names, scores), 1)] == want


def test_ties_repeats_and_unsound_vectors(spark):
    rng = np.random.default_rng(0)
    made = {i: rng.integers(-2, 3, 6).astype(float).tolist() for i in range(300)}
    made[17] = made[18] = made[19] = made[100]
    unsound = [(900, None), (1000, [1.0, float("nan")] * 3), (1100, [1.0, None] * 3), (1200, [float("inf")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 0) for i, v in [*made.items(), *unsound]], SCHEMA)
    sound = quantised(df)
    assert sound.count() == 300
    whole = {i: [int(1024 * c) for c in v] for i, v in made.items()}
    want = brute(whole, {i: v for i, v in whole.items() if i % 50 == 0}, 7)
    got = top_k(sound, sound.where("vec_id % 50 = 0"), 7, queries_per_block=2, shards=5)
    assert sorted(map(tuple, got.collect())) == want


def test_more_vectors_make_more_shards(spark):
    rng = np.random.default_rng(1)
    made = {i: rng.integers(-2, 3, 6).astype(float).tolist() for i in range(300)}
    sound = quantised(spark.createDataFrame([(i, v, 0) for i, v in made.items()], SCHEMA))
    asked = sound.where("vec_id % 50 = 0")
    assert shard_count(sound, 5) == 60 and shard_count(sound.where("vec_id < 290"), 5) == 58
    assert sorted(top_k(sound, asked, vectors_per_shard=5).collect()) == sorted(top_k(sound, asked, shards=1).collect())


def test_few_rows(spark):
    one = quantised(spark.createDataFrame([(0, [0.5, -0.25], 1), (1, [1.0], 1)], SCHEMA))
    assert [tuple(r) for r in top_k(one, one.where("vec_id = 0")).collect()] == [(0, 1, 1, 512 * 1024)]
    none = quantised(spark.createDataFrame([], SCHEMA))
    assert top_k(none, none).count() == 0


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(3)
    for size, beyond in ((20_000.0, 0), (100_000.0, 0), (4e7, 1), (3e12, 1)):
        made = {i: (rng.random(64) * 2 - 1).tolist() for i in range(120)}
        made[7], made[60], made[61] = (((rng.random(64) * 2 - 1) * size).tolist() for _ in range(3))
        sound = quantised(spark.createDataFrame([(i, v, 0) for i, v in made.items()], "vec_id long, embedding array<double>, label int"))
        whole = {i: [int(np.floor(1024 * c)) for c in v] for i, v in made.items()}
        want = []
        for q in range(0, 120, 20):
            scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
            want += [(q, n, i, min(max(-s, -(2**63)), 2**63 - 1)) for n, (s, i) in enumerate(scores, 1)]
        got = sorted(map(tuple, top_k(sound, sound.where("vec_id % 20 = 0"), 5, shards=3).collect()))
        if beyond and any(abs(w[3]) >= 2**63 - 1 for w in want):
            # Scores no long holds are merged as equal ones.
            assert [g[3] for g in got] == [w[3] for w in want]
        else:
            assert got == want
