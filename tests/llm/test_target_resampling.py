import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from plantpulse.llm.target_resampling import Weigher, planes, resampled

from .helpers import AWKWARD, awkward, clashing, nothing


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features(text, longest):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, percent, least, longest=1, buckets=10_000):
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(at(f) for text in texts for f in features(text, longest)) for texts in ([d[1] for d in docs], target))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        weight = sum(math.floor(1000 * math.log((t[at(f)] + 1.0) * (S + buckets) / ((s[at(f)] + 1.0) * (T + buckets)))) for f in features(text, longest))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(words(text)), len(features(text, longest)), weight, score))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    rank = {r: i for i, r in enumerate(able[: percent * len(able) // 100], 1)}
    return Counter((*r, rank.get(r)) for r in out)


def found(df):
    assert df.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return Counter(map(tuple, df.collect()))


def test_equals_plain_sums_with_two_word_features(spark):
    draw = random.Random(8)
    texts = [" ".join(draw.choices(["Wort", "wort", "a1", "é", "x" * 40, "rare", "b-c"], k=draw.randint(0, 80))) for _ in range(90)]
    docs = [(2**60 + 3 * i, t) for i, t in enumerate(texts)] + [(None, "without an id " * 9)]
    target = ["rare rare a1", None, "é"]
    df, wanted = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(t,) for t in target], "text string")
    assert found(resampled(df, wanted, percent=35, longest=2)) == plain(docs, target, 35, 20, 2)
    none = wanted.limit(0)
    assert found(resampled(df, none)) == plain(docs, [], 10, 20)


def test_bit_planes_give_exact_products():
    draw = np.random.default_rng(5)
    for buckets, most in ((64, 3), (100, 1_000_000), (10_000, 40)):
        gains, features_ = draw.integers(-most, most, buckets), draw.integers(0, buckets, 3_000)
        assert Weigher(gains)(features_) == int(gains[features_].sum())
    assert Weigher(np.zeros(70, dtype=np.int64))(np.array([1, 1, 69])) == 0
    assert planes(np.array([5, 0, 2])).tolist() == [[128], [32], [128]]


def test_awkward_rows(spark):
    target = spark.createDataFrame([("lorem ipsum",)], "text string")
    docs = [(r[0], r[1]) for r in AWKWARD]
    got = found(resampled(clashing(spark), target, percent=100, least_words=0))
    want = plain(docs, ["lorem ipsum"], 0, 0)
    assert Counter(r[:5] for r in got.elements()) == Counter(r[:5] for r in want.elements())
    assert sorted(r[5] for r in got.elements()) == list(range(1, len(docs) + 1))
    assert resampled(nothing(spark), target).count() == 0


def test_one_row_that_fills_the_table(spark):
    rows = spark.range(3_000).selectExpr("7L AS doc_id", "repeat('word ', 20) AS text")
    ranks = sorted(r.rank for r in resampled(rows, awkward(spark)).where("rank IS NOT NULL").collect())
    assert ranks == list(range(1, 301))
