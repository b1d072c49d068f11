import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from plantpulse.llm.class_lm import (
    Items, _by_number, _from_planes, _numbered_texts, _packed, _planes, _unpacked, block_pairs, class_pairs, clustered, exchange,
    gains, item_bigrams, item_pairs, key_of_group, label_pairs, looked_up, moved, numbered, part_entries, perplexity, scored,
    tokens, trained, vocabulary, word_counts, word_pairs, word_parts, worth)
from plantpulse.llm.queries import queries

from .helpers import AWKWARD, FOLDER, clashing, nothing, table


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


@pytest.fixture(scope="module")
def result(spark):
    return queries()["op8_class_lm"](spark, FOLDER).cache()


def test_counts_and_base_score(result):
    docs = table("documents")
    counts = Counter(w for d in docs if fold(d["doc_id"]) != 1 for w in tokens(d["text"]))
    n, text = sum(counts.values()), {d["doc_id"]: d["text"] for d in docs}
    size = math.log10(n + 0.5 * (len(counts) + 1))
    rows = result.collect()
    assert len(rows) == len(docs)
    for r in rows:
        own = tokens(text[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in counts for w in own), n)
        assert r.held_out == (fold(r.doc_id) == 1)
        assert r.base_score == pytest.approx(sum(math.log10(counts[w] + 0.5) - size for w in own))


def test_better_than_the_base(result):
    got = {r.held_out: r for r in perplexity(result).collect()}
    assert all(r.model < 0.8 * r.base for r in got.values())


@pytest.mark.parametrize("frequent", [50_000, 40, 0])
def test_score_equals_plain_version_and_is_a_distribution(spark, monkeypatch, frequent):
    """Also where most words, or all of them, have to be looked up by the join."""
    monkeypatch.setattr("plantpulse.llm.class_lm.FREQUENT", frequent)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).cache()
    model, known = trained(docs, classes=8, words=30, groups=20, least_count=3)
    rows = {r.doc_id: (r.text, fold(r.doc_id) != 1) for r in docs.collect()}
    counts = Counter(w for t, train in rows.values() if train for w in tokens(t))
    found = {bytes(r.word): (r.n, r["class"]) for r in known.collect()}
    assert {w: n for w, (n, _) in found.items()} == counts
    assert len(model.frequent) <= frequent
    ending = {w: int(model.ending_class[model.items.group(w)]) for t, _ in rows.values() for w in tokens(t) if w}
    # Rare words keep to their ending's class, words of their own may leave it, and some do.
    assert all(found[w][1] == ending[w] for w, n in counts.items() if n < 3)
    assert any(found[w][1] != ending[w] for w, n in counts.items() if n >= 3 and w and w not in model.items.own)
    end = len(model.step) - 1
    assert [w for w, (_, c) in found.items() if c == end] == [b""]
    label = {**ending, **{w: c for w, (_, c) in found.items()}}
    pairs, sizes, types = np.zeros((8, 8)), np.zeros(8), np.zeros(8)
    for t, train in rows.values():
        line = [label[w] for w in tokens(t)] if train else []
        for a, b in zip([end, *line], line):
            pairs[a, b] += 1
    for w, n in counts.items():
        sizes[label[w]] += n
        types[label[w]] += 1
    share = (sizes + 1) / (sizes.sum() + 8)
    move = (pairs + 200 * share) / (pairs.sum(axis=1, keepdims=True) + 200)
    assert np.allclose(move.sum(axis=1), 1.0)
    spare = np.array([any(model.ending_class == c) for c in range(8)])
    below = sizes + 0.5 * (types + spare)
    # Known words and one unknown word for each class that can have one.
    assert np.allclose((sizes + 0.5 * types + 0.5 * spare)[below > 0] / below[below > 0], 1.0)
    scores = scored(docs, model, known).collect()
    assert len(scores) == len(rows)
    for r in scores:
        line = tokens(rows[r.doc_id][0])
        classes = [label[w] for w in line]
        want = sum(math.log10(move[a, b] * (counts[w] + 0.5) / below[b]) for a, b, w in zip([end, *classes], classes, line))
        assert r.score == pytest.approx(want)
        assert r.n_known == sum(w in counts for w in line)


def test_gains_are_what_a_move_changes():
    rng = np.random.default_rng(3)
    bigrams = rng.poisson(0.8, (30, 30)).astype(float)
    label = np.append(rng.integers(0, 5, 29), 5)
    one = np.eye(6)[label]
    pairs = one.T @ bigrams @ one
    self_ = np.diag(bigrams)[:29].copy()
    right, left = (bigrams @ one)[:29], (bigrams.T @ one)[:29]
    right[np.arange(29), label[:29]] -= self_
    left[np.arange(29), label[:29]] -= self_
    got = gains(pairs, label[:29], right, left, self_)
    assert np.isneginf(got[:, 5]).all()
    for w in range(29):
        for c in range(5):
            there = np.eye(6)[np.where(np.arange(30) == w, c, label)]
            change = worth(there.T @ bigrams @ there) - worth(pairs)
            assert got[w, c] - got[w, label[w]] == pytest.approx(change, abs=1e-8)


def test_word_pairs(spark, monkeypatch):
    docs = spark.createDataFrame([("a b x",), ("B",), (None,), ("a b",)], "text string").coalesce(1)
    want = {(b"", b"a"): 2, (b"a", b"b"): 2, (b"b", b"x"): 1, (b"x", b""): 1, (b"", b"b"): 1, (b"b", b""): 2, (b"", b""): 1}
    for most in (2_000_000, 2):  # also handed on in small parts
        monkeypatch.setattr("plantpulse.llm.class_lm._TOKENS", most)
        got = Counter()
        for r in word_pairs(docs, Items({}, 1)).collect():
            got[bytes(r["first"]), bytes(r["second"])] += r.n
        assert got == want
    items = Items({}, 1)
    words = vocabulary(word_counts(docs), items, 2)
    got = {(bytes(r["first"]), bytes(r["second"])): r.n for r in item_pairs(docs, words, items).collect()}
    assert got == {tuple(key_of_group(0) if w == b"x" else w for w in k): n for k, n in want.items()}


def test_passes_raise_the_likelihood_and_find_planted_classes(spark):
    """Three kinds of words in turn; every word starts in a class by chance and ends with its kind."""
    rng = np.random.default_rng(1)
    texts = [" ".join(f"{'abc'[i % 3]}{rng.integers(0, 40)}" for i in range(60)) for _ in range(200)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    items = Items({}, 1)
    words = vocabulary(word_counts(docs), items, 1).cache()
    pairs = item_pairs(docs, words, items).cache()
    start = spark.createDataFrame([
        (bytearray(w), 3 if not w else int(rng.integers(0, 3))) for w in sorted(bytes(r.item) for r in words.collect())],
        "item binary, class int")
    before = class_pairs(pairs, start, 4)
    labels, folder, after = clustered(pairs, start, 4, 0.001)
    assert worth(after) > worth(before) and (class_pairs(pairs, labels, 4) == after).all() and folder
    label = {bytes(r["item"]): r["class"] for r in labels.collect()}
    assert len(label) == words.count() and label[b""] == 3
    kinds = {k: Counter(c for w, c in label.items() if w.startswith(k)) for k in (b"a", b"b", b"c")}
    assert len({c.most_common(1)[0][0] for c in kinds.values()}) == 3
    assert all(c.most_common(1)[0][1] >= 38 for c in kinds.values())


def test_no_single_move_is_better():
    def worth(bigrams, label, k):
        one = np.eye(k)[label]
        pairs = one.T @ bigrams @ one
        f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return f(pairs) - f(pairs.sum(axis=0)) - f(pairs.sum(axis=1))

    rng = np.random.default_rng(0)
    bigrams = rng.integers(0, 6, (25, 25))
    bigrams[:8, 8:16] += 20
    bigrams[8:16, 16:24] += 20
    label = exchange(bigrams, 5, passes=50)
    best = worth(bigrams, label, 5)
    for w in range(24):
        for c in range(4):
            assert worth(bigrams, np.where(np.arange(25) == w, c, label), 5) <= best + 1e-6


def test_exchange_goes_on_until_nothing_moves():
    bigrams = np.random.default_rng(0).poisson(0.3, (250, 250))
    label = exchange(bigrams, 6)
    assert (label == exchange(bigrams, 6, passes=1000)).all()
    assert (label != exchange(bigrams, 6, passes=12)).any()


def test_bigrams(spark):
    items = Items({b"a": 0, b"b": 1}, 1)
    docs = spark.createDataFrame([("a b x",), ("B",), (None,)], "text string")
    want = np.zeros((4, 4))
    for pair in ((3, 0), (0, 1), (1, 2), (2, 3), (3, 1), (1, 3), (3, 3)):
        want[pair] += 1
    assert (item_bigrams(docs, items) == want).all()


def test_awkward_rows(spark):
    docs = clashing(spark)
    rows = scored(docs, *trained(docs)).collect()
    assert len(rows) == len(AWKWARD) and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert scored(nothing(spark), *trained(nothing(spark))).count() == 0
    unseen = docs.where("crc32(cast(doc_id AS string)) % 5 = 1")
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in scored(unseen, *trained(unseen)).collect())


def test_blocks_hold_all_pairs_and_a_pass_moves_the_items_to_their_best_classes(spark, monkeypatch):
    """In several parts and blocks; words are joined once for each part, and no longer for each pair."""
    monkeypatch.setattr("plantpulse.llm.class_lm._ITEMS", 7)
    monkeypatch.setattr("plantpulse.llm.class_lm._TOKENS", 300)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(rng.integers(0, 6)) ** 2 + rng.integers(0, 3)}" for _ in range(40)) for _ in range(60)] + ["w1 w1 w1", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3).cache()
    parts = word_parts(docs).cache()
    words = {bytes(r.word): r.n for r in parts.groupBy("word").agg({"n": "sum"}).toDF("word", "n").collect() if r.word is not None}
    assert words == {bytes(r.word): r.n for r in word_counts(docs).collect()}
    assert parts.where("word IS NOT NULL").count() < item_pairs(
        docs, vocabulary(word_counts(docs), Items({}, 1), 1), Items({}, 1)).count()
    items, blocks = numbered(word_counts(docs).selectExpr("word AS item", "cast(if(word = X'', 3, crc32(word) % 3) AS int) AS class"))
    items = items.cache()
    assert blocks > 2
    pairs = block_pairs(part_entries(parts, items.selectExpr("item AS word", "id"), blocks), items, blocks).cache()
    rows = {r.id: (bytes(r["item"]), r["class"]) for r in items.collect()}
    size = max(rows) + 1
    place = {w: i for i, (w, _) in rows.items()}
    want = np.zeros((size, size))
    for t in texts:
        line = [place[w] for w in tokens(t)]
        for a, b in zip([place[b""], *line], line):
            want[a, b] += 1
    assert (label_pairs(pairs, blocks, np.arange(size), size) == want).all()
    label = _by_number(items, "class", 4)
    one = np.eye(4)[label]
    now = label_pairs(pairs, blocks, label, 4)
    assert (now == one.T @ want @ one).all()
    self_, every = np.diag(want).copy(), np.arange(size)
    right, left = want @ one, want.T @ one
    right[every, label] -= self_
    left[every, label] -= self_
    gain = gains(now, label, right, left, self_)
    best = gain.argmax(axis=1)
    for turn, shares in ((0, 4), (3, 4), (6, 4), (17, 16), (0, 1)):
        free = items.where(f"pmod(xxhash64(item, {turn // shares}) + {turn}, {shares}) = 0").collect()
        want_moves = {r.id: int(best[r.id]) for r in free if rows[r.id][0] and gain[r.id].max() > gain[r.id, label[r.id]] + 1e-6}
        assert {r.id: r["class"] for r in moved(pairs, blocks, label, now, turn, shares).collect()} == want_moves
    assert want_moves


def test_numbers_are_packed_and_read_again():
    rng = np.random.default_rng(2)
    for x in ([], [0], [-1, 255], [2**31 - 1, 0], [70_000, -5], [-2**63, 2**63 - 1], rng.integers(-2**62, 2**62, 500).tolist()):
        assert _from_planes(_planes(np.array(x, dtype=np.int64))).tolist() == x
    own, other, n = np.sort(rng.integers(0, 9_000, 5_000)), rng.integers(0, 2**31, 5_000), rng.zipf(2.0, 5_000) % 70_000
    data = _packed(own, other, n)
    assert all((a == b).all() for a, b in zip(_unpacked(data), (own, other, n)))
    # Two bytes, four and a few of a count; the least that 16 bytes of each entry were packed to was more.
    assert len(data) < 7.5 * len(own)


def test_texts_are_numbered_as_tokens_has_them():
    """In one part or many: all words, also between odd spaces, and an end token after each text."""
    texts = ["  AÉb\x0b\x0cc \x1c\x85 d\x00e\r\n", None, "", " \t ", "Z z", "z" * 100, "x y " * 50, "É  İ"]
    batch = pa.RecordBatch.from_arrays([pa.array([*range(7), None], pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    for most in (2_000_000, 20, 1):
        ids, got, parts = [], [], 0
        for (own,), words, line in _numbered_texts(iter([batch, batch.slice(2, 3)]), most):
            names = words.to_pylist()
            assert names[0] == b"" and len(set(names)) == len(names)
            ids, got, parts = ids + own.to_pylist(), got + [names[i] for i in line], parts + 1
        assert ids == [*range(7), None, 2, 3, 4]
        assert got == [w for t in [*texts, *texts[2:5]] for w in tokens(t)]
        assert (parts == 1) == (most > 1_000)


def test_words_are_joined_once_for_each_part_and_not_for_each_text(spark, monkeypatch):
    """What the scan asks the table for does not grow with how often a part's texts hold a word."""
    monkeypatch.setattr("plantpulse.llm.class_lm.FREQUENT", 0)
    asked = []

    def kept(parts, table):
        asked.append(parts.where("word IS NOT NULL").count())
        return looked_up(parts, table)

    docs = spark.createDataFrame([(i, "one two three four two one") for i in range(50)], "doc_id long, text string").coalesce(1).cache()
    model, known = trained(docs)
    monkeypatch.setattr("plantpulse.llm.class_lm.looked_up", kept)
    rows = scored(docs, model, known).collect()
    assert len(rows) == 50 and all((r.n_tokens, r.n_known) == (7, 7) for r in rows) and len({r.score for r in rows}) == 1
    assert asked == [5]
