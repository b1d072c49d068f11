import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from plantpulse.llm.queries import queries
from plantpulse.llm.sketches import (
    containment, distinct_count, edited_likeness, fingerprints, merge_by, merged, read, resemblance, sketch, written)

from .helpers import AWKWARD, FOLDER, SCHEMA, awkward, clashing, large_ids, nothing, table


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_equals_plain_version(spark):
    docs = sorted((d["doc_id"], d["text"] or "") for d in table("documents"))
    after = {docs[i][0]: docs[(i + 1) % len(docs)][1] for i in range(len(docs))}
    text = dict(docs)
    got = queries()["op2_sketches"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == [d for d, _ in docs]
    errors = []
    for r in got:
        own = text[r.doc_id]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[r.doc_id][:half]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (written(sketch(own)), written(sketch(edited)))
        errors += [r.near_edited - likeness(own, edited), r.near_next - likeness(own, after[r.doc_id])]
    assert np.sqrt(np.mean(np.square(errors))) < 0.03


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcdefg"), max_size=60), st.lists(st.sampled_from("abcdefg"), max_size=60))
def test_exact_while_small_and_mergeable(a, b):
    a, b = " ".join(a), " ".join(b)
    x, y = sketch(a), sketch(b)
    assert abs(resemblance(x, y) - likeness(a, b)) < 1e-9
    assert distinct_count(x) == len(shingles(a))
    assert set(merged(x, y)) == set(x) | set(y)
    assert (read(written(x)) == x).all()
    if shingles(a):
        assert abs(containment(x, y) - len(shingles(a) & shingles(b)) / len(shingles(a))) < 1e-9


def test_estimates_and_repeated_shingles():
    x = [f"w{i}" for i in range(6000)]
    a, b = sketch(" ".join(x[:4000]), 1), sketch(" ".join(x[2000:]), 1)
    assert abs(resemblance(a, b) - 1 / 3) < 0.1 and abs(containment(a, b) - 0.5) < 0.15
    assert (merged(a, b) == sketch(" ".join(x), 1)).all()
    assert abs(distinct_count(merged(a, b)) / 6000 - 1) < 0.2
    assert len(sketch("a b c d e f " * 5000)) == 6


def test_parts_of_a_key_merge(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(7)
    got = {r.lang: r.fingerprint for r in merge_by(fingerprints(docs), "lang").collect()}
    want = {}
    for d in table("documents"):
        own = sketch(d["text"] or "")
        want[d["lang"]] = merged(want[d["lang"]], own) if d["lang"] in want else own
    assert got == {k: written(v) for k, v in want.items()}


def test_awkward_rows(spark):
    for slices in (1, 3, 50):
        rows = edited_likeness(clashing(spark), slices=slices).collect()
        assert sorted(map(repr, [r.doc_id for r in rows])) == sorted(map(repr, [r[0] for r in AWKWARD]))
    same = [r for r in rows if r.doc_id == 1]
    assert len(same) == 3 and len({r.fingerprint for r in same}) == 2
    assert edited_likeness(nothing(spark)).count() == 0
    one = edited_likeness(awkward(spark).where("doc_id = 6")).collect()
    assert one[0].near_next == 1.0


def test_large_ids_stay_as_they_are(spark):
    docs = large_ids()
    df = spark.createDataFrame(docs, SCHEMA).coalesce(2)
    order = sorted(((d[0], d[1]) for d in docs if d[0] is not None))
    for slices in (None, 13, 700):
        rows = edited_likeness(df, slices=slices).collect()
        assert sorted(map(repr, [r.doc_id for r in rows])) == sorted(repr(d[0]) for d in docs)
        text, got = dict(order), {r.doc_id: r for r in rows}
        for (i, own), (j, _) in zip(order, order[1:]):
            half = len(own) // 2
            edited = own[: len(own) - half] + text[j][:half]
            assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_one_id_with_most_rows(spark):
    rows = [(5, f"text {i % 40} of a busy id", "en", "a", 0) for i in range(2_000)] + [(i, f"quiet {i}", "en", "a", 0) for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    for slices in (1, 16):
        got = Counter(r.doc_id for r in edited_likeness(df, slices=slices).collect())
        assert got == Counter(r[0] for r in rows)
