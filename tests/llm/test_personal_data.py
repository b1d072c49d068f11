import hashlib
import random
import re

import numpy as np
import pytest

from plantpulse.llm.personal_data import (
    KINDS, Field, all_spans, base_spans, chains, examples, redacted, token_features, trained, with_spans, written_spans)
from plantpulse.llm.queries import queries

from .helpers import AWKWARD, FOLDER, awkward, clashing, nothing, table

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def sound(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(p) <= 255 for p in text.split("."))
    if kind == 2:
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == 0 or 10 <= len(digits) <= 15


def plain(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if sound(k, m[0]))


@pytest.fixture(scope="module")
def field(spark):
    return trained(examples(spark))


def test_base_spans_equal_the_patterns():
    draw = random.Random(3)
    parts = ["a", "@", ".", "b.c", "1", "12", "255", "999", "+1", " ", "-", "(", "4111 1111 1111 1111", "x@y.z", "+", "é", "٣"]
    for _ in range(8000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert base_spans(text) == plain(text), text


def test_query(spark):
    docs = {d["doc_id"]: d["text"] or "" for d in table("documents")}
    got = queries()["op1_personal_data"](spark, FOLDER).collect()
    assert len(got) == len(docs)
    for r in got:
        base = plain(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(written_spans(base).encode()).hexdigest()
        assert set(written_spans(base).split(",")) <= set(r.spans.split(","))


def test_held_out_sentences(spark, field):
    rows = examples(spark, 200, seed=99).collect()
    right = 0
    for r in rows:
        # Exact spans, by the field alone.
        found = []
        tokens = chains(r.text)
        for own, labels in zip(tokens, field.decode([token_features(r.text, c) for c in tokens])):
            for i, y in enumerate(labels):
                kind = (int(y) - 1) // 2
                if y and (i == 0 or labels[i - 1] == 0 or y % 2 == 1):
                    found.append([own[i][0], kind, own[i][1]])
                elif y:
                    found[-1][2] = own[i][1]
        right += ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found) == r.spans
    assert right >= 0.95 * len(rows)


def test_finds_what_the_patterns_miss(field):
    text = "please ring (269) 555-3296 today, or +1 (269) 555-3296 4524132264652876 for the card"
    base, spans = all_spans([text], field)[0]
    assert base == []
    assert "(269) 555-3296" in [text[a:b] for a, _, b in spans]
    assert all_spans(["version 2.0 of 2024-01-02, 12 of 345, no. 99999"], field)[0] == ([], [])


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(0)
    field = Field({"a": 0, "b": 1}, np.vstack([rng.normal(size=(2, 3)), np.zeros(3)]), rng.normal(size=(3, 3)), rng.normal(size=3))
    texts = [[["a"], ["b"], ["?"], ["a"]], [["b"]], [["a"], ["a"]]]
    for got, chain in zip(field.decode(texts), texts):
        emit = field.emit[field.rows(chain)].sum(axis=1)
        paths = np.stack(np.meshgrid(*[range(3)] * len(chain), indexing="ij"), -1).reshape(-1, len(chain))
        score = [field.begin[p[0]] + sum(emit[i, y] for i, y in enumerate(p)) + sum(field.move[a, b] for a, b in zip(p, p[1:])) for p in paths]
        assert got.tolist() == paths[int(np.argmax(score))].tolist()


def test_awkward_rows(spark, field):
    assert with_spans(clashing(spark), field).count() == len(AWKWARD)
    assert with_spans(nothing(spark), field).count() == 0
    out = redacted(clashing(spark), field)
    assert out.columns == clashing(spark).columns
    rows = out.collect()
    assert sum(r.text == "Write to [EMAIL] now" and r.n_chars == 20 for r in rows) == 2
    assert sum(r.text is None for r in rows) == 2 and sum(r.text == "" for r in rows) == 1
    assert sorted(r.text for r in redacted(awkward(spark), field).where("doc_id = 5").collect()) == ["x" * 150_000]


def test_very_long_texts(field):
    for text in ("a" * 200_000, "1" * 200_000, "1." * 5000, "a@" * 5000):
        assert all_spans([text], field)[0][0] == base_spans(text)
