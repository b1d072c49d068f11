import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plantpulse.llm.queries import queries
from plantpulse.llm.token_counts import BytePairCounter, count_after_merging, token_counts

from .helpers import AWKWARD, FOLDER, SCHEMA, awkward, clashing, large_ids, nothing, rows, table

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    with open(PATH, encoding="utf-8") as file:
        return BytePairCounter(file.read())


def test_random_texts(library, counter):
    draw = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "a", "the", "'s", "'ll", "1", "½", "é", "日本", "\U0001f600", "<|endoftext|>",
             "!", "?!", " ", "​", "　", "x" * 50, "́", "\x00", " Word."]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(3000)]
    texts += ["a" * 20_000, " " * 3000, "ab" * 5000]
    assert [counter(t) for t in texts] == library(texts)


def test_merges_by_rank_then_from_the_left():
    # (1, 1) -> 2 before (2, 1) -> 3
    merges = {1 << 16 | 1: 0 << 16 | 2, 2 << 16 | 1: 1 << 16 | 3}
    assert count_after_merging([1, 1, 1], dict(merges)) == 1
    assert count_after_merging([1, 1, 1, 1], dict(merges)) == 2
    assert count_after_merging([], merges) == 0


def test_query_equals_library(spark, library):
    docs = table("documents")
    want = dict(zip([d["doc_id"] for d in docs], library([d["text"] or "" for d in docs])))
    got = queries()["op4_token_counts"](spark, FOLDER).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_awkward_rows(spark, library):
    got = rows(token_counts(awkward(spark), PATH))
    texts = [r[1] or "" for r in AWKWARD]
    want = [(r[0], len(t.encode()), n, n > 512) for r, t, n in zip(AWKWARD, texts, library(texts))]
    assert got == sorted(want, key=repr)
    assert rows(token_counts(clashing(spark), PATH)) == got
    assert token_counts(nothing(spark), PATH).count() == 0


def test_large_ids_stay_as_they_are(spark):
    docs = large_ids()
    got = token_counts(spark.createDataFrame(docs, SCHEMA).coalesce(1), PATH).collect()
    assert sorted(map(repr, [r.doc_id for r in got])) == sorted(repr(d[0]) for d in docs)
