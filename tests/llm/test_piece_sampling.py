from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from plantpulse.llm.common import ready
from plantpulse.llm.piece_sampling import Lattices, Sampler, Vocabulary, decoded, normalised, segmentations
from plantpulse.llm.queries import queries

from .helpers import AWKWARD, FOLDER, clashing, nothing, table

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return file.read()


def every_path(model, vocabulary, word):
    """All segmentations of a word with their probabilities."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = {p: i for i, p in enumerate(vocabulary.pieces) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    out = {}

    def grow(at, path, weight):
        if at == len(word):
            out[tuple(path)] = weight
        for end in range(at + 1, len(word) + 1):
            i = ids.get(word[at:end])
            if i is not None:
                grow(end, [*path, i], weight + max(vocabulary.worst, -np.log(1 - min(sp.get_score(i), 0))))

    grow(0, [], 0.0)
    whole = np.logaddexp.reduce(list(out.values()))
    return {k: float(np.exp(w - whole)) for k, w in out.items()}


def test_samples_without_replacement(model):
    sampler, n = Sampler(model, 3, 1), 8000
    real = every_path(model, sampler.vocabulary, "▁hated")
    first, second, weighed = Counter(), Counter(), Counter()
    for _, rank, pieces, log_prob, _, inclusion in sampler(list(range(n)), ["hated"] * n):
        key = tuple(pieces.tolist())
        assert abs(log_prob - np.log(real[key])) < 1e-9
        first[key] += rank == 1
        second[key] += rank == 2
        weighed[key] += 1 / np.exp(inclusion) / n
    after = {b: sum(real[a] * real[b] / (1 - real[a]) for a in real if a != b) for b in real}
    assert sum(abs(first[k] / n - p) for k, p in real.items()) / 2 < 0.03
    assert sum(abs(second[k] / n - p) for k, p in after.items()) / 2 < 0.03
    # Weighing each sample by one over its inclusion score counts every likely path once.
    assert all(abs(weighed[k] - 1) < 0.15 for k, p in real.items() if p > 0.02)


def test_all_paths_come_if_asked_for(model):
    sampler = Sampler(model, 500, 2)
    real = every_path(model, sampler.vocabulary, "▁hated")
    got = list(sampler([9], ["hated"]))
    assert {tuple(r[2].tolist()) for r in got} == set(real) and len(got) == len(real)
    values = [r[4] for r in got]
    assert values == sorted(values, reverse=True) and all(r[5] == 0.0 for r in got)


def test_a_row_gives_the_same_in_any_company(model):
    texts = [d["text"] for d in table("documents")[:30]]
    together = [(r[0], r[1], r[2].tobytes()) for r in Sampler(model, 2, 5)(list(range(30)), texts)]
    sampler, alone = Sampler(model, 2, 5), []
    for i in reversed(range(30)):
        alone += [(i, r[1], r[2].tobytes()) for r in sampler([i], [texts[i]])]
    assert sorted(together) == sorted(alone)
    assert len(set(together)) == 60


def test_round_trips(model):
    sampler = Sampler(model, 3, 5)
    for text in ["", " ", "a", "  two  blanks ", "日本語 \U0001f600\n\n é\t x▁y", "q" * 3000, "\x00�", "r\r\n;\r"]:
        found = list(sampler([7], [text]))
        assert found and all(sampler.vocabulary.decode(r[2]) == normalised(text) for r in found)
        assert len({r[2].tobytes() for r in found}) == len(found)


def test_query(spark):
    rows = queries()["op5_piece_sampling"](spark, FOLDER).collect()
    docs = table("documents")
    assert {r.doc_id for r in rows} == {d["doc_id"] for d in docs} and all(r.round_trip for r in rows)


def test_awkward_rows(spark):
    out = segmentations(clashing(spark), PATH)
    rows = out.collect()
    assert all(r.round_trip for r in rows) and len({r.doc_id for r in rows}) == 8
    assert sum(len(r.pieces) == 0 for r in rows) == sum(not r[1] for r in AWKWARD)
    texts = Counter(r.text for r in decoded(out.where("sample = 1"), PATH).collect())
    assert texts == Counter((r[1] or "").replace("▁", " ") for r in AWKWARD)
    assert segmentations(nothing(spark), PATH).count() == 0


def test_edges_are_placed_without_sorting_them(model, monkeypatch):
    """Only the characters are put in an order; every node's edges are still side by side, with shares that add up to one."""
    sampler = Sampler(model, 2, 5)
    words = [" international", " 日本語", "\n", " x" + "y" * 40, " of", " €uro"]
    sizes, plain = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, *args, **kwargs: sizes.append(len(x)) or plain(x, *args, **kwargs))
    sampler.lattices.add(words)
    count = sum(map(len, words))
    assert sampler.lattices.edges > count and max(sizes) <= count
    for node in range(count):
        a, b = sampler.lattices.first[node], sampler.lattices.first[node + 1]
        shares = np.exp(sampler.lattices.logs[a:b])
        assert b > a and shares.sum() == pytest.approx(1.0) and shares[0] == shares.max()
        reach = sampler.lattices.reach[a:b]
        assert (np.diff(reach) >= 0).all() and reach[-1] == node + 1


def test_a_full_worker_starts_anew_in_the_same_arrays(spark, model):
    """New arrays beside the old ones, and batches of 10,000 texts, took an executor beyond its memory."""
    lattices = Lattices(Vocabulary(model))
    arrays = [lattices.reach, lattices.logs, lattices.target, lattices.piece, lattices.first]
    text = [" one", " two", " three"]
    drawn = lattices.walk(lattices.roots([text])[0], np.arange(3, dtype=np.uint64))
    lattices.clear()
    assert lattices.root == {} and not lattices.edges
    assert all(a is b for a, b in zip(arrays, [lattices.reach, lattices.logs, lattices.target, lattices.piece, lattices.first]))
    again = lattices.walk(lattices.roots([text])[0], np.arange(3, dtype=np.uint64))
    assert all((a == b).all() for a, b in zip(drawn, again))
    assert int(ready(spark).conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2_000
