import numpy as np
import pytest

from plantpulse.llm.common import read
from plantpulse.llm.queries import queries
from plantpulse.llm.toxicity import Scorer, features, fit, learned, raw_words, scored, windows, without_toxic

from .helpers import AWKWARD, FOLDER, awkward, clashing, nothing

INSULTS = ["grumbol", "zotterkin", "vaxnarod"]


def bags(n, seed):
    rng = np.random.default_rng(seed)
    sounds = ["ta", "re", "mi", "lo", "sun", "ber", "ol", "kan"]
    texts, toxic = [], rng.random(n) < 0.25
    for bad in toxic:
        words = ["".join(rng.choice(sounds, int(rng.integers(1, 4)))) for _ in range(40)]
        if bad:
            words[int(rng.integers(40))] = str(rng.choice(INSULTS)) + str(rng.choice(sounds))
        texts.append(" ".join(words))
    return texts, toxic


@pytest.fixture(scope="module")
def machine():
    texts, toxic = bags(1200, 0)
    return fit([sorted({u for w in raw_words(t) for u in windows(w) if len(u) >= 3}) for t in texts], toxic)


def test_held_out(machine):
    texts, toxic = bags(600, 1)
    assert ((Scorer(machine)(texts) >= 0.5) == toxic).mean() > 0.98


def test_gaps_and_marks(machine):
    score = Scorer(machine)
    bad = ["grumbol", "GRUMBOL!!", "g-r-u-m-b-o-l", "g r u m b o l", "grumxbol", "grummbol", "talomi" * 4 + "zotterkin" + "sunreol" * 4]
    good = ["tamire", "lo sun ber", "", "a b c d", "tagrumi"]
    assert (score([f"tare milo {w} sunber" for w in bad]) >= 0.5).all()
    assert (score([f"tare milo {w} sunber" for w in good]) < 0.5).all()


def test_kernel_features_equal_the_definition():
    def plain(word):
        out = {}
        for i in range(len(word)):
            for k in range(i + 2, min(len(word), i + 7)):
                for j in range(i + 1, k):
                    t = word[i] + word[j] + word[k]
                    out[t] = out.get(t, 0.0) + 0.75 ** (k - i + 1)
        return out

    words = ["banana", "abc", "aaaaaa", "abcabcabc"]
    got = {}
    for where, codes, weight in features(words):
        for r, w in enumerate(where):
            got[words[w]] = sorted(x for x in weight[r] if x > 1e-12)
    for w in words:
        own = np.array(sorted(plain(w).values()))
        assert np.allclose(got[w], own / np.sqrt((own**2).sum()))


def test_labels_of_one_kind_and_no_labels():
    for toxic, share in ((np.zeros(5, bool), 0.0), (np.ones(5, bool), 1.0)):
        score = Scorer(fit([["abc"]] * 5, toxic))(["abc", "", None])
        assert np.allclose(score, share, atol=1e-5)
    assert Scorer(fit([], np.empty(0, bool)))(["abc"])[0] < 0.5


def test_query_does_not_see_held_out_labels(spark):
    docs, labels = read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = learned(docs, labels), learned(docs, flipped)
    assert (a.weights == b.weights).all() and (a.bias, a.slope, a.middle) == (b.bias, b.slope, b.middle)
    rows = queries()["op7_toxicity"](spark, FOLDER).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_awkward_rows(spark, machine):
    assert scored(awkward(spark), machine).count() == len(AWKWARD)
    assert scored(nothing(spark), machine).count() == 0
    kept = without_toxic(clashing(spark), machine)
    assert kept.columns == clashing(spark).columns and kept.count() == len(AWKWARD)
    assert {r.toxicity for r in kept.collect()} == {"mine"}
    bad = spark.createDataFrame([(1, "you grumbol"), (2, "tare milo")], "doc_id long, text string")
    assert [r.doc_id for r in without_toxic(bad, machine).collect()] == [2]


def test_empty_tables(spark):
    labels = spark.createDataFrame([(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    machine = learned(awkward(spark), labels)
    assert all(r.toxicity < 0.5 for r in scored(awkward(spark), machine).collect())


def test_sample_is_bounded_and_has_both_kinds(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('tare milo w', id) AS text")
    labels = spark.range(20_000).selectExpr("id AS doc_id", "1 AS quality", "cast(id % 4 = 0 AS int) AS toxic")
    seen = {}
    import plantpulse.llm.toxicity as module

    old, module.fit = module.fit, lambda bags, toxic: seen.update(n=len(bags), toxic=int(toxic.sum()))
    try:
        learned(docs, labels, sample=300)
    finally:
        module.fit = old
    assert seen == {"n": 300, "toxic": 100}


def units(texts):
    return [sorted({u for w in raw_words(t) for u in windows(w) if len(u) >= 3}) for t in texts]


def test_one_mislabelled_document_for_each_insult():
    texts, toxic = bags(1200, 5)
    for insult in INSULTS:
        toxic[next(i for i, t in enumerate(texts) if toxic[i] and insult in t)] = False
    made = fit(units(texts), toxic)
    held, truth = bags(600, 6)
    assert ((Scorer(made)(held) >= 0.5) == truth).mean() > 0.98


def test_repeated_ids_are_learnt_from_once(spark):
    docs = spark.range(4_000).selectExpr("id % 40 AS doc_id", "concat('tare milo w', id % 80) AS text")
    labels = spark.range(40).selectExpr("id AS doc_id", "1 AS quality", "cast(id % 4 = 0 AS int) AS toxic")
    seen = {}
    import plantpulse.llm.toxicity as module

    old, module.fit = module.fit, lambda bags, toxic: seen.update(n=len(bags))
    try:
        learned(docs, labels, sample=300)
    finally:
        module.fit = old
    assert seen["n"] == len({i for i in range(40) if __import__("zlib").crc32(str(i).encode()) % 5})


def test_score_equals_a_plain_version(machine):
    def margin(word):
        weight = {}
        letters = [ord(c) - 97 if "a" <= c <= "z" else ord(c) - 22 if c.isdigit() and c.isascii() else 36 + ord(c) % 25 for c in word]
        for i in range(len(word)):
            for k in range(i + 2, min(len(word), i + 7)):
                for j in range(i + 1, k):
                    t = (letters[i] * 61 + letters[j]) * 61 + letters[k]
                    weight[t] = weight.get(t, 0.0) + 0.75 ** (k - i + 1)
        norm = sum(w * w for w in weight.values()) ** 0.5
        return machine.bias + (sum(machine.weights[t] * w for t, w in weight.items()) / norm if weight else 0.0)

    texts, _ = bags(40, 9)
    for text in [*texts, "", "a b", "Éa-grumbol? ß", "y" * 40]:
        words = [u for w in raw_words(text) for u in windows(w)]
        worst = max((margin(w) for w in words), default=machine.bias)
        want = 1 / (1 + np.exp(-np.clip(machine.slope * (worst - machine.middle), -40, 40)))
        assert abs(Scorer(machine)([text])[0] - want) < 1e-6
