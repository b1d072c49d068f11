"""Toxicity by a support vector machine with a subsequence string kernel.

The kernel of two words sums, over the letter triples that both contain in order, a weight that decays
with the gaps; it is normalised by both words' own kernels. So an insult with letters put in
between, or with another ending, stays close to the insult. Landmark words turn the kernel into
features (Nyström), and a linear support vector machine is trained on them. As it is linear in the
kernel with the landmarks, and these are fixed, the whole machine folds into one weight for each triple:
scoring a word is a weighted sum over its own triples.

Labels are on documents, while one word makes a document toxic. Training is therefore on instances: a
toxic document answers for its most telling word, all words of the clean ones are clean. The most
telling word is looked for again with each machine. A document scores as its worst word, and a
logistic curve fitted on labelled documents kept apart turns that into 0 to 1.

Words are cut at white space; marks inside them are dropped (``i-d-i-o-t``), letters standing alone in a row
are put together (``i d i o t``), and long ones are read in overlapping windows, so a blob of any
length is read whole.

Cases: a NULL or empty text scores as one without any triple; documents without a label are not learnt
from, nor are rows with a NULL label or id; of rows that share an id one is learnt from; with labels of one kind only, every document gets that
share as its score; repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.common import Recent, fold, kept, text_key

#: Kinds of letters: a-z, 0-9, and all others in 25 classes by code point. A triple of them is a feature.
LETTERS = 61
_KIND = np.array([
    c - 97 if 97 <= c < 123 else c - 22 if 48 <= c < 58 else 36 + c % 25 for c in range(0x3000)], dtype=np.int64)
SPAN = 7
DECAY = 0.75
#: Longest word that is read as one, and how longer ones are cut.
WINDOW = 16
PART = 12
STEP = 4
#: Words whose scores a Python worker remembers; bounds its memory only.
REMEMBERED = 200_000
#: Toxic documents of a word for each clean one it may be in and still count as toxic.
CLEAN_PER_TOXIC = 10
#: Documents whose words are held at a time.
_AT_ONCE = 400

_ALONE = re.compile(r"(?<!\S)\w(?:\s\w){2,}(?!\S)")
_MARKS = re.compile(r"[\W_]+")


def windows(word: str) -> list[str]:
    """What is scored of a white-space word: its letters and digits, in windows if they are many."""
    plain = word if word.isalnum() else _MARKS.sub("", word)
    if len(plain) <= WINDOW:
        return [plain]
    return [plain[i : i + PART] for i in range(0, len(plain) - PART + STEP, STEP)]


def raw_words(text: str | None) -> list[str]:
    """Lower-case white-space words, and the words that letters standing alone spell."""
    low = (text or "").lower()
    return low.split() + [re.sub(r"\s", "", m) for m in _ALONE.findall(low)]


@lru_cache(maxsize=WINDOW + 1)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    at = [(i, j, k) for i in range(n) for k in range(i + 2, min(n, i + SPAN)) for j in range(i + 1, k)]
    i, j, k = np.array(at, dtype=np.int64).reshape(-1, 3).T
    return i, j, k, DECAY ** (k - i + 1.0)


def _alike(lengths: np.ndarray, most: int = 1500) -> Iterator[tuple[int, np.ndarray]]:
    """Places of equal length, so many at a time that their arrays stay small."""
    for n in np.unique(lengths[lengths >= 3]):
        where = np.flatnonzero(lengths == n)
        for at in range(0, len(where), most):
            yield int(n), where[at : at + most]


def features(units: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For units of equal length: their places, triples (sorted in a row), and normalised weights.

    A triple that occurs more than once in a unit has its whole weight at the last occurrence.
    """
    lengths = np.array([len(u) for u in units])
    for n, where in _alike(lengths):
        points = np.array([list(map(ord, units[w])) for w in where], dtype=np.int64)
        letters = np.where(points < len(_KIND), _KIND[np.minimum(points, len(_KIND) - 1)], 36 + points % 25)
        i, j, k, weight = _triples(n)
        codes = (letters[:, i] * LETTERS + letters[:, j]) * LETTERS + letters[:, k]
        order = np.argsort(codes, axis=1, kind="stable")
        codes = np.take_along_axis(codes, order, axis=1)
        sums = np.cumsum(weight[order], axis=1)
        last = np.ones(codes.shape, dtype=bool)
        last[:, :-1] = codes[:, 1:] != codes[:, :-1]
        ends = np.where(last, sums, 0.0)
        before = np.maximum.accumulate(ends, axis=1)
        before = np.concatenate([np.zeros((len(where), 1)), before[:, :-1]], axis=1)
        total = np.where(last, ends - before, 0.0)
        yield where, codes, total / np.sqrt((total**2).sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class Machine:
    """One weight for each triple, a bias, and the logistic curve over a document's worst word."""

    weights: np.ndarray
    bias: float
    slope: float
    middle: float

    def margins(self, units: list[str]) -> np.ndarray:
        out = np.full(len(units), self.bias)
        for where, codes, weight in features(units):
            out[where] += (self.weights[codes] * weight).sum(axis=1)
        return out

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * (margin - self.middle), -40, 40)))


def _kernel(units: list[str], landmarks: np.ndarray) -> np.ndarray:
    """Kernel of each unit with each landmark; ``landmarks`` has a column of triple weights for each."""
    out = np.zeros((len(units), landmarks.shape[1]))
    for where, codes, weight in features(units):
        for a in range(0, len(where), 100):
            out[where[a : a + 100]] = np.einsum("rt,rtl->rl", weight[a : a + 100], landmarks[codes[a : a + 100]])
    return out


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rng: np.random.Generator, rounds: int = 30) -> np.ndarray:
    """Linear machine by dual coordinate descent; the last column of ``x`` is the bias."""
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    square = (x**2).sum(axis=1)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            gradient = y[i] * (x[i] @ w) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def _logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the curve, by Newton steps on standardised margins with a light prior."""
    centre, scale = margin.mean(), margin.std() or 1.0
    z = np.stack([(margin - centre) / scale, np.ones(len(margin))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -40, 40)))
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag([1e-2, 1e-4])
        w += np.linalg.solve(h, z.T @ (label - p) - np.array([1e-2, 1e-4]) * w)
    slope = max(w[0], 1e-3)
    return slope / scale, centre - scale * w[1] / slope


def _nearly_toxic(in_toxic: np.ndarray, in_clean: np.ndarray) -> np.ndarray:
    """Words of toxic documents that clean ones hardly have: a quoting or mislabelled one in ten toxic ones is allowed."""
    return (in_toxic > 0) & (in_clean * CLEAN_PER_TOXIC <= in_toxic)


def _telling(in_toxic: np.ndarray, in_clean: np.ndarray, share: float) -> np.ndarray:
    """Words that chance doesn't put into nearly toxic documents only.

    A word in k documents has at most c clean ones among them with a binomial chance. Of all words in k documents, less
    than half of one may be so by chance.
    """
    total, clean = (in_toxic + in_clean).astype(np.int64), in_clean.astype(np.int64)
    words = np.bincount(total)
    out = _nearly_toxic(in_toxic, in_clean) & (total >= 2)
    for i in np.flatnonzero(out):
        k = int(total[i])
        chance = sum(comb(k, j) * share ** (k - j) * (1 - share) ** j for j in range(int(clean[i]) + 1))
        out[i] = words[k] * chance < 0.5
    return out


def _one_of_copies(bags: list[list[str]]) -> list[int]:
    """Bags without near copies of earlier ones, which would make all of their words look telling.

    Bags are near copies if one of six bands of three minimum hashes agrees.
    """
    rng = np.random.default_rng(0)
    a, b = rng.integers(1, 1 << 31, 18) | 1, rng.integers(0, 1 << 31, 18)
    seen, out = set(), []
    for i, bag in enumerate(bags):
        h = np.array([zlib.crc32(u.encode()) for u in bag] or [0], dtype=np.int64)
        low = ((h[:, None] * a + b) % ((1 << 31) - 1)).min(axis=0).reshape(6, 3)
        bands = [(n, *row) for n, row in enumerate(low.tolist())]
        if seen.isdisjoint(bands):
            out.append(i)
        seen.update(bands)
    return out


def _variants(word: str, rng: np.random.Generator) -> list[str]:
    """The word with a letter put in, one doubled, and one replaced."""
    if len(word) < 4:
        return []
    out = []
    for _ in range(3):
        at = int(rng.integers(1, len(word)))
        other = chr(97 + int(rng.integers(26)))
        out += [word[:at] + other + word[at:], word[:at] + word[at - 1] + word[at:]]
    at = int(rng.integers(1, len(word)))
    return [*out, word[:at] + chr(48 + int(rng.integers(10))) + word[at + 1 :]]


def fit(
    bags: list[list[str]], toxic: np.ndarray, landmarks: int = 96, clean_words: int = 3000, passes: int = 4, seed: int = 7,
) -> Machine:
    """Train on bags of units, one bag for each labelled document."""
    rng = np.random.default_rng(seed)
    single = _one_of_copies(bags)
    bags, toxic = [bags[i] for i in single], np.asarray(toxic, dtype=bool)[single]
    nothing = np.zeros(LETTERS**3, dtype=np.float32)
    if toxic.all() or not toxic.any():
        share = min(max(float(toxic.mean()) if len(toxic) else 0.0, 1e-6), 1 - 1e-6)
        return Machine(nothing, 0.0, 1.0, -np.log(share / (1 - share)))
    apart = rng.random(len(bags)) < 0.3
    if not (toxic & ~apart).any() or not (~toxic & ~apart).any() or len(np.unique(toxic[apart])) < 2:
        apart[:] = False
    learn = np.flatnonzero(~apart)
    owner = np.repeat(learn, [len(bags[b]) for b in learn])
    names, inverse = np.unique([u for b in learn for u in bags[b]], return_inverse=True)
    if not len(names):
        return Machine(nothing, 0.0, 1.0, -np.log(toxic.mean() / (1 - toxic.mean())))
    in_toxic = np.bincount(inverse, weights=toxic[owner], minlength=len(names))
    in_clean = np.bincount(inverse, weights=~toxic[owner], minlength=len(names))
    nearly = _nearly_toxic(in_toxic, in_clean)
    clean = np.flatnonzero(~nearly)
    spoken = {b: inverse[owner == b][nearly[inverse[owner == b]]] for b in learn[toxic[learn]]}
    candidates = np.flatnonzero(nearly)
    usual = clean[np.argsort(-in_clean[clean], kind="stable")[:1500]]
    often = in_clean[clean] / in_clean[clean].sum() if len(clean) else None
    # Words that can't be in toxic documents by chance are toxic from the start; the others become so if the
    # machine finds them the most telling one of a document.
    telling = np.flatnonzero(_telling(in_toxic, in_clean, toxic[learn].mean()))
    worth = np.zeros(len(names))
    worth[telling] = in_toxic[telling]
    if not len(telling):
        worth = np.where(nearly & (in_toxic == in_toxic[nearly].max(initial=0)), 1.0, 0.0)
    machine, hard = None, np.empty(0, dtype=np.int64)
    for _ in range(passes):
        words = [u[np.argmax(worth[u])] for u in spoken.values() if len(u) and worth[u].max() > 0]
        if not words or not len(clean):
            break
        words = np.unique([*telling, *words])
        count = in_toxic[words]
        plain = np.union1d(rng.choice(clean, min(len(clean), clean_words), replace=False, p=often), np.union1d(hard, usual))
        good = [str(names[w]) for w in words]
        changed = [(v, 0.15 * np.sqrt(c)) for w, c in zip(good, count) for v in _variants(w, rng)]
        marks = good if len(good) <= landmarks * 2 // 3 else [
            good[i] for i in np.argsort(-count, kind="stable")[: landmarks * 2 // 3]]
        marks = marks + [str(names[w]) for w in rng.choice(plain, min(len(plain), landmarks - len(marks)), replace=False)]
        columns = np.zeros((LETTERS**3, len(marks)), dtype=np.float32)
        for where, codes, weight in features(marks):
            for r, c in enumerate(where):
                np.add.at(columns, (codes[r], c), weight[r])
        values, vectors = np.linalg.eigh(_kernel(marks, columns))
        root = vectors[:, values > 1e-6] / np.sqrt(values[values > 1e-6])
        units = [*good, *[v for v, _ in changed], *[str(names[w]) for w in plain]]
        label = np.concatenate([np.ones(len(good) + len(changed)), -np.ones(len(plain))])
        x = np.append(_kernel(units, columns) @ root, np.ones((len(units), 1)), axis=1)
        cost = 10.0 * np.concatenate([np.sqrt(count), [c for _, c in changed], np.sqrt(in_clean[plain])])
        w = _svm(x, label, cost, rng)
        machine = Machine((columns @ (root @ w[:-1])).astype(np.float32), float(w[-1]), 1.0, 0.0)
        # The clean words closest to being called toxic are learnt from next time.
        look = rng.choice(clean, min(len(clean), 40_000), replace=False)
        margin = machine.margins([str(names[i]) for i in look])
        hard = np.union1d(hard, look[np.argsort(-margin, kind="stable")[:800]])
        # From now on a word is as telling as the machine says, among those that clean documents hardly have.
        worth = np.zeros(len(names))
        worth[candidates] = np.maximum(machine.margins([str(names[i]) for i in candidates]), 0.0)
    if machine is None:
        return Machine(nothing, 0.0, 1.0, -np.log(toxic.mean() / (1 - toxic.mean())))
    judged = np.flatnonzero(apart) if apart.any() else learn
    worst = np.array([machine.margins(bags[b] or [""]).max() for b in judged])
    slope, middle = _logistic(worst, toxic[judged].astype(float))
    return Machine(machine.weights, machine.bias, slope, middle)


def learned(docs: DataFrame, labels: DataFrame, sample: int = 4500) -> Machine:
    """A machine trained on at most ``sample`` labelled documents of either label, of learning folds only.

    The documents are those with the lowest hashes of their ids, so the choice is random and repeatable. Only
    their ids (a bounded list) are sent to the scan, and only their words come back.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold() != 0)).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    known = known.withColumn("bad", F.col("toxic") > 0)
    share = {r["bad"]: r["count"] for r in known.groupBy("bad").count().collect()}  # two rows at most
    picked = None
    for bad, most in ((True, sample // 3), (False, sample - sample // 3)):
        # A bound on the hash leaves about twice as many as are wanted, so that few rows have to be put in order.
        bound = min(2**63 - 1, int((2 * most / max(1, share.get(bad, 0)) * 2.0 - 1.0) * 2**63))
        part = known.where((F.col("bad") == bad) & (F.xxhash64("doc_id") <= bound))
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", "toxic")
        picked = part if picked is None else picked.union(part)

    def bag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bags = [sorted({u for w in set(raw_words(t)) for u in windows(w) if len(u) >= 3}) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "units": [" ".join(b) for b in bags]})

    # At most ``sample`` ids of two numbers each.
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # One row for each id, that of the lowest hash of its text, so the bound holds for rows too. Of the rows of an id only
    # their hashes meet, and of equal texts one stays for each task.
    least = found.groupBy("doc_id").agg(F.min(text_key()).alias("_least"))
    found = found.join(F.broadcast(least), "doc_id").where(text_key() == F.col("_least")).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = found.select("doc_id", "toxic", "text").mapInPandas(bag, "doc_id long, toxic int, units string").toPandas()
    rows = rows.sort_values(["doc_id", "units"], kind="stable")
    return fit([u.split() for u in rows["units"]], rows["toxic"].to_numpy() > 0)


class Scorer:
    """A machine in a Python worker, with the scores of recent words."""

    def __init__(self, machine: Machine):
        self._machine = machine
        self._known = Recent(lambda word: float(machine.margins(windows(word)).max()), REMEMBERED)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        known = self._known
        out = []
        for start in range(0, len(texts), _AT_ONCE):
            bags = [raw_words(t) for t in texts[start : start + _AT_ONCE]]
            new = list({w for b in bags for w in b if not known.held(w)})
            parts = [windows(w) for w in new]
            margins = self._machine.margins([u for p in parts for u in p])
            first = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]]).astype(np.int64)
            fresh = dict(zip(new, np.maximum.reduceat(margins, first).tolist() if new else []))
            for b in bags:
                out.append(max((fresh[w] if w in fresh else known[w] for w in b), default=self._machine.bias))
            for w, m in fresh.items():
                known.put(w, m)
        return self._machine.probability(np.array(out))


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1), in place of any column of that name."""
    import hashlib

    name = hashlib.sha256(machine.weights.tobytes() + repr((machine.bias, machine.slope, machine.middle)).encode()).hexdigest()
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = kept(("toxicity", name), lambda: Scorer(sent.value))
        for batch in texts:
            yield pd.Series(scorer(list(batch)))

    return docs.withColumn("toxicity", score("text"))


def without_toxic(docs: DataFrame, machine: Machine, at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``at``."""
    column = "toxicity"
    own = docs.columns
    if column in own:
        docs = docs.withColumnRenamed(column, "_own_toxicity")
    kept = scored(docs, machine).where(F.col(column) < at).drop(column)
    return (kept.withColumnRenamed("_own_toxicity", column) if column in own else kept).select(*own)
