"""Personal data: fixed patterns, and what a conditional random field finds beyond them.

The patterns give the base spans. The field is a linear chain over tokens (runs of letters and digits, and
single marks) with features of their shapes and of how they touch. It is trained on a small labelled
table, and it finds what the patterns miss, such as telephone numbers without a plus sign, or
numbers of cards that are divided by points. A found span must pass the check of its kind (digits, Luhn,
parts of an address), and never touches a base span.

A chain covers the words around each digit or at sign, as none of the kinds goes without. Chains of all
documents of a batch are decoded together: Viterbi steps run over arrays of chains of like length.

Cases: a NULL or empty text has no spans; texts are read whole, whatever their length, in time linear in
it; repeated rows give repeated results; extra columns are kept by the redaction and ignored else.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kinds in their fixed order.
KINDS = ("email", "ip", "card", "phone")
#: Words of context on either side of a word with a digit or at sign.
CONTEXT = 3
#: Most labelled sentences that are learnt from.
MAX_SENTENCES = 2000

# The address pattern is looked for from its at sign, so that long words aren't scanned from each letter.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]+")
_ANY = re.compile(r"[0-9@]")
_WORD = re.compile(r"\S+")
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    double = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    total = sum(map(int, digits[-1::-2])) + sum(double[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    found = []
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            found.append((start, 0, end))
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _plausible(kind: int, text: str) -> bool:
    if kind == 0:
        return bool(re.fullmatch(r"[^@]*[^\W_][^@]*@[^@]*\w[^@]*\.\s*\w[^@]*", text))
    digits = _digits(text)
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(map(_small, parts))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 and len(digits) < len(text)


def chains(text: str) -> list[list[tuple[int, int]]]:
    """Token spans of each stretch of words around a digit or at sign."""
    if not _ANY.search(text):
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    starts = [w[0] for w in words]
    stretches: list[list[int]] = []
    for m in _SIGN.finditer(text):
        at = bisect_right(starts, m.start()) - 1
        low, high = max(0, at - CONTEXT), min(len(words) - 1, at + CONTEXT)
        if stretches and low <= stretches[-1][1] + 1:
            stretches[-1][1] = max(stretches[-1][1], high)
        else:
            stretches.append([low, high])
    return [[m.span() for m in _TOKEN.finditer(text, words[a][0], words[b][1])] for a, b in stretches]


def shape(token: str) -> str:
    """Letters and digits by kind, with the number of digits; marks are themselves."""
    if not token[0].isalnum():
        return token
    if token.isdecimal():
        n = len(token)
        return f"d{n}" if n <= 4 else "d5-9" if n < 10 else "d10-13" if n < 14 else "d14-19" if n < 20 else "d20+"
    if token.isalpha():
        return "x" if token.islower() else "X" if token.isupper() else "Xx"
    return "xd" if len(token) < 20 else "xd+"


def token_features(text: str, tokens: list[tuple[int, int]]) -> list[list[str]]:
    """Names of the features of each token of a chain; every token has as many."""
    shapes = ["<", "<", *[shape(text[a:b]) for a, b in tokens], ">", ">"]
    ends = [b for _, b in tokens]
    glued = [False] + [a == e for (a, _), e in zip(tokens[1:], ends)] + [False]
    out = []
    for i in range(len(tokens)):
        far, before, own, after, next_ = shapes[i : i + 5]
        left, right = "=" if glued[i] else " ", "=" if glued[i + 1] else " "
        out.append([
            f"0{own}", f"1{before}{left}", f"2{after}{right}", f"3{far}", f"4{next_}", f"5{before}{left}{own}",
            f"6{own}{right}{after}", f"7{before}{left}{own}{right}{after}", f"8{far}|{before}{left}{own}",
            f"9{own}{right}{after}|{next_}"])
    return out


LABELS = ["O", *[f"{part}-{kind}" for kind in KINDS for part in "BI"]]


@dataclass(frozen=True)
class Field:
    """Weights of a trained chain. The last row of ``emit`` stands for unknown features and is zero."""

    names: dict[str, int]
    emit: np.ndarray
    move: np.ndarray
    begin: np.ndarray

    def rows(self, features: list[list[str]]) -> np.ndarray:
        unknown = len(self.emit) - 1
        return np.array([[self.names.get(f, unknown) for f in t] for t in features], dtype=np.int32)

    def decode(self, texts_features: list[list[list[str]]], cells: int = 200_000) -> list[np.ndarray]:
        """Best labels of each chain. Chains of like length are decoded as one array."""
        rows = [self.rows(f) for f in texts_features]
        order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
        out: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(rows)
        at = 0
        while at < len(order):
            # Few enough chains that their padded steps stay within ``cells``.
            stop = at + 1
            while stop < len(order) and (stop + 1 - at) * len(rows[order[stop]]) <= cells:
                stop += 1
            batch = order[at:stop]
            for i, labels in zip(batch, self._viterbi([rows[i] for i in batch])):
                out[i] = labels
            at = stop
        return out

    def _viterbi(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        lengths = np.array([len(r) for r in rows])
        steps, n = int(lengths.max()), len(self.begin)
        score = np.zeros((len(rows), steps, n), dtype=np.float32)
        for b, r in enumerate(rows):
            score[b, : len(r)] = self.emit[r].sum(axis=1)
        back = np.zeros((len(rows), steps, n), dtype=np.int8)
        best = score[:, 0] + self.begin
        same = np.arange(n, dtype=np.int8)
        for t in range(1, steps):
            options = best[:, :, None] + self.move
            open_ = (t < lengths)[:, None]
            back[:, t] = np.where(open_, options.argmax(axis=1), same)
            best = np.where(open_, options.max(axis=1) + score[:, t], best)
        label = best.argmax(axis=1)
        path = np.zeros((len(rows), steps), dtype=np.int64)
        for t in range(steps - 1, -1, -1):
            path[:, t] = label
            label = np.take_along_axis(back[:, t], label[:, None], axis=1)[:, 0].astype(np.int64)
        return [p[:k] for p, k in zip(path, lengths)]


def _parse(spans: str) -> list[Span]:
    parts = [s.split(":") for s in spans.split(",") if s]
    return [(int(a), KINDS.index(k), int(b)) for k, a, b in parts]


def written_spans(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def train(sentences: list[tuple[str, str]], steps: int = 150, rate: float = 0.15, decay: float = 2e-3) -> Field:
    """Fit the field to (text, spans) pairs: full gradients of the log-likelihood, Adam steps."""
    chains_, gold = [], []
    for text, spans in sentences:
        marked = _parse(spans)
        for tokens in chains(text):
            labels = []
            for a, b in tokens:
                inside = next((s for s in marked if s[0] <= a and b <= s[2]), None)
                labels.append(0 if inside is None else 1 + 2 * inside[1] + (a != inside[0]))
            chains_.append(token_features(text, tokens))
            gold.append(labels)
    names = {f: i for i, f in enumerate(dict.fromkeys(f for c in chains_ for t in c for f in t))}
    n, size = len(LABELS), len(names)
    steps_, count = max(map(len, chains_)), len(chains_)
    rows = np.full((count, steps_, len(chains_[0][0])), size, dtype=np.int64)
    label = np.zeros((count, steps_), dtype=np.int64)
    mask = np.zeros((count, steps_), dtype=bool)
    for c, (features, own) in enumerate(zip(chains_, gold)):
        rows[c, : len(own)] = [[names[f] for f in t] for t in features]
        label[c, : len(own)], mask[c, : len(own)] = own, True
    lengths = mask.sum(axis=1)
    weights = [np.zeros((size + 1, n)), np.zeros((n, n)), np.zeros(n)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    one = np.eye(n)[label] * mask[:, :, None]
    pairs = np.einsum("cti,ctj->ij", one[:, :-1], one[:, 1:])
    at = np.arange(count)

    def soft(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, steps + 1):
        emit, move, begin = weights
        score = emit[rows].sum(axis=2)
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0] + begin
        for t in range(1, steps_):
            ahead[:, t] = soft(ahead[:, t - 1][:, :, None] + move, 1) + score[:, t]
        for t in range(steps_ - 2, -1, -1):
            onward = soft(move + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where((t + 1 < lengths)[:, None], onward, 0.0)
        whole = soft(ahead[at, lengths - 1], 1)
        expected = np.exp(ahead + behind - whole[:, None, None]) * mask[:, :, None]
        both = ahead[:, :-1, :, None] + move + (score + behind)[:, 1:, None, :] - whole[:, None, None, None]
        moved = (np.exp(np.minimum(both, 0.0)) * mask[:, 1:, None, None]).sum(axis=(0, 1))
        change = one - expected
        slope = [np.zeros_like(emit), pairs - moved, change[:, 0].sum(axis=0)]
        for k in range(rows.shape[2]):
            np.add.at(slope[0], rows[:, :, k].ravel(), change.reshape(-1, n))
        slope[0][size] = 0.0
        for i, w in enumerate(weights):
            g = slope[i] / count - decay * w
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g**2
            w += rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
        weights[0][size] = 0.0
    return Field(names, weights[0].astype(np.float32), weights[1].astype(np.float32), weights[2].astype(np.float32))


def examples(spark: SparkSession, sentences: int = 500, seed: int = 11) -> DataFrame:
    """The small labelled table: ``text`` and ``spans``, made by rule.

    Each sentence is a few words with something of a kind, or with something that looks like it but is
    none (versions, dates, prices, hashes, counters, short or unchecked numbers).
    """
    rng = np.random.default_rng(seed)

    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def word() -> str:
        w = "".join(map(chr, rng.integers(97, 123, int(rng.integers(2, 9)))))
        return w.capitalize() if rng.random() < 0.2 else w.upper() if rng.random() < 0.1 else w

    def card(n: int) -> str:
        body = digits(n - 1)
        return next(body + d for d in "0123456789" if luhn(body + d))

    def groups(text: str, mark: str) -> str:
        return mark.join(text[i : i + 4] for i in range(0, len(text), 4))

    def pick(*options):
        return options[int(rng.integers(len(options)))]

    def positive(kind: int) -> str:
        if kind == 0:
            host = f"{word()}{pick('', '-' + word())}.{word()}{pick('', '.' + word())}"
            return pick(f"{word()}.{word()}", word() + digits(2), word(), f"{word()}_{word()}") + pick("@", "@", " @ ") + host
        if kind == 1:
            return pick(".", ".", ".", " . ").join(str(rng.integers(0, 256)) for _ in range(4))
        if kind == 2:
            return groups(card(pick(14, 15, 16, 16, 16, 19)), pick("", "", " ", "-", ".", " - "))
        a, b, c = digits(3), digits(3), digits(4)
        return pick(
            f"+{digits(2)} {a} {b} {c}", f"+{digits(1)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}",
            f"+{digits(11)}", f"0{digits(3)} {digits(3)} {digits(4)}")

    def negative() -> str:
        return pick(
            f"version {digits(1)}.{digits(1)}", f"{digits(1)}.{digits(1)}.{digits(2)}", f"{digits(4)}-{digits(2)}-{digits(2)}",
            f"token = \"{''.join(rng.choice(list('0123456789abcdef'), 40))}\"", f"${digits(2)}.{digits(2)}", digits(3), digits(8),
            f"{digits(4)}", f"no. {digits(5)}", f"{digits(2)}:{digits(2)}", f"CC BY-NC {digits(1)}.0", f"@{word()}", digits(24),
            f"{digits(2)}%", f"{digits(1)},{digits(3)}", f"{word()}{digits(3)}", f"{digits(3)}-{digits(2)}", f"{digits(10)}", f"{digits(12)}",
            f"{digits(2)}/{digits(2)}/{digits(4)}", f"{digits(3)} {digits(2)} {digits(3)}")

    rows = []
    for i in range(sentences):
        text = " ".join(word() for _ in range(int(rng.integers(0, 5)))) + pick(" ", ": ", " (", ", ")
        text = text.lstrip() if rng.random() < 0.3 else text
        spans = ""
        if i % 2:
            kind = (i // 2) % len(KINDS)
            thing = positive(kind)
            spans = f"{KINDS[kind]}:{len(text)}:{len(text) + len(thing)}"
        else:
            thing = negative()
        text += thing + pick("", ".", ",", " ", ") ", "### ", "!! ") + " ".join([""] + [word() for _ in range(int(rng.integers(0, 5)))])
        rows.append((text, spans))
    return spark.createDataFrame(rows, "text string, spans string")


def trained(labelled: DataFrame) -> Field:
    """A field trained on a labelled table of at most ``MAX_SENTENCES`` rows."""
    rows = labelled.select("text", "spans").orderBy("text", "spans").limit(MAX_SENTENCES).toPandas()
    return train(list(zip(rows["text"], rows["spans"])))


def all_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) if _ANY.search(t) else [] for t in texts]
    owner, tokens, features = [], [], []
    for i, t in enumerate(texts):
        for c in chains(t):
            owner.append(i)
            tokens.append(c)
            features.append(token_features(t, c))
    added: dict[int, list[Span]] = {}
    for i, own, labels in zip(owner, tokens, field.decode(features) if features else []):
        if not labels.any():
            continue
        starts = [b[0] for b in base[i]]
        reach = np.maximum.accumulate([b[2] for b in base[i]]).tolist() if base[i] else []
        begin = 0
        while begin < len(labels):
            if labels[begin] == 0:
                begin += 1
                continue
            kind, end = (int(labels[begin]) - 1) // 2, begin + 1
            while end < len(labels) and labels[end] == 2 + 2 * kind:
                end += 1
            a, b = own[begin][0], own[end - 1][1]
            before = bisect_right(starts, b - 1)
            if not (before and reach[before - 1] > a) and _plausible(kind, texts[i][a:b]):
                added.setdefault(i, []).append((a, kind, b))
            begin = end
    return [(b, sorted(b + added[i]) if i in added else b) for i, b in enumerate(base)]


_RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string"


def with_spans(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with the struct ``found``: base counts of each kind, base spans, all spans."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf(_RESULT)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for base, spans in all_spans([t or "" for t in texts], sent.value):
            kinds = [k for _, k, _ in base]
            rows.append((*[kinds.count(k) for k in range(len(KINDS))], written_spans(base), written_spans(spans)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _RESULT.split(", ")])

    return docs.withColumn("found", find("text"))


def _redact(text: str | None, spans: list[Span]) -> str | None:
    if not spans:
        return text
    parts, at = [], 0
    for a, kind, b in spans:
        if a < at:  # overlaps a span that is masked already
            at = max(at, b)
            continue
        parts += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = b
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with every span replaced by the name of its kind, and ``n_chars`` to match where there is one."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("string")
    def masked(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = all_spans([t or "" for t in batch], sent.value)
            yield pd.Series([_redact(t, spans) for t, (_, spans) in zip(batch, found)], dtype="object")

    out = docs.withColumn("text", masked("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
