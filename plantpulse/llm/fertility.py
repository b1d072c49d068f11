"""Quality rules on how a public tokenizer takes a text.

A text that is no prose of its language needs more tokens for its characters, falls back to bytes, or uses few
different tokens. Two public vocabularies measure each text: characters per token under a vocabulary of pieces
and one of bytes, the share of pieces that are single bytes, and the entropy of the pieces.

The bands are statistics of all documents. Documents are put together by language (by script where no language is
given) and by length class, the power of two below the number of pieces. In each group the median and the median
distance from it are exact, taken from counts of rounded measures, where each text counts once, however many copies
it has. A document is rejected if a measure is more than ``limit`` widths from its group's median. Widths of small
groups are drawn towards the width of all documents' distances, and no width is less than half of that.

Plain rules come first: too few words, or too many words in repeated windows of eight.

Cases: a NULL or empty text has no words and fails the plain rules; texts that fail them are not in the statistics; a
NULL language is the script of most letters, or ``none``; repeated rows get equal verdicts; texts are read whole;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plantpulse.llm.common import kept, text_key, written

#: Fixed values of the plain rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
#: White space between words.
_WHITE = " \t\n\x0b\x0c\r"
_SCRIPTS = ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Han", "Hiragana", "Katakana", "Hangul", "Thai")
_SCRIPT = {name: regex.compile(rf"\p{{Script={name}}}") for name in _SCRIPTS}

MEASURES = ("piece_chars", "byte_chars", "fallback", "entropy")
#: Steps of a measure that are counted apart, for one unit of it.
STEPS = 1_000


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in some window of words that occurs twice or more.

    Windows are numbered exactly: two equally numbered windows that overlap or touch make a longer one.
    """
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    now = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    size = 1
    while size < window:
        step = min(size, window - size)
        pairs = now[:-step] * (int(now.max()) + 1) + now[step:]
        now, size = np.unique(pairs, return_inverse=True)[1], size + step
    again = np.bincount(now)[now] > 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[: len(again)] += again
    edges[window : window + len(again)] -= again
    return int((np.cumsum(edges) > 0).sum())


def plain_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, and words in repeated windows."""
    words = text.encode().split()  # bytes: only ASCII white space counts
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    return (
        len(words), len(text) - sum(map(text.count, _WHITE)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(words))


def script(text: str) -> str:
    """The script of most letters."""
    most = max(_SCRIPTS, key=lambda name: len(_SCRIPT[name].findall(text)))
    return most if _SCRIPT[most].search(text) else "none"


class Fertility:
    """Measures of texts under a piece model and a file of byte ranks, each given by its content."""

    def __init__(self, pieces: bytes, ranks: bytes, pattern: str):
        import sentencepiece
        import tiktoken

        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self._bytes = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self._single = np.array([self._pieces.is_byte(i) for i in range(self._pieces.get_piece_size())])

    def __call__(self, text: str) -> tuple[int, float, float, float, float]:
        """Pieces, characters for each piece, for each byte token, share of single bytes, entropy in bits."""
        ids = np.array(self._pieces.encode(text), dtype=np.int64)
        if not len(ids):
            return 0, 0.0, 0.0, 0.0, 0.0
        share = np.unique(ids, return_counts=True)[1] / len(ids)
        return (
            len(ids), len(text) / len(ids), len(text) / max(1, len(self._bytes.encode_ordinary(text))),
            float(self._single[ids].mean()), float(-(share * np.log2(share)).sum()))


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_LONGS = (*_COUNTS, "text_key", "n_pieces", "length", *MEASURES)
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("speech", pa.string()), *[(c, pa.int64()) for c in _LONGS], ("base_failed", pa.bool_())])


def measured(docs: DataFrame, pieces: str, ranks: str, pattern: str) -> DataFrame:
    """Plain counts and measures of each row; measures are rounded to thousandths.

    The driver reads both vocabularies, whose sizes are fixed, and sends them to the workers.
    """
    with open(pieces, "rb") as a, open(ranks, "rb") as b:
        sent = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = kept(("fertility", hash(sent.value[0]), hash(sent.value[1])), lambda: Fertility(*sent.value, pattern))
        for batch in batches:
            out = []
            for text, lang, key in zip(*[batch.column(c).to_pylist() for c in ("text", "lang", "text_key")]):
                text = text or ""
                counts = plain_counts(text)
                failed = counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED * counts[0]
                # Rejected already, so nothing more has to be measured.
                n, *rest = (0, 0, 0, 0, 0) if failed else fertility(text)
                speech = lang if lang is not None else script(text)
                out.append((speech, *counts, key, n, n.bit_length(), *[round(STEPS * m) for m in rest], failed))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), list(_SCHEMA)[1:])] if out else [pa.array([], f.type) for f in list(_SCHEMA)[1:]]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), *columns], schema=_SCHEMA)

    types = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean"}
    schema = ", ".join(f"{f.name} {types[f.type]}" for f in _SCHEMA)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select("doc_id", "text", lang.alias("lang"), text_key().alias("text_key")).mapInArrow(measure, schema)


def _median(counts: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """The lower median of counted values for each key; a key has as many rows as it has values."""
    upto = F.sum("n").over(W.partitionBy(*keys).orderBy(value))
    every = F.sum("n").over(W.partitionBy(*keys))
    middle = counts.withColumns({"_upto": upto, "_all": every}).where(2 * F.col("_upto") >= F.col("_all"))
    return middle.groupBy(*keys).agg(F.min(value).alias(alias), F.first("_all").alias("n"))


def bands(marked: DataFrame, drawn: int = 10, least: float = 0.5) -> DataFrame:
    """``speech, length, measure, middle, width`` of each group, from all rows that pass the plain rules.

    ``drawn`` is how many documents the width of all documents counts for in a group's width, and ``least``
    the share of it that no width falls below.
    """
    rows = marked.where(~F.col("base_failed")).select("speech", "length", "text_key", *MEASURES).distinct()
    long = rows.unpivot(["speech", "length"], list(MEASURES), "measure", "value")
    group = ["speech", "length", "measure"]
    counts, _ = written(long.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("n")), "measures")
    middles = _median(counts, group, "value", "middle").drop("n")
    away = counts.join(middles, group).withColumn("away", F.abs(F.col("value") - F.col("middle")))
    away = away.groupBy(*group, "middle", "away").agg(F.sum("n").alias("n"))
    own = _median(away, [*group, "middle"], "away", "_own")
    everywhere = _median(away.groupBy("measure", "away").agg(F.sum("n").alias("n")), ["measure"], "away", "_common").drop("n")
    # The median distance of a normal distribution is 1 / 1.4826 of its deviation.
    own_square, common_square = (F.pow(1.4826 * F.col(c), F.lit(2)) for c in ("_own", "_common"))
    drawn_in = (F.col("n") * own_square + drawn * common_square) / (F.col("n") + drawn)
    width = F.sqrt(F.greatest(drawn_in, least * least * common_square))
    return own.join(everywhere, "measure").select(*group, "middle", width.alias("width"))


def judged(docs: DataFrame, pieces: str, ranks: str, pattern: str, limit: float = 4.0) -> DataFrame:
    """Each row's plain counts, measures, ``base_failed`` and ``kept``."""
    marked, _ = written(measured(docs, pieces, ranks, pattern), "fertility")
    band = bands(marked)
    # One row for each language and length class; written, so that Spark knows its size before it plans the join.
    wide = band.groupBy("speech", "length").agg(
        *[F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"_{c}_{m}") for m in MEASURES for c in ("middle", "width")])
    wide, _ = written(wide, "bands")
    out = F.lit(False)
    for m in MEASURES:
        out = out | (F.abs(F.col(m) - F.col(f"_middle_{m}")) > limit * F.col(f"_width_{m}"))
    verdict = ~F.col("base_failed") & ~F.coalesce(out, F.lit(False))
    return marked.join(wide, ["speech", "length"], "left").select(
        "doc_id", *_COUNTS, "speech", "n_pieces", *MEASURES, "base_failed", verdict.alias("kept"))
