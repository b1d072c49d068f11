"""Document fingerprints: bottom-k sketches of word shingles.

A sketch is the k smallest hashes of a text's distinct shingles, in order. The sketch of a union is the k
smallest of the sketches' hashes, so parts can be sketched apart and merged. Of two sketches the k
smallest hashes of both are a sample of the union; the share of it that both hold estimates the
resemblance. The k-th smallest hash tells how dense hashes lie, and so how many distinct shingles
there are; containment is the common part over one side's count.

A sketch with fewer than k hashes holds all of them, and everything about it is exact.

Cases: a NULL or empty text has the empty sketch; two empty sketches are alike (1), an empty and another one
are not (0); a text of fewer words than a shingle is one shingle; repeated rows give equal sketches.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.common import Recent, partitions, text_key

WORDS = 5
SIZE = 256
#: Word hashes that a Python worker remembers; bounds its memory only.
REMEMBERED = 300_000

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Hashed(Recent):
    """Hashes of words as numpy numbers."""

    def __init__(self) -> None:
        super().__init__(lambda word: xxhash.xxh64_intdigest(word), REMEMBERED)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sketch(text: str, words: int = WORDS, size: int = SIZE, hashed: Recent | None = None) -> np.ndarray:
    """The smallest hashes of the distinct shingles of a text, ascending."""
    tokens = text.split()
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    hashed = Hashed() if hashed is None else hashed
    each = np.fromiter(map(hashed.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    n = max(1, len(tokens) - words + 1)
    whole = np.full(n, min(words, len(tokens)), dtype=np.uint64)
    for i in range(min(words, len(tokens))):
        whole = _mix(whole * _FACTOR + each[i : i + n])
    if n > 4 * size:
        # More than enough of the smallest, as copies of one hash may be among them.
        for most in (2 * size, n):
            low = np.unique(np.partition(whole, most - 1)[:most] if most < n else whole)
            if len(low) >= size:
                break
        return low[:size]
    return np.unique(whole)[:size]


def merged(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return np.union1d(a, b)[:size]


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated share of common shingles among all."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:size]
    return float(len(np.intersect1d(np.intersect1d(a, b, True), union, True)) / len(union))


def distinct_count(a: np.ndarray, size: int = SIZE) -> float:
    """Estimated number of distinct shingles; exact below ``size``."""
    return float(len(a)) if len(a) < size else (size - 1) / ((float(a[size - 1]) + 1.0) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated share of the first one's shingles that the second has too."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, size) * distinct_count(merged(a, b, size), size) / distinct_count(a, size))


def written(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def read(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype="<u8")


def fingerprints(docs: DataFrame, words: int = WORDS, size: int = SIZE) -> DataFrame:
    """``docs`` with ``fingerprint``: the sketch of ``text`` in base64, in place of any column of that name."""

    @F.pandas_udf("string")
    def mark(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashed = Hashed()
        for batch in batches:
            yield pd.Series([written(sketch(t or "", words, size, hashed)) for t in batch], dtype="object")

    return docs.withColumn("fingerprint", mark("text"))


def merge_by(marked: DataFrame, key: str, size: int = SIZE) -> DataFrame:
    """One ``fingerprint`` for all rows of each key.

    Every task merges what it has of a key; the parts of a key are merged in 32 places and then in one, so a key that
    holds a third of all rows sends one sketch from each task.
    """

    def least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict = {}
        for batch in batches:
            for k, f in zip(batch[key], batch["fingerprint"]):
                own = read(f or "")
                best[k] = merged(best[k], own, size) if k in best else own
            if len(best) > 10_000:
                yield pd.DataFrame({key: list(best), "fingerprint": [written(v) for v in best.values()]})
                best = {}
        if best:
            yield pd.DataFrame({key: list(best), "fingerprint": [written(v) for v in best.values()]})

    schema = f"{key} {marked.schema[key].dataType.simpleString()}, fingerprint string"
    parts = marked.select(key, "fingerprint").mapInPandas(least, schema)
    salted = parts.repartition(F.col(key), F.spark_partition_id() % 32).mapInPandas(least, schema)
    return salted.repartition(F.col(key)).sortWithinPartitions(key).mapInPandas(least, schema).groupBy(key).agg(
        F.collect_list("fingerprint").alias("all")).select(key, _joined(size)("all").alias("fingerprint"))


def _joined(size: int):
    @F.pandas_udf("string")
    def join(lists: pd.Series) -> pd.Series:
        out = []
        for fingerprints_ in lists:
            all_ = np.empty(0, dtype=np.uint64)
            for f in fingerprints_:
                all_ = merged(all_, read(f), size)
            out.append(written(all_))
        return pd.Series(out, dtype="object")

    return join


_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double")
_EDITED_COLUMNS = [c.split()[0] for c in _EDITED.split(", ")]


def _first_rows(rows: DataFrame, slices: int) -> list[tuple]:
    """The first row of each range of rows in order, as (has an id, id or 0, text key); at most one for each slice."""
    order = ["known", "at", "text_key"]
    part = F.spark_partition_id()
    least = rows.select(*order).repartitionByRange(slices, *order).groupBy(part.alias("part")).agg(F.min(F.struct(*order)).alias("first"))
    return sorted(tuple(r["first"]) for r in least.collect())


def edited_likeness(docs: DataFrame, words: int = WORDS, size: int = SIZE, slices: int | None = None) -> DataFrame:
    """Each document's sketch beside those of its edited text and of the next document.

    The edited text has its last half replaced by the beginning of the next document by id; the first one follows
    the last. Documents are dealt to slices of the order, each slice in order; the first document of a slice is also
    sent to the slice before, so that every document meets its successor. The borders are rows of the table
    (one for each slice), so a slice's first document is known before.

    Rows without an id come first; rows with equal ids follow each other by a hash of the text. Equal rows follow each
    other, so they are counted, batch by batch, before they are dealt: all but the last of them are their own successors.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.col("doc_id").isNotNull().alias("known"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("at"),
        text_key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    borders = _first_rows(keyed, slices or 2 * partitions(spark))
    if not borders:
        return spark.createDataFrame([], _EDITED)
    n = len(borders)
    placed_schema = "known boolean, at long, text_key long, text string, times long, slice int, guest boolean"

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first: dict[tuple, int] = {}
            times: Counter = Counter()
            for i, row in enumerate(zip(*[batch.column(c).to_pylist() for c in ("known", "at", "text_key")])):
                first.setdefault(row, i)
                times[row] += 1
            taken, counts, where, guests = [], [], [], []
            for row, i in first.items():
                own = bisect_right(borders, row) - 1
                for guest in (False, True) if borders[own] == row else (False,):
                    taken.append(i)
                    counts.append(times[row])
                    where.append((own - 1) % n if guest else own)
                    guests.append(guest)
            rows = batch.take(pa.array(taken, pa.int64()))
            yield pa.record_batch(
                [*rows.columns, pa.array(counts, pa.int64()), pa.array(where, pa.int32()), pa.array(guests, pa.bool_())],
                names=["known", "at", "text_key", "text", "times", "slice", "guest"])

    # A guest comes after the slice's own rows.
    dealt = keyed.mapInArrow(placed, placed_schema).repartitionById(n, "slice").sortWithinPartitions("guest", "known", "at", "text_key")

    def followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hashed()
        held = None
        for batch in batches:
            out = []
            for known, at, text, times, guest in zip(*[batch.column(c).to_pylist() for c in ("known", "at", "text", "times", "guest")]):
                own = (at if known else None, text, sketch(text, words, size, hashed), guest)
                if held is not None and not held[3]:
                    out.append(_compared(held, own, words, size, hashed))
                if not guest and times > 1:
                    out += [_compared(own, own, words, size, hashed)] * (times - 1)
                held = own
            columns = list(zip(*out)) or [[]] * len(_EDITED_COLUMNS)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, _EDITED_TYPES)], names=_EDITED_COLUMNS)

    return dealt.select("known", "at", "text", "times", "guest").mapInArrow(followed, _EDITED)


_EDITED_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _compared(own: tuple, following: tuple, words: int, size: int, hashed: Recent) -> tuple:
    doc_id, text, mark, _ = own
    half = len(text) // 2
    edited = text[: len(text) - half] + following[1][:half]
    edited_mark = sketch(edited, words, size, hashed)
    return (
        doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(mark), written(edited_mark),
        resemblance(mark, edited_mark, size), resemblance(mark, following[2], size))
