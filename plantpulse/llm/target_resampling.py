"""Importance resampling towards a target distribution, with bit-sliced weights.

Words are hashed into buckets. What a bucket is worth is the logarithm of how much more frequent it is in the target
than in the corpus, in thousandths, rounded down. The weight of a document is the sum of the gains of its words.

A document's counts of buckets are written as bit planes: plane i has a bit for each bucket, set if the count has
bit i. The gains are planes too, of their magnitudes, once for gains above and once for those below zero. A count's plane
AND a gain's plane, counted and shifted by both planes' powers of two, is one share of the weight; all shares
together are the exact sum in integers, as every product of two numbers is the sum over their pairs of bits.

Gumbel noise from a hash of the id is added and the highest scores are drawn, which samples without replacement in
proportion to the exponential of the weights. Ranks come from a range partitioning that is written down: rows
are numbered within a part, and the parts' counts are added.

Cases: a NULL or empty text has no words and the weight 0; a NULL id hashes like empty text and loses ties; equal
rows are documents of their own; benchmark rows without text count nothing; an empty table gives no rows, and with
an empty benchmark all target counts are 0; texts are read whole; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plantpulse.llm.common import Recent, discard, partitions, written

BUCKETS = 10_000
SEED = 2024
#: Bytes that end a word, after A-Z became a-z: all below 0x80 but digits and small letters.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Words whose bucket a Python worker remembers; bounds its memory only.
REMEMBERED = 300_000


class Buckets:
    """The buckets of a text's features: runs of 1 to ``longest`` words."""

    def __init__(self, buckets: int = BUCKETS, longest: int = 1):
        self._longest, self._of = longest, Recent(lambda f: zlib.crc32(f) % buckets, REMEMBERED)

    def __call__(self, text: str | None) -> tuple[int, np.ndarray]:
        """The number of words, and one bucket for each feature."""
        words = _WORD.findall(text.encode().lower()) if text else []
        features = list(words)
        for n in range(2, self._longest + 1):
            features += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        return len(words), np.fromiter(map(self._of.__getitem__, features), dtype=np.int64, count=len(features))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = 1) -> np.ndarray:
    """How many features of all texts fall into each bucket. Each task sends one number for a bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = Buckets(buckets, longest), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = of(text)[1]
                if len(found):
                    total += np.bincount(found, minlength=buckets)
        at = np.nonzero(total)[0]
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    sums = texts.select("text").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    # As many rows as there are buckets, whatever the number of documents.
    for row in sums.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of a bucket's smoothed share in the target over that in the corpus."""
    n = float(len(corpus))
    all_corpus, all_target = float(corpus.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (all_corpus + n) / ((s + 1.0) * (all_target + n))))
        for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def planes(numbers: np.ndarray) -> np.ndarray:
    """Bit planes of whole numbers from 0 on: a row for each bit, packed into 64-bit words."""
    width = max(1, int(numbers.max(initial=0)).bit_length())
    bits = (numbers[None, :] >> np.arange(width)[:, None]) & 1
    packed = np.packbits(bits.astype(np.uint8), axis=1)
    spare = -packed.shape[1] % 8
    return np.pad(packed, ((0, 0), (0, spare))).view(np.uint64)


class Weigher:
    """Exact weights from bit planes."""

    def __init__(self, gains_: np.ndarray):
        self._n = len(gains_)
        self._above, self._below = planes(np.maximum(gains_, 0)), planes(np.maximum(-gains_, 0))

    @staticmethod
    def _sum(counts: np.ndarray, worth: np.ndarray) -> int:
        common = np.bitwise_count(counts[:, None, :] & worth[None, :, :]).sum(axis=2, dtype=np.int64)
        return sum(n << (i + j) for (i, j), n in zip(np.ndindex(common.shape), common.ravel().tolist()))

    def __call__(self, features: np.ndarray) -> int:
        if not len(features):
            return 0
        counts = planes(np.bincount(features, minlength=self._n))
        # Buckets that the text lacks add nothing, so whole words of zeros are left out.
        held = counts.any(axis=0)
        counts = counts[:, held]
        return self._sum(counts, self._above[:, held]) - self._sum(counts, self._below[:, held])


_WEIGHED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


def weighed(docs: DataFrame, gains_: np.ndarray, longest: int = 1) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each row."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, weight = Buckets(len(gains_), longest), Weigher(gains_)
        for batch in batches:
            found = [of(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([
                batch.column("doc_id").cast(pa.int64()), pa.array([n for n, _ in found], pa.int64()),
                pa.array([len(f) for _, f in found], pa.int64()), pa.array([weight(f) for _, f in found], pa.int64())], schema=_WEIGHED)

    return docs.select("doc_id", "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def ranked(scores: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scores`` with ``rank`` for the highest ones: a share of the rows with enough words, in order.

    ``scores`` should be a written table, as it is read more than once.
    """
    able = scores.where(F.col("n_words") >= least_words)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("_row")]
    dealt = able.repartitionByRange(partitions(scores.sparkSession), *order)
    parts, folder = written(dealt.withColumn("_part", F.spark_partition_id()), "score-ranges")
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row for each part.
    before = counts.withColumn("_before", F.coalesce(
        F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    draw = F.floor(counts.agg(F.sum("_n")).scalar() * percent / 100)
    place = F.row_number().over(W.partitionBy("_part").orderBy(*order)) + F.col("_before")
    placed = parts.join(before.select("_part", "_before"), "_part").withColumn("rank", place.cast("long"))
    short = scores.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    out = placed.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank"))).select(*scores.columns, "rank").unionByName(short)
    result, _ = written(out.drop("_row"), "ranked")
    discard(scores.sparkSession, folder)
    return result


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, buckets: int = BUCKETS, longest: int = 1, seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of each row; a row without a rank is not drawn."""
    worth = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((drawn + F.lit(0.5)) / F.lit(4294967296.0))))
    scores = weighed(docs, worth, longest).withColumn("score", F.col("weight") + noise.cast("long"))
    table, folder = written(scores.withColumn("_row", F.monotonically_increasing_id()), "scores")
    out = ranked(table, percent, least_words)
    discard(docs.sparkSession, folder)
    return out
