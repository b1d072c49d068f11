"""Exact top-k by inner product over quantised vectors, by MaxScore within shards.

A component of a vector is a term, and a vector's posting in it is the component as an integer.
In each shard a term adds between its lowest and its highest impact to a score, so with the lowest
ones as a base every posting adds something from zero to the term's bound. Terms are ordered by
bound. Once the k-th best score of a query is known, the terms whose bounds together can't lift
the base to it are non-essential: only the postings of the others are traversed, and the
non-essential ones are probed, largest bound first, for the vectors that can still compete.
Each shard gives its own best k of a query, and these are merged.

Queries and vectors meet in cells of one block of queries and one shard. Both are bounded, neither
is sent to every machine whole.

Cases: vectors that are NULL or hold NULL, NaN or an infinity, and rows without an id, take no part;
a missing component counts as zero; of rows that repeat an id each is a candidate, and the
smallest vector is the query; large components are summed in whole numbers of 64 bits or more, and a score that no long
holds is given as the nearest long; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.llm.common import partitions

#: Integers up to here are exact as doubles.
EXACT = 2.0**53


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id`` and ``terms``: each component as floor(scale * x), for vectors that take part."""
    sound = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound).select(
        "vec_id", F.expr(f"transform(embedding, x -> floor({scale} * cast(x AS double)))").alias("terms"))


def _matrix(rows: list, width: int, kind: type = float) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=kind)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def shard_best(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int, block: int = 1024):
    """Best k (id, score) of one query in one shard; ties to the smaller id."""
    used = np.flatnonzero(query)
    weight = query[used]
    low, high = vectors[:, used].min(axis=0), vectors[:, used].max(axis=0)
    floor_ = np.where(weight > 0, low, high)
    bound = np.abs(weight) * (high - low)
    order = np.argsort(-bound, kind="stable")
    used, weight, floor_, bound = used[order], weight[order], floor_[order], bound[order]
    base = weight @ floor_
    # rest[i]: what the terms from i on can add.
    rest = np.append(np.cumsum(bound[::-1])[::-1], bound[:0].sum())
    best_ids, best, threshold = np.empty(0, ids.dtype), np.empty(0, rest.dtype), -np.inf
    for start in range(0, len(ids), block):
        part, names = vectors[start : start + block], ids[start : start + block]
        # The fewest terms that leave the others unable to reach the threshold alone.
        essential = int(np.argmax(base + rest < threshold)) if (base + rest < threshold).any() else len(used)
        score = base + (part[:, used[:essential]] - floor_[:essential]) @ weight[:essential]
        alive = np.flatnonzero((score + rest[essential] >= threshold) & (names != own))
        score = score[alive]
        for i in range(essential, len(used)):
            if not len(alive):
                break
            score = score + (part[alive, used[i]] - floor_[i]) * weight[i]
            keep = score + rest[i + 1] >= threshold
            alive, score = alive[keep], score[keep]
        best_ids = np.concatenate([best_ids, names[alive]])
        best = np.concatenate([best, score])
        first = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[first], best[first]
        if len(best) == k:
            threshold = best[-1]
    return best_ids, best


def shard_count(vectors: DataFrame, vectors_per_shard: int) -> int:
    """Twice the shuffle partitions, or more where shards would hold more vectors than that on average."""
    return max(2 * partitions(vectors.sparkSession), -(-vectors.count() // vectors_per_shard))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, queries_per_block: int = 4096, shards: int | None = None,
    vectors_per_shard: int = 16_384,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates for each query.

    Both frames come from :func:`quantised`. ``shards`` defaults to :func:`shard_count`.
    """
    shards = shards or shard_count(vectors, vectors_per_shard)
    queries = queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("terms").alias("terms"))
    # One number: how many blocks of queries there are.
    blocks = -(-queries.count() // queries_per_block)
    if not blocks:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dealt = vectors.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"),
        F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"), "vec_id", "terms")
    asked = queries.select(
        F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard"),
        F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(blocks)).alias("block"), "query_id", "terms")

    def cell(candidates: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(candidates) and len(wanted):
            width = max(map(len, [*candidates["terms"], *wanted["terms"]]))
            x, q = _matrix(list(candidates["terms"]), width), _matrix(list(wanted["terms"]), width)
            most = np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(1, width) * 4
            if most >= EXACT:
                # Large components: whole numbers of 64 bits, or of any size where sums might pass these too.
                kind = np.int64 if most < 2.0**62 else object
                x, q = _matrix(list(candidates["terms"]), width, kind), _matrix(list(wanted["terms"]), width, kind)
            ids = candidates["vec_id"].to_numpy()
            for name, vector in zip(wanted["query_id"], q):
                best_ids, best = shard_best(x, ids, vector, name, k)
                # A score beyond a long can't be told, so it stands at the nearest one.
                scores = [min(max(int(b), -(2**63)), 2**63 - 1) for b in best] if best.dtype == object else best.astype("int64")
                found.append(pd.DataFrame({"query_id": name, "vec_id": best_ids, "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    best = dealt.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        cell, "query_id long, vec_id long, score long")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return best.select("query_id", F.row_number().over(by_score).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
