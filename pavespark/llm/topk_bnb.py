"""Exact top-k inner products by columnar branch-and-bound (operator 7).

Queries and candidates meet in blocks: candidates are dealt to groups and repeated once for
every block of queries, queries once for every group, and each (group, block) pair is one
task's work of bounded size. Inside, candidates lie dimension by dimension. A query's scores
grow block by block of dimensions; what the remaining dimensions can add is at most the
product of the remaining norms (Cauchy-Schwarz), so candidates that cannot reach the k-th
best score so far are dropped and the survivors are compacted. Survivors of all blocks have
their exact integer scores; the k best per query and group meet in one ranking.

Vectors that are null or hold a null or non-finite component take no part, nor do rows
without an id. Vectors are compared with those of their own length only. A query's own id is
never its candidate; repeated candidate rows each count. Of several vectors with one id the
smallest is the query. Scores beyond a long are cut to its ends. Empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EXACT = float(1 << 52)  # sums of products below this are exact in doubles
LONG = (1 << 63) - 1


def usable(vector: str) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def quantised(vectors: pd.Series, scale: float) -> np.ndarray:
    """floor(scale * x) of equally long vectors, as doubles, one row each."""
    return np.floor(scale * np.stack([np.asarray(v, np.float64) for v in vectors]))


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: highest score first, then smallest id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class VerticalBlock:
    """Candidates in vertical layout, with the norms of what follows each block of dimensions."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, width: int = 16):
        self.ids, self.dims = ids, vectors.shape[1]
        # dimensions of large spread first: they decide most
        self.order = np.argsort(-(vectors * vectors).sum(axis=0), kind="stable")
        self.columns = np.ascontiguousarray(vectors[:, self.order].T)
        self.cuts = [*range(0, self.dims, width), self.dims]
        squares = np.vstack([(self.columns[a:b] ** 2).sum(axis=0)
                             for a, b in zip(self.cuts, self.cuts[1:], strict=False)] or
                            [np.zeros(len(ids))])
        self.rest = np.sqrt(np.maximum(squares[::-1].cumsum(axis=0)[::-1], 0))

    def best(self, query_id: int, query: np.ndarray, k: int, seed: int = 512):
        """(ids, scores) of the k best candidates of a query."""
        q = query[self.order]
        alive = np.flatnonzero(self.ids != query_id)
        first = alive[:seed]
        known = q @ self.columns[:, first] if self.dims else np.zeros(len(first))
        floor = np.partition(known, len(known) - k)[len(known) - k] if len(known) >= k else -np.inf
        scores = np.zeros(len(alive))
        for i, (a, b) in enumerate(zip(self.cuts, self.cuts[1:], strict=False)):
            block = self.columns[a:b]
            scores += q[a:b] @ (block if len(alive) == block.shape[1] else block[:, alive])
            if b < self.dims:
                most = scores + math.sqrt(float((q[b:] ** 2).sum())) * self.rest[i + 1][alive]
                keep = most * (1 + 1e-9 * np.sign(most)) + 1 >= floor
                if np.count_nonzero(keep) < 0.75 * len(keep):
                    alive, scores = alive[keep], scores[keep]
        chosen = top(scores, self.ids[alive], k)
        return self.ids[alive][chosen], scores[chosen]


def exact_best(ids, vectors, query_id, query, k):
    """The same in Python's integers, where doubles would round."""
    q = [int(x) for x in query]
    scored = sorted((-sum(a * int(b) for a, b in zip(q, v, strict=True)), int(i))
                    for i, v in zip(ids, vectors, strict=True) if i != query_id)[:k]
    return [i for _, i in scored], [max(-LONG - 1, min(LONG, -s)) for s, _ in scored]


def top_k(embeddings: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0,
          group_rows: int = 8192, block_rows: int = 512, id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """Per row whose id is divisible by ``every``: its k best among all others.

    Returns query_id, rank (from 1), vec_id, score.
    """
    vectors = embeddings.select(F.col(id_column).cast("long").alias("vec_id"),
                                F.col(vector_column).alias("v"))
    vectors = vectors.where(F.col("vec_id").isNotNull() & usable("v"))
    queries = (vectors.where(F.col("vec_id") % every == 0)
               .groupBy("vec_id", F.size("v").alias("n")).agg(F.min("v").alias("v")).drop("n"))
    rows = embeddings.count()
    groups = max(1, -(-rows // group_rows))
    blocks = max(1, -(-rows // (every * block_rows)))

    def dealt(parts: int, name: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias(name)

    def everywhere(parts: int, name: str) -> Column:
        numbers = F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))
        return F.explode(numbers).alias(name)

    left = vectors.select("vec_id", "v", dealt(groups, "g"), everywhere(blocks, "b"))
    right = queries.select("vec_id", "v", dealt(blocks, "b"), everywhere(groups, "g"))

    def score(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        lengths = candidates["v"].map(len)
        for n, own in asked.groupby(asked["v"].map(len)):
            there = candidates[lengths == n]
            if not len(there):
                continue
            ids, c = there["vec_id"].to_numpy(), quantised(there["v"], scale)
            q_ids, q = own["vec_id"].to_numpy(), quantised(own["v"], scale)
            most = (np.abs(c).max(initial=0) + 1) * (np.abs(q).max(initial=0) + 1) * max(n, 1)
            block = VerticalBlock(ids, c) if most < EXACT else None
            for query_id, query in zip(q_ids, q, strict=True):
                found, scores = (block.best(query_id, query, k) if block else
                                 exact_best(ids, c, query_id, query, k))
                out += [(int(query_id), int(i), int(s)) for i, s in zip(found, scores, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = (left.groupBy("g", "b").cogroup(right.groupBy("g", "b"))
             .applyInPandas(score, "query_id long, vec_id long, score long"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
