"""Exact top-k by inner product: Fagin's threshold algorithm over lists that are sorted by each dimension.

Vectors are dealt into shards of bounded size. A shard keeps its vectors' numbers sorted by each component; a query reads the lists from the end where its
weight makes products large, all to the same depth, scores what it meets for the first time, and stops when the bound, the
products at that depth added up, is below its kth score so far. The best of each shard meet in one partial top-k."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.llm.common import doc_rows
from curatrix.scratch import Scratch

SCALE, EVERY, K = 256, 50, 5
#: Vectors of a shard, and queries that visit it in one task, on average.
SHARD, BLOCK = 4096, 4096
#: Entries that a query reads of each list at first; each step reads twice as many.
FIRST = 16
#: Sums below it are exact in doubles.
EXACT = 2.0**53
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    """The vectors' components, shorter vectors filled up with zeros."""
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _whole(m: np.ndarray, scale: int, exact: bool) -> np.ndarray:
    """floor(scale * x) of each component, as doubles if these are exact, else as Python's integers."""
    if exact:
        return np.floor(m * scale)
    return np.array([[scale * int(v) if abs(v) >= EXACT else math.floor(scale * v) for v in r] for r in m.tolist()], object).reshape(m.shape)


def _best(scores: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores, ties to the smaller row."""
    if scores.dtype == object:
        return np.array(sorted(range(len(rows)), key=lambda i: (-scores[i], rows[i]))[:k], np.int64)
    if len(rows) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[-k])
        return near[np.lexsort((rows[near], -scores[near]))[:k]]
    return np.lexsort((rows, -scores))


class SortedLists:
    """The lists of one shard: ids and whole-number vectors, and for each dimension the vectors' order and components in it."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[by_id], np.ascontiguousarray(x[by_id])
        up = np.argsort(self.x, axis=0, kind="stable").T
        values = np.take_along_axis(self.x.T, up, axis=1)
        #: [0]: ascending, read for negative weights; [1]: descending
        self.order = np.stack([up, up[:, ::-1]]).astype(np.int32)
        self.values = np.stack([values, values[:, ::-1]])

    def top(self, weights: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray, int]:
        """ids and scores of the k best, ties to the smaller id, without the vector named own; and how many vectors were scored."""
        n, scored = len(self.ids), 0
        dims = np.flatnonzero(weights)
        new = np.zeros(n, bool)
        done = np.zeros(n, bool) if own is None else self.ids == own
        rows, scores = np.zeros(0, np.int64), np.zeros(0, self.x.dtype)
        if not len(dims):  # all score 0
            rows = np.flatnonzero(~done)[:k]
            return self.ids[rows], np.zeros(len(rows), self.x.dtype), len(rows)
        side, w = (weights[dims] > 0).astype(np.int64), weights[dims]
        depth, step = 0, FIRST
        while depth < n:
            end = min(n, depth + step)
            new[self.order[side, dims, depth:end]] = True
            fresh = np.flatnonzero(new & ~done)
            if len(fresh):
                done[fresh], scored = True, scored + len(fresh)
                rows, scores = np.concatenate([rows, fresh]), np.concatenate([scores, self.x[fresh] @ weights])
                keep = _best(scores, rows, k)
                rows, scores = rows[keep], scores[keep]
            bound = (self.values[side, dims, end - 1] * w).sum()
            if len(rows) >= k and bound < scores.min() or done.all():
                break
            depth, step = end, step * 2
        return self.ids[rows], scores, scored


def _search(frame: pd.DataFrame, k: int, scale: int) -> pd.DataFrame:
    """The k best of a shard for each query that visits it."""
    data, queries = frame[frame["side"] == 0], frame[frame["side"] == 1]
    if not len(data) or not len(queries):
        return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
    dims = int(frame["x"].map(len).max())
    x, q = _matrix(data["x"], dims), _matrix(queries["x"], dims)
    with np.errstate(over="ignore", invalid="ignore"):
        exact = dims * (np.abs(x).max(initial=0.0) * scale + 1) * (np.abs(q).max(initial=0.0) * scale + 1) < EXACT
    x, q = _whole(x, scale, exact), _whole(q, scale, exact)
    lists = SortedLists(data["id"].to_numpy(np.int64), x)
    found = [(i, *lists.top(w, k, i)[:2]) for i, w in zip(queries["id"].tolist(), q, strict=True)]
    scores = np.concatenate([s for _, _, s in found])
    whole = np.array([min(max(int(s), LEAST), MOST) for s in scores], np.int64)
    return pd.DataFrame({"query_id": np.repeat([i for i, _, _ in found], [len(s) for _, _, s in found]), "vec_id": np.concatenate([r for _, r, _ in found]), "score": whole})


def top_k(spark: SparkSession, vectors: DataFrame, every: int = EVERY, k: int = K, scale: int = SCALE, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of vectors(vec_id, embedding) whose vec_id is divisible by `every` the k other rows of highest score.

    A component x counts as floor(scale * x), x as double; the score is the inner product of these whole numbers, in exact arithmetic; a sum that 64 bits don't hold
    counts as the nearest one that they do. Ties go to the smaller vec_id. Queries with fewer than k others get them all.
    Rows without vec_id, and vectors that are null or hold null or non-finite components, take no part. A shorter vector counts as filled up with
    zeros; an empty one scores 0. Rows of one vec_id count once, with the largest vector in the order of components. No rows: no rows."""
    scratch = Scratch(spark, "topk")
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = doc_rows(vectors, "vec_id", "embedding").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
    data = scratch.keep(rows.groupBy(F.col("vec_id").cast("long").alias("id")).agg(F.max("embedding").alias("x")), "data")
    asked = data.where(F.col("id") % every == 0)
    shards, blocks = (max(1, -(-d.count() // size)) for d, size in ((data, shard), (asked, block)))
    deal = lambda d, own, n, other, m, side: d.select(
        "id", "x", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other), F.lit(side).alias("side")
    )
    cells = deal(data, "shard", shards, "block", blocks, 0).unionByName(deal(asked, "block", blocks, "shard", shards, 1))

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        return _search(frame, k, scale)

    found = cells.groupBy("shard", "block").applyInPandas(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
