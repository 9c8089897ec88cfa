"""Exact top-k search with multi-resolution segment statistics.

Vectors are cut into segments, few and wide at first, then more. With the mean
and the deviation of every segment the distance between two vectors is at least
``sum(w * (mean difference)^2 + (deviation difference)^2)``; for inner products
that reads: the score is at most ``sum(w * mean * mean + deviation * deviation)``.
Coarse to fine, pairs whose bound cannot reach the k-th best exact score known
are dropped; the survivors get exact scores.

The stated queries meet all candidates in blocks of bounded size; each block
pair keeps k results a query, and the best k of those are ranked.

Defined results: vectors that are null or hold null or non-finite components
take no part; a null id takes no part; of rows sharing an id the smallest vector
counts; only vectors of the query's length are its candidates; ties go to the
smaller id; fewer than k candidates give fewer rows; empty tables give none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rookery.llm.cluster import ship

LEVELS = (4, 16)  # segments


def _stats(x: np.ndarray, segments: int) -> np.ndarray:
    """Columns whose inner product is the upper bound of the score."""
    edges = np.unique(np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int))
    width = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / width
    rest = np.maximum(np.add.reduceat(x * x, edges[:-1], axis=1) - width * mean * mean, 0)
    return np.hstack([mean * np.sqrt(width), np.sqrt(rest)])


def best_in_block(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int):
    """Exact best ``k`` candidates (ascending ``cid``) of each query, its own id excluded."""
    big = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    exact_float = big < 2 ** 52
    xq, xc = (q.astype(np.float64), c.astype(np.float64))
    sq, sc = (xq, xc) if exact_float else (q, c)
    slack = 1e-9 * (big + 1)
    if len(cid) > 4 * k and q.shape[1]:
        at = np.searchsorted(cid, qid)
        own = np.flatnonzero((at < len(cid)) & (cid[np.minimum(at, len(cid) - 1)] == qid))
        alive = np.ones((len(qid), len(cid)), dtype=bool)
        alive[own, at[own]] = False
        floor = np.full(len(qid), -np.inf)
        for segments in LEVELS:
            if segments >= q.shape[1]:
                break
            bound = _stats(xq, segments) @ _stats(xc, segments).T
            bound[~alive] = -np.inf
            first = np.argpartition(bound, -k, axis=1)[:, -k:]
            some = np.einsum("qd,qkd->qk", xq, xc[first])
            some[~np.take_along_axis(alive, first, axis=1)] = -np.inf
            floor = np.maximum(floor, some.min(axis=1) - slack)
            alive &= bound >= (floor - slack)[:, None]
    else:
        alive = cid[None, :] != qid[:, None]
    for i in range(len(qid)):
        idx = np.flatnonzero(alive[i])
        scores = sc[idx] @ sq[i]
        if len(idx) > k:
            kth = np.partition(scores, -k)[-k]
            keep = scores >= kth
            idx, scores = idx[keep], scores[keep]
        order = np.argsort(-scores, kind="stable")[:k]
        yield qid[i], cid[idx[order]], scores[order].astype(np.int64)


def _block(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids in ascending order and their vectors, one row an id."""
    ids = t.column("id").to_numpy()
    flat = t.column("vec").combine_chunks()
    flat = flat.flatten().to_numpy(zero_copy_only=False) if len(flat) else np.empty(0, dtype=np.int64)
    x = flat.reshape(len(ids), -1)
    if len(np.unique(ids)) < len(ids):
        order = np.lexsort([*x.T[::-1], ids])
        ids, x = ids[order], x[order]
        first = np.concatenate([[True], ids[1:] != ids[:-1]])
        return ids[first], x[first]
    order = np.argsort(ids)
    return ids[order], x[order]


def top_k(df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vec_col: str = "embedding", least_block: int = 1024, most_block: int = 16384) -> DataFrame:
    """``query_id, rank, vec_id, score``: the integer inner products of
    ``floor(scale * x)``, best first. A block holds ``least_block`` to
    ``most_block`` candidates."""
    ship(df.sparkSession)
    vec = F.col(f"`{vec_col}`")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = (df.where(F.col(f"`{id_col}`").isNotNull() & vec.isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.col(f"`{id_col}`").cast("long").alias("id"), is_query.alias("q"),
                    F.transform(vec, lambda x: F.floor(x.cast("double") * scale)).alias("vec")))
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("q")).first()
    block = min(max(least_block, -(-n.n // 64)), most_block)
    c_blocks, q_blocks = max(1, -(-n.n // block)), max(1, -(-n.q // 2048))
    c_block = F.pmod(F.xxhash64(F.lit("c"), "id"), F.lit(c_blocks)).cast("int")
    q_block = F.pmod(F.xxhash64(F.lit("q"), "id"), F.lit(q_blocks)).cast("int")
    cell = ["dim", "c", "q"]
    left = rows.where("q").select("id", "vec", F.size("vec").alias("dim"), q_block.alias("q"),
                                  F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("c"))
    right = rows.select("id", "vec", F.size("vec").alias("dim"), c_block.alias("c"),
                        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q"))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.empty(0, dtype=np.int64)] for _ in range(3)]
        if a.num_rows and b.num_rows:
            (qid, q), (cid, c) = _block(a), _block(b)
            for i, ids, scores in best_in_block(qid, q, cid, c, k):
                for o, v in zip(out, (np.full(len(ids), i), ids, scores)):
                    o.append(v)
        return pa.table({n: np.concatenate(v) for n, v in zip(("query_id", "vec_id", "score"), out)})

    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
