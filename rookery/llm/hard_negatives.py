"""Hard-negative mining over a secondary-sort shuffle.

An anchor's positives are its ``positives`` best rows of the same label. Each
opens a window of scores, ``low`` to ``high`` per cent of its own, and the best
``negatives`` rows of other labels inside the window are its hard negatives.

Scored pairs are keyed ``(anchor, descending score, id)`` and dealt by anchor
with a sort inside the partitions, so a task reads an anchor's pairs from the
best down as a stream: a positive opens its window, a negative goes to the open
windows that it fits and that are not full. What is held is the open windows, at
most ``positives`` of them, never an anchor's pairs.

Not every pair is dealt. Anchors meet all rows in blocks of at most about
``block`` anchors and ``block`` rows. A first pass keeps an anchor's best
positives of each block; with the windows known, a second keeps, of each block
and window, the best ``negatives``. A row that is among the first of a window is
among the first of its block, so none is lost, and an anchor's stream has at
most ``positives * (negatives + 1)`` rows a block.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; of rows sharing an id the smallest vector, then label,
counts; an anchor meets only vectors of its own length; ties go to the smaller
id; fewer positives or negatives give fewer rows; a positive below zero opens an
empty window, one of score zero a window of zeros; scores that a long cannot hold
are not defined; empty tables give none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rookery.llm.cluster import ship
from rookery.session import cut_lineage

SLICE = 256  # anchors whose scores with a block are held at a time


def best(scores: np.ndarray, ok: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best of those that are ``ok``, ties to the earlier."""
    at = np.flatnonzero(ok)
    if len(at) > k:
        s = scores[at]
        at = at[s >= np.partition(s, len(s) - k)[len(s) - k]]
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and most score of a negative of a positive with ``score``."""
    return -(-low * score // 100), high * score // 100


def _matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids in ascending order, labels, vectors."""
    ids = t.column("id").to_numpy()
    x = t.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    order = np.argsort(ids)
    return ids[order], t.column("label").to_numpy()[order], x[order]


def scored(a: pa.Table, c: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each anchor: its id and label, and the block's ids, labels and scores."""
    aid, alabel, x = _matrix(a)
    cid, clabel, y = _matrix(c)
    most = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * max(1, x.shape[1])
    if most < 2 ** 52:  # exact in doubles
        x, y = x.astype(np.float64), y.astype(np.float64)
    for at in range(0, len(aid), SLICE):
        for i, row in enumerate((x[at:at + SLICE] @ y.T).astype(np.int64), at):
            yield int(aid[i]), int(alabel[i]), cid, clabel, row


def _pairs(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    out = {"anchor_id": [np.full(len(ids), a) for a, ids, _ in rows], "id": [ids for _, ids, _ in rows], "score": [s for *_, s in rows]}
    return pa.table({k: np.concatenate([np.empty(0, dtype=np.int64), *v]) for k, v in out.items()})


def hard_negatives(df: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, low: int = 50,
                   high: int = 95, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding",
                   block: int = 4096) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` with integer inner products of ``floor(scale * x)``."""
    ship(df.sparkSession)
    vec = F.col(f"`{vec_col}`")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = (df.where(F.col(f"`{id_col}`").isNotNull() & vec.isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
                    label.cast("long").alias("label"), F.transform(vec, lambda x: F.floor(x.cast("double") * scale)).alias("vec"))
            .where(F.col("label").isNotNull()))
    rows = cut_lineage(rows.groupBy("id").agg(F.max("anchor").alias("anchor"), F.min(F.struct("vec", "label")).alias("row"))
                       .select("id", "anchor", "row.label", "row.vec", F.size("row.vec").alias("dim")))
    n = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors")).first()
    a_blocks, c_blocks = max(1, -(-n.anchors // block)), max(1, -(-n.rows // block))
    cell = ["dim", "c", "a"]
    of_anchor, of_row = (F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(blocks)).cast("int") for k, blocks in (("a", a_blocks), ("c", c_blocks)))
    own = [F.col(c).alias(c) for c in ("id", "label", "vec", "dim")]  # columns of their own beside the anchors'
    candidates = rows.select(*own, of_row.alias("c"), F.explode(F.sequence(F.lit(0), F.lit(a_blocks - 1))).alias("a"))
    anchors = rows.where("anchor").select("id", "label", "vec", "dim", of_anchor.alias("a"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("c")

    def positives_of(a: pa.Table, c: pa.Table) -> pa.Table:
        found = []
        if a.num_rows and c.num_rows:
            for aid, alabel, ids, labels, scores in scored(a, c):
                at = best(scores, (labels == alabel) & (ids != aid), positives)
                found.append((aid, ids[at], scores[at]))
        return _pairs(found)

    def negatives_of(a: pa.Table, c: pa.Table) -> pa.Table:
        found = []
        if a.num_rows and c.num_rows:
            opened = dict(zip(a.column("id").to_pylist(), a.column("opened").to_pylist()))
            for aid, alabel, ids, labels, scores in scored(a, c):
                other, at = labels != alabel, [np.empty(0, dtype=np.int64)]
                for score in set(opened[aid]):
                    least, most = window(score, low, high)
                    if least <= most:
                        at.append(best(scores, other & (scores >= least) & (scores <= most), negatives))
                at = np.unique(np.concatenate(at))
                found.append((aid, ids[at], scores[at]))
        return _pairs(found)

    pair = "anchor_id long, id long, score long"
    some = (anchors.select("*", everywhere).groupBy(*cell).cogroup(candidates.groupBy(*cell)).applyInArrow(positives_of, pair))
    first = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "id")
    near = cut_lineage(some.withColumn("r", F.row_number().over(first)).where(F.col("r") <= positives).drop("r"))
    opened = near.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list("score").alias("opened"))  # at most `positives`
    hard = (anchors.join(opened, "id").select("id", "label", "vec", "opened", "dim", "a", everywhere)
            .groupBy(*cell).cogroup(candidates.groupBy(*cell)).applyInArrow(negatives_of, pair))
    # positives stand before negatives of the same score, for a window of zeros
    keyed = (near.withColumn("kind", F.lit(0)).unionByName(hard.withColumn("kind", F.lit(1)))
             .select("anchor_id", (-F.col("score")).alias("falling"), "kind", "id"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, open_ = None, []
        for b in batches:
            out = []
            for aid, falling, kind, i in zip(*(c.to_pylist() for c in b.columns)):
                if aid != anchor:
                    anchor, open_ = aid, []
                score = -falling
                if kind == 0:
                    least, most = window(score, low, high)
                    if least <= most:
                        open_.append([i, score, least, most, 0])
                    continue
                for w in open_:
                    if w[2] <= score <= w[3] and w[4] < negatives:
                        w[4] += 1
                        out.append((aid, w[0], w[4], i, w[1], score))
                open_ = [w for w in open_ if w[4] < negatives and w[2] <= score]
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 2 else pa.int64()) for k, c in enumerate(cols)],
                                             names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return (keyed.repartition("anchor_id").sortWithinPartitions("anchor_id", "falling", "kind", "id")
            .mapInArrow(stream, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"))
