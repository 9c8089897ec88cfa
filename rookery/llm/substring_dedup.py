"""Substring dedup: words inside long runs that an earlier document holds.

Count-min prefilter, then exact grouping:

1. Each task counts, in a small count-min sketch, the anchors of its windows: a
   window's anchor is the least hash of the 8-word runs in it, so equal windows
   have equal anchors and neighbours mostly share one. Spark adds the tasks'
   sketches up, with slots in proportion to the input. Slots counted twice or more
   are broadcast as bits while they have at most ``most_slots`` (16 MiB a row of the
   sketch); a larger sketch stays a table, with which each document's anchors are
   joined by slot. The sketch only overestimates, so no repeated window is lost.
2. Windows whose anchor may be repeated are grouped exactly, by a 96-bit hash:
   partial aggregation gives the smallest and largest document id of each.
3. Windows whose smallest id is less than their own document's are joined back
   and gathered by document; the words they cover are removed.

A hot window or a group of copies shrinks to one row a task before the
aggregation's shuffle, and the join back is a plain one that adaptive execution
splits.

Defined results: null text has no words; a document shorter than a window is
kept; a null id is neither before nor after another, so such rows keep all;
rows that share an id do not remove each other's words; an empty table gives an
empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rookery.llm import sketch
from rookery.llm import words as W
from rookery.llm.cluster import ship
from rookery.session import cut_lineage

ANCHOR = 8


def _least(x: np.ndarray, k: int) -> np.ndarray:
    """Least of every ``k`` consecutive values."""
    width = 1
    while 2 * width <= k:
        x = np.minimum(x[:len(x) - width], x[width:])
        width *= 2
    over = k - width
    return np.minimum(x[:len(x) - over], x[over:]) if over else x


def _anchors(t: W.Texts, h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the texts (first word) and the anchor of each."""
    at = t.inside(window)
    if not len(at):
        return at, np.empty(0, dtype=np.uint64)
    size = min(ANCHOR, window)
    return at, _least(W.grams(h, size), window - size + 1)[at]


def _once(at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Where a window's anchor is not the one of the window before it in the text."""
    new = np.ones(len(at), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    return new


def _covered(n: int, at: np.ndarray, window: int) -> np.ndarray:
    step = np.bincount(at, minlength=n + window + 1) - np.bincount(at + window, minlength=n + window + 1)
    return np.cumsum(step)[:n] > 0


def repeated_windows(docs: DataFrame, window: int, most_slots: int = sketch.MOST_SLOTS) -> DataFrame:
    """``doc_id, check, positions``: first words of each document's windows that
    also start in a document with a smaller id. ``docs``: ``doc_id, check, text``."""
    spark = docs.sparkSession
    ship(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = sketch.slots_for(size // 120, most=None)  # about six bytes a word, an anchor every twenty words

    def keys(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        for t in W.texts(b.column(0)):
            at, anchor = _anchors(t, t.hashes(), window)
            yield anchor[_once(at, anchor)]

    if slots <= most_slots:
        shared = spark.sparkContext.broadcast(sketch.repeated(docs.select("text"), keys, slots))
        read = docs.select("doc_id", "check", "text")
    else:
        shared = None
        read = docs.join(_kept_anchors(docs, keys, window, slots), ["doc_id", "check"]).select("doc_id", "check", "text", "anchors")
    names = ["w1", "w2", "doc_id", "check", "at"]

    def maybe(anchor: np.ndarray, owner: np.ndarray, kept: pa.Array | None) -> np.ndarray:
        if shared is not None:
            return sketch.maybe_repeated(shared.value, anchor)
        hit = np.zeros(len(anchor), dtype=bool)
        for i in np.unique(owner).tolist():
            own = owner == i
            hit[own] = np.isin(anchor[own], kept[i].values.to_numpy().view(np.uint64))
        return hit

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            for t in W.texts(b.column(2)):
                h = t.hashes()
                at, anchor = _anchors(t, h, window)
                if not len(at):
                    continue
                new = _once(at, anchor)
                hit = maybe(anchor[new], t.owner[at[new]] + t.row, b.column(3) if shared is None else None)[np.cumsum(new) - 1]
                if not hit.any():
                    continue
                at = at[hit]
                owner = t.owner[at]
                rows = pa.array(owner + t.row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.grams(h, window)[at].view(np.int64)),
                     pa.array((W.grams(h, window, 1)[at] >> W.U(32)).astype(np.uint32).view(np.int32)), b.column(0).take(rows), b.column(1).take(rows), pa.array((at - t.first[owner]).astype(np.int32))],
                    names=names)

    found = read.mapInArrow(windows, "w1 long, w2 int, doc_id long, check int, at int")
    first = cut_lineage(found.groupBy("w1", "w2").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last"))
                        .where("lead < last").select("w1", "w2", "lead"))
    return (found.join(first, ["w1", "w2"]).where("lead < doc_id")
            .groupBy("doc_id", "check").agg(F.collect_list("at").alias("positions")))


def _kept_anchors(docs: DataFrame, keys, window: int, slots: int) -> DataFrame:
    """``doc_id, check, anchors``: of each document the anchors that both rows of the
    sketch count twice or more, found by joins on the slot."""
    counted = cut_lineage(sketch.merged(docs.select("text"), keys, slots).select("slot"))

    def slotted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in W.texts(b.column(2)):
                at, anchor = _anchors(t, t.hashes(), window)
                new = _once(at, anchor)
                at, anchor = at[new], anchor[new]
                first, second = sketch.rows_of(anchor, slots)
                rows = pa.array(t.owner[at] + t.row) if len(at) else pa.array([], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(anchor.view(np.int64)), pa.array(first), pa.array(second)],
                                                 names=["doc_id", "check", "anchor", "first", "second"])

    found = (docs.where("doc_id IS NOT NULL").select("doc_id", "check", "text")
             .mapInArrow(slotted, "doc_id long, check int, anchor long, first long, second long").distinct())
    for row in ("first", "second"):
        found = found.join(counted.withColumnRenamed("slot", row), row, "left_semi")
    return found.groupBy("doc_id", "check").agg(F.collect_set("anchor").alias("anchors"))


def substring_dedup(df: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text",
                    most_slots: int = sketch.MOST_SLOTS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for each row: the kept words, joined
    by one space."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    docs = docs.withColumn("check", F.hash("text"))
    found = repeated_windows(docs, window, most_slots)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            positions = b.column(2)
            total, removed, kept = [], [], []
            for t in W.texts(b.column(1)):
                for i in range(len(t)):
                    words = t.bytes(i).split()
                    gone = 0
                    if words and positions[t.row + i].is_valid:
                        out = _covered(len(words), positions[t.row + i].values.to_numpy(), window)
                        gone = int(out.sum())
                        words = [w for w, o in zip(words, out.tolist()) if not o]
                    total.append(len(words) + gone)
                    removed.append(gone)
                    kept.append(b" ".join(words).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.string())], names=schema.names)

    joined = docs.join(found, ["doc_id", "check"], "left").select("doc_id", "text", "positions")
    return joined.mapInArrow(cut, schema)
