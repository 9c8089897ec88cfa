"""MinHash near-dedup by a multi-index Hamming join.

A document is the set of its distinct word shingles; equal sets are one class. A
class has a signature of ``SLOTS`` b-bit min-wise hashes (``b`` = 16), each equal
for two sets with a probability of their Jaccard similarity, so the number of
slots that differ, the signatures' distance, is binomial. ``radius`` is the
distance that a pair at the threshold exceeds with a chance below ``MISS``.

All pairs within the radius are found: the slots are split into
``radius // 2 + 1`` chunks, and by the pigeonhole principle one chunk of such a
pair has at most one error. The error is enumerated: a chunk gives a key for each
of its slots, made of the others, so a pair meets under a key whatever the slot
that differs. Keys are sorted by range, a hot key goes over several tasks, and each
run of equal keys is tied to its first set (those over a border too).

The first pass compares the signatures of these ties only; their components take
in groups of near copies at about one comparison a member and key. Keys whose other
members are all in one component are done. The rest meet in tasks of bounded size
(``cells.across_parts``), which compare all signatures of different components, key
by key or, for a component that stands under many keys, at once.
What is within the radius forms candidate groups, and inside these links are
confirmed on full sets (``cells.linked_parts``).

Defined results: null or blank text has no shingles and links with nothing; fewer
words than a shingle make one shingle of all words; copies, also in repeated rows,
are one component; a null id is never a component's name unless all its ids are
null; an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm import words as W
from rookery.llm.cells import BLOCK, across_parts, gather_sets, linked_parts, named
from rookery.llm.cluster import ship
from rookery.llm.components import components
from rookery.llm.ngram_join import Links, set_id, shingle_sets
from rookery.session import cut_lineage

U = np.uint64
SLOTS = 128
MISS = 1e-6
_draws = np.random.default_rng(12).integers(0, 1 << 64, size=(2, SLOTS), dtype=np.uint64)
FACTORS, SHIFTS = _draws[0] | U(1), _draws[1]


def radius(percent: int, slots: int = SLOTS, miss: float = MISS) -> int:
    """Least distance that a pair with ``Jaccard >= percent / 100`` exceeds with a
    chance of at most ``miss``."""
    p, tail = 1 - percent / 100, 1.0
    for r in range(slots + 1):
        tail -= math.comb(slots, r) * p ** r * (1 - p) ** (slots - r)
        if tail <= miss:
            return r
    return slots


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``SLOTS`` 16-bit values for each (not empty) set."""
    flat = np.concatenate(sets).astype(np.uint64)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), SLOTS), dtype=np.uint16)
    for j in range(SLOTS):
        out[:, j] = W.mix(np.minimum.reduceat(flat * FACTORS[j] + SHIFTS[j], starts)) >> U(48)  # shingle hashes are mixed already
    return out


def chunks(r: int, slots: int = SLOTS) -> np.ndarray:
    """Chunk of each slot; a pair within distance ``r`` has one with at most one error."""
    return np.arange(slots) % (r // 2 + 1)


def keys(sig: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """For each signature and slot, a hash of the chunk's other slots."""
    at = np.arange(sig.shape[1], dtype=np.uint64)
    each = W.mix((at << U(16))[None, :] + sig.astype(np.uint64) + U(1))
    whole = np.zeros((len(sig), int(chunk.max()) + 1), dtype=np.uint64)
    for j, c in enumerate(chunk.tolist()):
        whole[:, c] += each[:, j]
    return W.mix(whole[:, chunk] - each + W.mix(at + U(1 << 32))[None, :])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Slots that differ, for all pairs of two lists of signatures."""
    out = np.empty((len(a), len(b)), dtype=np.int64)
    for i in range(len(a)):
        out[i] = (b != a[i]).sum(axis=1)
    return out


def _near(sig: np.ndarray, r: int, groups: list[list[int]], side: np.ndarray | None) -> tuple[Links, list[tuple[int, int]]]:
    """Pairs within the radius that are not of one group, the nearest first."""
    links = Links(len(sig))
    for g in groups:
        for i in g[1:]:
            links.join(g[0], i)
    root = np.array([links.find(i) for i in range(len(sig))])
    d = distances(sig, sig)
    ok = np.triu(d <= r, 1) & (root[:, None] != root[None, :])
    if side is not None:
        ok &= side[:, None] != side[None, :]
    i, j = np.nonzero(ok)
    order = np.argsort(d[i, j], kind="stable")
    return links, list(zip(i[order].tolist(), j[order].tolist()))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted ``key, g``: ``key, hub, g`` for each row but the first of a key;
    the first and last key of the task with ``hub = g``, to be met by other tasks'."""
    key, hub, opened = None, None, None
    for b in batches:
        if not b.num_rows:
            continue
        k, g = b.column(0).to_numpy(), b.column(1).to_numpy()
        new = np.concatenate([[key is None or k[0] != key], k[1:] != k[:-1]])
        at = np.cumsum(new)
        hubs = np.concatenate([[0 if hub is None else hub], g[new]])[at]
        rest = np.flatnonzero(~new & (g != hubs))
        out = [k[rest], hubs[rest], g[rest]]
        if opened is None:
            opened = int(k[0])
            out = [np.append(x, v) for x, v in zip(out, (k[0], g[0], g[0]))]
        key, hub = int(k[-1]), int(hubs[-1])
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out], names=["key", "hub", "g"])
    if key is not None and key != opened:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (key, hub, hub)], names=["key", "hub", "g"])


def near_duplicates(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, text_hash`` for each row, as
    ``ngram_join.jaccard_components`` has them."""
    ship(df.sparkSession)
    r = radius(percent)
    chunk = chunks(r)
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sets = list(shingle_sets(b.column(1), n))
            some = [s for s in sets if len(s)]
            sig = iter([x.tobytes() for x in signatures(some)] if some else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.int64()),
                 pa.array([next(sig) if len(s) else None for s in sets], pa.binary())], names=["doc_id", "text_hash", "n", "g", "sig"])

    rows = cut_lineage(docs.select("doc_id", "text", "text_hash").mapInArrow(sign, "doc_id long, text_hash long, n long, g long, sig binary"))
    classes = cut_lineage(rows.where("n > 0").groupBy("g").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig")))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint16).reshape(-1, SLOTS)
                yield pa.RecordBatch.from_arrays([pa.array(keys(sig, chunk).view(np.int64).reshape(-1)),
                                                  pa.array(np.repeat(part.column(0).to_numpy(), SLOTS))], names=["key", "g"])

    ties = cut_lineage(classes.select("g", "sig").mapInArrow(spread, "key long, g long")
                       .repartitionByRange("key", "g").sortWithinPartitions("key", "g")
                       .mapInArrow(_runs, "key long, hub long, g long"))
    # keys that go over a border of ranges: at most two rows a task, tied to the least of them
    borders = ties.where("hub = g").groupBy("key").agg(F.collect_set("g").alias("gs")).where(F.size("gs") > 1)
    crossing = borders.select("key", F.array_min("gs").alias("hub"), F.explode("gs").alias("g"))
    tied = cut_lineage(ties.where("hub <> g").unionByName(crossing))

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=np.uint16).reshape(-1, SLOTS) for c in (2, 3))
                near = pa.array((x != y).sum(axis=1) <= r)
                yield pa.RecordBatch.from_arrays([b.column(0).filter(near), b.column(1).filter(near)], names=["u", "v"])

    a, b = (classes.select(F.col("g").alias(x), F.col("sig").alias(f"sig_{x}")) for x in ("u", "v"))

    pairs = tied.where("hub <> g").select(F.col("hub").alias("u"), F.col("g").alias("v")).distinct()
    links = cut_lineage(pairs.join(a, "u").join(b, "v").select("u", "v", "sig_u", "sig_v").mapInArrow(within, "u long, v long"))
    parts = components(links).withColumnsRenamed({"id": "g", "component": "part"})
    # keys whose members, beside the one that all of a key were compared with, are of different parts
    labelled = cut_lineage(tied.join(parts, "g", "left").select("key", "g", F.coalesce("part", "g").alias("part")))
    most = cut_lineage(labelled.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("key")
                       .agg(F.max_by("part", F.struct("n", "part")).alias("most"), F.max("n").alias("big"), F.sum("n").alias("all")).where("big < all"))
    if not most.isEmpty():
        sig = classes.select("g", F.col("sig").alias("shingles"))

        def near(sigs: list[np.ndarray], groups: list[list[int]], side: np.ndarray | None) -> list[tuple[int, int]]:
            linked, found = _near(np.concatenate(sigs).view(np.uint16).reshape(-1, SLOTS), r, groups, side)
            return [linked.join(i, j) or (i, j) for i, j in found if linked.find(i) != linked.find(j)]

        # a large part stands under many keys with much the same others: it meets all of them at
        # once, as one cell, where that deals fewer rows than key by key
        tagged = cut_lineage(labelled.join(most.select("key", "most"), "key"))
        dealt = lambda s, m: s * F.ceil(m / BLOCK) + m * F.ceil(s / BLOCK)
        by_key = most.groupBy("most").agg(F.sum(dealt(F.col("big"), F.col("all") - F.col("big"))).alias("by_key"))
        once = tagged.select("most", "g", (F.col("part") != F.col("most")).alias("other")).distinct()
        whole = cut_lineage(once.groupBy("most").agg(F.count_if("other").alias("m"), F.count_if(~F.col("other")).alias("s"))
                            .join(by_key, "most").where(dealt(F.col("s"), F.col("m")) < F.col("by_key")).select("most"))
        together = cut_lineage(tagged.join(whole, "most"))
        cells = cut_lineage(together.select(F.col("most").alias("cell"), "g", "part").distinct().join(sig, "g"))
        keyed = cut_lineage(tagged.join(whole, "most", "left_anti").select("g", F.col("key").alias("cell"), "part").join(sig, "g"))

        def keys_of(others: DataFrame) -> DataFrame:
            """What stands under one key, of the sets outside the largest parts of their cells."""
            at = cut_lineage(together.select("g", F.col("key").alias("cell")).join(others.select("g").distinct(), "g"))
            return at.join(at.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cell"), "cell")

        links = cut_lineage(links.unionByName(across_parts(keyed, near)).unionByName(across_parts(cells, near, keys_of)))
    groups = components(links).withColumnsRenamed({"id": "g", "component": "cell"})

    def confirmed(sets: list[np.ndarray], known: list[list[int]], side: np.ndarray | None) -> list[tuple[int, int]]:
        linked, found = _near(signatures(sets), r, known, side)
        out = []
        for i, j in found:
            if linked.find(i) != linked.find(j):
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    linked.join(i, j)
                    out.append((i, j))
        return out

    sets = gather_sets(docs, classes.select("g", "doc_id").join(groups, "g"), lambda t: shingle_sets(t, n), set_id)
    return named(rows, linked_parts(sets, confirmed)[1])
