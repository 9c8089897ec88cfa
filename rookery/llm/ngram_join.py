"""N-gram Jaccard join with signature trees.

A document is the set of its distinct word shingles (64-bit hashes); equal sets
are one class. Two sets with ``Jaccard >= t`` share a shingle among the first
``n - ceil(t * n) + 1`` of each in any common order. The order used: shingles
of a fixed part of the hash space (a little more than a prefix needs), the rarer
the earlier, then the others. Only the former are counted across the corpus, and
a set whose prefix no other set holds is alone at once. Sets that share a
shingle of their prefixes are in one cluster.

Within a cluster a signature tree is built: a leaf holds a few sets of near size,
every node the OR of their token bitmaps, the range of their sizes, and by how
much a bitmap falls short of its set at most. A traversal of node pairs prunes
those whose largest possible overlap is too small; in the leaves bitmaps that
differ in too many bits are pruned, then sets are compared exactly. Pairs that
are linked already, directly or through others, need no comparison, so a group
of near copies costs about as many comparisons as members and no pair list.

Clusters of any size are linked by ``cells.linked_parts``: near copies first, in
blocks that share some sets, so that nothing is made for each shingle of a group of
near copies. Only the sets that stay apart from the largest part of a large cluster
are clustered again, with all their shingles in order of their counts among them,
so that sets which only share a common passage leave it.

Defined results: null or blank text has no shingles and links with nothing;
fewer words than a shingle make one shingle of all words; copies, also in
repeated rows, are one component; a null id is never a component's name unless
all its ids are null; an empty table gives an empty result. Only the id and
text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm import sketch
from rookery.llm import words as W
from rookery.llm.cells import gather_sets, linked_parts, named
from rookery.llm.cluster import ship
from rookery.llm.components import components
from rookery.session import cut_lineage

U = np.uint64
LEAF = 16
FANOUT = 4
BITS = 2048
BLOCK = PIVOTS = None  # of a cluster; None: those of ``cells``


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for t in W.texts(column):
        h = t.hashes(lower=True)
        g = W.grams(h, n)
        for a, b in zip(t.first[:-1].tolist(), t.first[1:].tolist()):
            if b - a >= n:
                yield np.unique(g[a:b - n + 1])
            elif b > a:
                yield W.mix(W.grams(h[a:b], b - a) + U(b - a))
            else:
                yield np.empty(0, dtype=np.uint64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).view(np.int64)))


def set_id(s: np.ndarray) -> int:
    """64-bit name of a set (signed)."""
    x = xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s))
    return x - (1 << 64) if x >= 1 << 63 else x


def needed(n: int, percent: int) -> int:
    """Least overlap with a set of ``n`` that a partner must have."""
    return -(-percent * n // 100)


# ---- the comparison of a block -----------------------------------------------

class Links:
    """Union-find over the sets of a block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


class Tree:
    """Signature tree over sets in ascending size; level 0 are the leaves."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        bitmaps = np.zeros((len(sets), BITS // 64), dtype=np.uint64)
        for i, s in enumerate(sets):
            at = (s % U(BITS)).astype(np.int64)
            np.bitwise_or.at(bitmaps[i], at >> 6, U(1) << (at & 63).astype(np.uint64))
        self.bitmaps = bitmaps
        short = self.sizes - np.bitwise_count(bitmaps).sum(axis=1)
        starts = np.arange(0, len(sets), LEAF)
        level = (np.bitwise_or.reduceat(bitmaps, starts, axis=0), np.minimum.reduceat(self.sizes, starts),
                 np.maximum.reduceat(self.sizes, starts), np.maximum.reduceat(short, starts))
        self.levels = [level]
        while len(level[0]) > 1:
            starts = np.arange(0, len(level[0]), FANOUT)
            level = (np.bitwise_or.reduceat(level[0], starts, axis=0), np.minimum.reduceat(level[1], starts),
                     np.maximum.reduceat(level[2], starts), np.maximum.reduceat(level[3], starts))
            self.levels.append(level)

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Which node pairs may hold a linked pair."""
        bitmap, least, most, short = self.levels[level]
        near = (100 * most[a] >= percent * least[b]) & (100 * most[b] >= percent * least[a])
        common = np.bitwise_count(bitmap[a] & bitmap[b]).sum(axis=1).astype(np.int64)
        overlap = np.minimum(np.minimum(most[a], most[b]), common + np.minimum(short[a], short[b]))
        return near & ((100 + percent) * overlap >= percent * (least[a] + least[b]))

    def leaf_pairs(self, percent: int) -> Iterator[tuple[int, int]]:
        """Dual traversal from the root."""
        a = b = np.zeros(1, dtype=np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            keep = self.possible(level, a, b, percent)
            a, b = a[keep], b[keep]
            if level:
                n = len(self.levels[level - 1][0])
                i = (a[:, None, None] * FANOUT + np.arange(FANOUT)[None, :, None])
                j = (b[:, None, None] * FANOUT + np.arange(FANOUT)[None, None, :])
                i, j = (x.reshape(-1) for x in np.broadcast_arrays(i, j))
                keep = (i <= j) & (j < n)
                a, b = i[keep], j[keep]
        yield from zip(a.tolist(), b.tolist())


def link_block(sets: list[np.ndarray], percent: int, links: Links, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the sets' parts (indices into ``sets``, which are in
    ascending size). ``side``: a pair counts only if the two are of different sides."""
    tree, found = Tree(sets), []
    sizes, bitmaps, n = tree.sizes, tree.bitmaps, len(sets)
    for x, y in tree.leaf_pairs(percent):
        i, j = np.arange(x * LEAF, min(n, (x + 1) * LEAF)), np.arange(y * LEAF, min(n, (y + 1) * LEAF))
        ri, rj = np.array([links.find(k) for k in i.tolist()]), np.array([links.find(k) for k in j.tolist()])
        apart = ri[:, None] != rj[None, :]
        if x == y:
            apart &= i[:, None] < j[None, :]
        if side is not None:
            apart &= side[i][:, None] != side[j][None, :]
        if not apart.any():
            continue
        differ = np.bitwise_count(bitmaps[i][:, None, :] ^ bitmaps[j][None, :, :]).sum(axis=2).astype(np.int64)
        both = sizes[i][:, None] + sizes[j][None, :]
        near = apart & ((100 + percent) * differ <= (100 - percent) * both)
        for p, q in zip(*(k.tolist() for k in np.nonzero(near))):
            u, v = int(i[p]), int(j[q])
            if links.find(u) == links.find(v):
                continue
            a, b = sets[u], sets[v]
            at = np.searchsorted(b, a)
            at[at == len(b)] = 0
            common = int((b[at] == a).sum()) if len(b) else 0
            if 100 * common >= percent * (len(a) + len(b) - common):
                links.join(u, v)
                found.append((u, v))
    return found


# ---- the join ----------------------------------------------------------------

def jaccard_components(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text", most_counts: int = sketch.MOST_COUNTS) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_hash`` for each row.
    ``component_id``: the smallest id that links of ``Jaccard >= percent / 100``
    reach; ``text_hash``: ``xxhash64`` of the text, which with the id tells the row."""
    spark = df.sparkSession
    ship(spark)
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    sampled = U(max(1, int(100 / (1.25 * (100 - percent)))) if percent < 100 else 64)

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sizes, names, some, rest = [], [], [], []
            for s in shingle_sets(b.column(1), n):
                first = s % sampled == U(0)
                prefix = len(s) - needed(len(s), percent) + 1
                some.append(s[first])
                rest.append(s[~first][:max(0, prefix - len(some[-1]))])
                sizes.append(len(s))
                names.append(set_id(s))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()),
                                              _lists(some), _lists(rest)], names=["doc_id", "text_hash", "n", "g", "some", "rest"])

    rows = cut_lineage(docs.mapInArrow(signatures, "doc_id long, text_hash long, n long, g long, some array<long>, rest array<long>"))
    # in the common order sampled shingles come first, the rarer the earlier
    some = rows.where("n > 0").select(F.explode("some").alias("key"), "g")
    repeated = cut_lineage(some.groupBy("key").agg(F.min("g").alias("low"), F.max("g").alias("high"), F.count(F.lit(1)).alias("df"))
                           .where("low < high").select("key", "df"))
    shared = (some.join(repeated, "key").groupBy("g").agg(F.array_sort(F.collect_set(F.struct("df", "key"))).alias("shared")))
    prefix = F.expr(f"n - ({percent} * n + 99) div 100 + 1")
    first = (rows.where("n > 0").groupBy("g").agg(F.first("n").alias("n"), F.first(F.size("some")).alias("some"), F.first("rest").alias("rest"))
             .join(shared, "g", "left").withColumn("shared", F.coalesce("shared", F.array().cast("array<struct<df:bigint,key:bigint>>")))
             .withColumn("room", F.greatest(F.lit(0), (prefix - F.col("some") + F.size("shared"))).cast("int"))
             .select("g", "n", F.concat(F.slice("shared.key", F.lit(1), F.col("room")), "rest").alias("keys")))
    width = max(math.log(100 / percent), 1e-6) * (1 + 1e-6)
    size_class = F.floor(F.log(F.col("n").cast("double")) / width)

    def meet(keys: DataFrame) -> DataFrame:
        """``id, component`` of ``g, key, n``: sets of near sizes that share a key."""
        # linked sets are of the same size class or the next, so they meet under one of two keys
        keyed = cut_lineage(keys.select("g", "key", size_class.alias("c"))
                            .select("g", F.explode(F.array(F.xxhash64("key", "c"), F.xxhash64("key", F.col("c") + 1))).alias("key")))
        hubs = cut_lineage(keyed.groupBy("key").agg(F.min("g").alias("hub"), F.max("g").alias("last")).where("hub < last").select("key", "hub"))
        return components(keyed.join(hubs, "key").select(F.col("hub").alias("u"), F.col("g").alias("v")))

    clusters = meet(first.where(F.size("keys") > 0).select("g", F.explode("keys").alias("key"), "n"))
    # the sets of the clustered classes, one document for each class
    clusters = clusters.withColumnsRenamed({"id": "g", "component": "cell"})
    member = cut_lineage(rows.join(clusters, "g").groupBy("g", "cell").agg(F.min("doc_id").alias("doc_id")))
    sets = gather_sets(docs, member, lambda t: shingle_sets(t, n), set_id)

    def linked(sets: list[np.ndarray], known: list[list[int]], side: np.ndarray | None) -> list[tuple[int, int]]:
        links = Links(len(sets))
        for group in known:
            for i in group[1:]:
                links.join(group[0], i)
        return link_block(sets, percent, links, side)

    def own_keys(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        """The shingles of each set, apart from those of other cells."""
        for cell, x in zip(b.column(1).to_pylist(), b.column(2)):
            yield W.mix(np.frombuffer(x.as_buffer(), dtype="<u8") ^ W.mix(np.array([cell], dtype=np.int64).view(np.uint64)))

    def regroup(apart: DataFrame) -> DataFrame:
        """Clusters by all shingles of the sets, in the order of their counts in the
        cell, so sets that only share a common passage fall apart. Any order that all
        sets have in common will do, so a sketch's counts are good enough; beyond
        what can be broadcast they are exact and joined."""
        apart = apart.select("g", "cell", "shingles")
        slots = sketch.slots_for(apart.agg(F.coalesce(F.sum(F.octet_length("shingles")), F.lit(0)).alias("n")).first().n // 8, each=4, most=None)
        spread = prefixes(apart, slots) if slots <= most_counts else by_join(apart)
        return meet(spread).withColumnsRenamed({"id": "g", "component": "cell"})

    def prefixes(apart: DataFrame, slots: int) -> DataFrame:
        shared = spark.sparkContext.broadcast(sketch.counts(apart, own_keys, slots))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                kept, sizes = [], []
                for k in own_keys(b):
                    df = shared.value[sketch.one_row(k, slots)]
                    first = np.lexsort((k, df))[:len(k) - needed(len(k), percent) + 1]
                    kept.append(k[first[df[first] > 1]])  # counted once, no other set has it
                    sizes.append(len(k))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), _lists(kept)], names=["g", "n", "keys"])

        return apart.mapInArrow(run, "g long, n long, keys array<long>").select("g", F.explode("keys").alias("key"), "n")

    def by_join(apart: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    parts = list(own_keys(b))
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(p) for p in parts], pa.int64()), _lists(parts)], names=["g", "n", "keys"])

        spread = apart.mapInArrow(run, "g long, n long, keys array<long>").select("g", "n", F.explode("keys").alias("key"))
        common = cut_lineage(spread.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
        ordered = (spread.join(common, "key").groupBy("g", "n").agg(F.array_sort(F.collect_list(F.struct("df", "key"))).alias("shared"))
                   .withColumn("room", F.greatest(F.lit(0), prefix - F.col("n") + F.size("shared")).cast("int")))
        return ordered.select("g", F.explode(F.slice("shared.key", F.lit(1), F.col("room"))).alias("key"), "n")

    return named(rows, linked_parts(sets, linked, regroup, BLOCK, PIVOTS)[1])
