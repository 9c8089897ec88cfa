"""Conversation prefix trie over double arrays.

A node is a distinct sequence of first turns. Turns are named by 128-bit digests,
texts stay where they are read. A conversation's turns are laid out in segments
of at most ``SEGMENT``, so none is ever gathered whole, and equal segments below
the same node count once, with their members.

Segments stand in the order of their turns and are cut by range into shards; a
shard is a prefix shard, since what its sequences have in common with those of
other shards lies on the paths of its first and last sequence. In a shard the
turns get dense ids, BASE and CHECK are packed over them (child = BASE[node] +
id, CHECK[child] = node), all sequences are walked through the arrays a depth at a
time and the nodes' members, leaves and tokens are added up from the bottom.
Nodes off the two outer paths are done. The outer paths, with what their nodes
have gathered, are the sequences of the next round, two a shard, until one shard
is left: so shared upper nodes are merged globally and no task holds more than a
shard. Conversations beyond ``SEGMENT`` turns take such rounds once more for each
further segment, the deepest first; what hangs below a segment is handed to its
last node.

The digest of the members that end at a node goes over their ids in order and
cannot be put together from parts. Ids are sorted by range and joined to pieces
in as many tasks as there are ranges; one task a node only reads its pieces, as a
stream.

Defined results: a null conversation id takes no part; a null role or text is
empty; null turn numbers come first; rows of one number stand in the order of
their digests; repeated rows are turns of their own; an empty table gives none.
Only the four columns named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rookery.llm.cluster import ship, word_count
from rookery.session import cut_lineage

SEGMENT = 4096       # turns of a row
SHARD = 4096         # sequences of a shard
SHARD_TURNS = 1 << 18
PIECE = 1 << 16      # bytes of a piece of joined ids
ROOT = bytes(16)
NONE = np.iinfo(np.int64).max


# ---- turns -------------------------------------------------------------------

def conversation_turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                       text_col: str = "text") -> DataFrame:
    """``conv, pos, key, words`` for each turn, ``pos`` from 0.

    Turns are sorted by range and numbered within the task; a conversation that
    goes over a border of ranges (at most one a border) gets the rows before it
    added, so a conversation of any length is numbered in many tasks."""
    ship(df.sparkSession)
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = (df.where(F.col(f"`{id_col}`").isNotNull())
             .select(F.col(f"`{id_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                     F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("key"),
                     word_count(text).alias("words")))
    order = ["conv", "turn", "key"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, run = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            conv = b.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            at = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
            if conv[0] == last:
                at[:starts[1] if len(starts) > 1 else len(conv)] += run
            last, run = conv[-1], at[-1] + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], names=["conv", "key", "words", "part", "run"])

    runs = cut_lineage(turns.repartitionByRange(*order).sortWithinPartitions(*order)
                       .select("conv", "key", "words", F.spark_partition_id().alias("part"))
                       .mapInArrow(number, "conv long, key string, words long, part int, run long"))
    pieces = runs.groupBy("conv", "part").agg((F.max("run") + 1).alias("rows"))
    across = pieces.groupBy("conv").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select("conv")
    before = (pieces.join(across, "conv")
              .select("conv", "part", F.coalesce(F.sum("rows").over(Window.partitionBy("conv").orderBy("part")
                                                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")))
    # at most two rows for each border of ranges
    return (runs.join(F.broadcast(before), ["conv", "part"], "left")
            .select("conv", (F.col("run") + F.coalesce("before", F.lit(0))).alias("pos"), "key", "words"))


def share_heads(turns: DataFrame, family: int, heads: Callable[[Column], Column], most: int) -> tuple[DataFrame, DataFrame]:
    """Conversation ``c`` begins with the first ``heads(c)`` turns (below ``most``)
    of conversation ``c - c % family``, then come its own from there on. The
    turns, and ``conv, turns`` for all conversations."""
    turns = cut_lineage(turns)
    base, h = F.col("conv") - F.col("conv") % family, heads(F.col("conv")).cast("int")
    lent = (turns.where((F.col("pos") < most - 1) & (F.col("conv") % family == 0)).groupBy(F.col("conv").alias("base"))
            .agg(F.array_sort(F.collect_list(F.struct("pos", "key", "words"))).alias("head")))  # below `most` turns
    known = (turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).withColumn("base", base).join(lent, "base", "left")
             .select("conv", "n", h.alias("h"), F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,key:string,words:bigint>>")),
                                                        F.lit(1), h).alias("head")))
    known = cut_lineage(known.withColumn("held", F.size("head").cast("long")))
    borrowed = known.select("conv", F.explode("head").alias("t")).select("conv", "t.pos", "t.key", "t.words")
    short = known.where("held < h").select("conv", (F.col("h") - F.col("held")).alias("less"))
    own = (turns.where(F.col("pos") >= h).join(short, "conv", "left")
           .select("conv", (F.col("pos") - F.coalesce("less", F.lit(0))).alias("pos"), "key", "words"))
    return borrowed.unionByName(own), known.select("conv", (F.col("held") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("turns"))


# ---- a shard -----------------------------------------------------------------

class DoubleArray:
    """BASE and CHECK over dense ids (from 1) of sorted distinct sequences."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, alphabet: int):
        self.base = np.zeros(2 * len(codes) + alphabet + 2, dtype=np.int64)
        self.check = np.full(len(self.base), -1, dtype=np.int64)
        self.check[0] = 0  # the top stands at 0 and is nobody's child
        self.free = 1
        lengths = np.diff(first)
        todo = [(0, 0, len(lengths))]
        for depth in range(int(lengths.max(initial=0))):
            below = []
            for node, a, b in todo:
                if lengths[a] == depth:  # the sequence that ends here stands first
                    a += 1
                if a == b:
                    continue
                c = codes[first[a:b] + depth]
                starts = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
                children = self.place(node, c[starts])
                below += zip(children.tolist(), (a + starts).tolist(), (a + np.append(starts[1:], b - a)).tolist())
            todo = below

    def place(self, node: int, codes: np.ndarray) -> np.ndarray:
        while self.free < len(self.check) and self.check[self.free] >= 0:
            self.free += 1
        at = max(self.free, int(codes[0]) + 1)  # BASE stays above 0, so no child stands at the top
        for _ in range(64):
            slots = at + (codes - codes[0])
            self.reserve(int(slots[-1]) + 1)
            if (self.check[slots] < 0).all():
                break
            at += 1
        else:  # beyond all that is taken
            at = max(int(np.flatnonzero(self.check >= 0)[-1]) + 1, int(codes[0]) + 1)
            slots = at + (codes - codes[0])
            self.reserve(int(slots[-1]) + 1)
        self.base[node] = at - codes[0]
        self.check[slots] = node
        return slots

    def reserve(self, n: int) -> None:
        if n > len(self.check):
            more = max(n, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        out = self.base[nodes] + codes
        if (self.check[out] != nodes).any():
            raise AssertionError("a sequence left the trie")
        return out


@dataclass
class Rows:
    """Sorted distinct sequences below one node; ``gathered`` has, for each row and
    depth from 0, members, least conversation, children, leaves and saved tokens."""
    tile: bytes
    seqs: list[bytes]
    words: list[np.ndarray]
    gathered: list[np.ndarray]  # of shape (5, length + 1)


ADDED = (0, 2, 3, 4)  # rows of `gathered` that add up; row 1 takes the least


def node_key(tile: bytes, prefix: bytes) -> bytes:
    return hashlib.md5(tile + hashlib.md5(prefix).digest()).digest() if prefix else tile


def shard(rows: Rows, left: bool, right: bool) -> tuple[list[tuple], list[tuple]]:
    """Nodes that are done: ``(key, parent key, parent's conversation, depth,
    members, conversation, children, leaves, saved)``; and the outer paths that
    other shards may share (``left``, ``right``), as rows of the next round."""
    lengths = np.array([len(s) // 16 for s in rows.seqs])
    first = np.concatenate([[0], np.cumsum(lengths)])
    names = np.frombuffer(b"".join(rows.seqs), dtype=[("a", ">u8"), ("b", ">u8")])
    kinds, codes = np.unique(names, return_inverse=True)
    codes = codes.reshape(-1) + 1
    trie = DoubleArray(codes, first, len(kinds))
    got = np.zeros((5, len(trie.check)), dtype=np.int64)
    got[1] = NONE
    words, depth = np.zeros(len(trie.check), dtype=np.int64), np.full(len(trie.check), -1)
    lead = np.zeros(len(trie.check), dtype=np.int64)  # a row below each node
    paths = [np.zeros(int(n) + 1, dtype=np.int64) for n in (lengths[0], lengths[-1])]
    at, live = np.zeros(len(lengths), dtype=np.int64), np.arange(len(lengths))
    flat, flat_words = np.concatenate(rows.gathered, axis=1), np.concatenate([*rows.words, np.empty(0, dtype=np.int64)]).astype(np.int64)
    offset = first[:-1] + np.arange(len(lengths))  # of a row's depth 0 in `flat`
    levels = []
    for d in range(int(lengths.max(initial=0)) + 1):
        if d:
            live = live[lengths[live] >= d]
            at[live] = trie.step(at[live], codes[first[live] + d - 1])
            words[at[live]] = flat_words[first[live] + d - 1]
        nodes = at[live]
        for k in ADDED:
            np.add.at(got[k], nodes, flat[k, offset[live] + d])
        np.minimum.at(got[1], nodes, flat[1, offset[live] + d])
        depth[nodes], lead[nodes] = d, live
        levels.append(np.unique(nodes))
        for path, row in zip(paths, (0, len(lengths) - 1)):
            if d < len(path):
                path[d] = at[row]
    shared = np.zeros(len(trie.check), dtype=bool)
    for path, is_open in zip(paths, (left, right)):
        if is_open:
            shared[path] = True
    for d in range(len(levels) - 1, -1, -1):
        nodes = levels[d][~shared[levels[d]]]
        got[3, nodes] = np.where(got[2, nodes] > 0, got[3, nodes], 1)
        got[4, nodes] += (got[0, nodes] - 1) * words[nodes]
        if d:
            up = trie.check[nodes]
            np.add.at(got[2], up, 1)
            np.add.at(got[3], up, got[3, nodes])
            np.add.at(got[4], up, got[4, nodes])
    done = []
    for d, level in enumerate(levels):
        for node in level[~shared[level]].tolist():
            seq, up = rows.seqs[lead[node]], int(trie.check[node])
            parent = None if not d else node_key(rows.tile, seq[:16 * (d - 1)]) if shared[up] or d == 1 else None
            known = int(got[1, up]) if d > 1 and not shared[up] else None
            done.append((node_key(rows.tile, seq[:16 * d]), parent, known, d, *got[:, node].tolist()))
    kept = []
    for path, row, is_open in zip(paths, (0, len(lengths) - 1), (left, right)):
        if is_open:
            kept.append((rows.seqs[row], rows.words[row], got[:, path].copy()))
            got[:, path], got[1, path] = 0, NONE  # what both paths share is handed over once
    return done, kept


DONE = "key binary, parent_key binary, parent_conv long, depth long, n_convs long, conv_id long, n_children long, n_leaves long, saved_tokens long"
NEXT = "tile binary, seq binary, words array<long>, gathered array<long>"


def _task(level: int, segment: int, last_round: bool, most_rows: int, most_turns: int):
    """A task of a round: its sequences in shards, nodes and rows out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        turns = 0

        def flush() -> pa.RecordBatch:
            done, kept = [], []
            starts = [i for i, r in enumerate(held) if not i or r[0] != held[i - 1][0]]
            for a, b in zip(starts, [*starts[1:], len(held)]):
                tile, seqs, words, gathered = zip(*held[a:b])
                left, right = (not last_round and a == 0), (not last_round and b == len(held))
                d, k = shard(Rows(tile[0], list(seqs), list(words), list(gathered)), left, right)
                done += [(*x[:3], level * segment + x[3], *x[4:]) for x in d]
                kept += [(tile[0], seq, w, g.reshape(-1)) for seq, w, g in k]
            held.clear()
            nodes = [list(c) for c in zip(*done)] if done else [[] for _ in range(9)]
            more = [list(c) for c in zip(*kept)] if kept else [[] for _ in range(4)]
            n, m = len(nodes[0]), len(more[0])
            kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            cols = [c + [None] * m for c in nodes] + [[None] * n + c for c in more]
            names = [x.split(" ")[0] for x in f"{DONE}, {NEXT}".split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

        for b in batches:
            words, gathered = b.column(2), b.column(3)
            for i, (tile, seq) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                n = len(seq) // 16
                g = gathered[i].values.to_numpy()
                if len(g) == 5 * (n + 1):
                    g = g.reshape(5, n + 1).copy()
                else:  # members, least conversation; children, leaves and saved tokens below the last node
                    g = np.concatenate([np.repeat(g[:2, None], n + 1, axis=1), np.zeros((3, n + 1), dtype=np.int64)])
                    g[2:, n] = gathered[i].values.to_numpy()[2:5]
                held.append((tile, seq, words[i].values.to_numpy(), g))
                turns += n + 1
                if not last_round and (len(held) >= most_rows or turns >= most_turns):
                    yield flush()
                    turns = 0
        if held:
            yield flush()
    return run


def _rounds(sequences: DataFrame, level: int, segment: int, shard_rows: int) -> DataFrame:
    """Nodes of the tries of one level (``DONE``); ``sequences`` as ``NEXT``, where
    ``gathered`` has five numbers of a row that has not been in a shard."""
    found = None
    sequences = cut_lineage(sequences)
    while True:
        n = sequences.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("seq") / 16 + 1), F.lit(0)).alias("turns")).first()
        last = n.rows <= shard_rows and n.turns <= SHARD_TURNS
        parts = 1 if last else max(-(-n.rows // shard_rows), -(-int(n.turns) // SHARD_TURNS))
        dealt = sequences.repartition(1) if last else sequences.repartitionByRange(parts, "tile", "seq")
        out = cut_lineage(dealt.sortWithinPartitions("tile", "seq").select("tile", "seq", "words", "gathered")
                          .mapInArrow(_task(level, segment, last, shard_rows, SHARD_TURNS), f"{DONE}, {NEXT}"))
        nodes = out.where(F.col("key").isNotNull()).select(*[x.split(" ")[0] for x in DONE.split(", ")])
        found = nodes if found is None else found.unionByName(nodes)
        if last:
            return found
        sequences = out.where(F.col("tile").isNotNull()).select("tile", "seq", "words", "gathered")


# ---- the trie ----------------------------------------------------------------

def _ends(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of ``key, conv``: ids in order, joined by commas."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, begin, ids, size = None, None, [], 0
        for b in batches:
            out = []
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k != key or size >= PIECE:
                    if ids:
                        out.append((key, begin, ",".join(ids)))
                    key, begin, ids, size = k, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if out:
                yield _batch(out, (pa.binary(), pa.int64(), pa.string()), ("key", "begin", "ids"))
        if ids:
            yield _batch([(key, begin, ",".join(ids))], (pa.binary(), pa.int64(), pa.string()), ("key", "begin", "ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for b in batches:
            out = []
            for k, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if k != key:
                    if sha is not None:
                        out.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            if out:
                yield _batch(out, (pa.binary(), pa.string()), ("key", "ends_sha256"))
        if sha is not None:
            yield _batch([(key, sha.hexdigest())], (pa.binary(), pa.string()), ("key", "ends_sha256"))

    joined = (ends.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
              .mapInArrow(pieces, "key binary, begin long, ids string"))
    return (joined.repartition("key").sortWithinPartitions("key", "begin").mapInArrow(digests, "key binary, ends_sha256 string"))


def _batch(rows: list[tuple], kinds: tuple, names: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=list(names))


def prefix_trie(turns: DataFrame, conversations: DataFrame, segment: int = SEGMENT, shard_rows: int = SHARD) -> DataFrame:
    """A row for each node: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``. ``turns``: ``conv, pos, key, words``;
    ``conversations``: ``conv, turns`` for all, those without turns too."""
    ship(turns.sparkSession)
    root = F.lit(ROOT)
    laid = (turns.groupBy("conv", F.floor(F.col("pos") / segment).cast("int").alias("seg"))
            .agg(F.array_sort(F.collect_list(F.struct("pos", "key", "words"))).alias("t"))
            .select("conv", "seg", F.unhex(F.array_join("t.key", "")).alias("seq"), F.col("t.words").alias("words")))
    bare = conversations.where("turns = 0").select("conv", F.lit(0).alias("seg"), F.lit(b"").alias("seq"), F.array().cast("array<long>").alias("words"))
    laid = cut_lineage(laid.unionByName(bare).withColumn("digest", F.unhex(F.md5("seq"))))
    below = lambda tile, digest: F.unhex(F.md5(F.concat(tile, digest)))  # noqa: E731  as node_key
    # the node that each further segment of a long conversation hangs on
    longer = conversations.where(F.col("turns") > segment).select("conv")
    chained = (laid.select("conv", "seg", "digest").join(longer, "conv").groupBy("conv")
               .agg(F.array_sort(F.collect_list(F.struct("seg", "digest"))).alias("s"))
               .select("conv", F.posexplode(F.aggregate("s", F.array(root), lambda acc, x: F.concat(acc, F.array(below(F.element_at(acc, -1), x["digest"])))))
                       .alias("seg", "tile")))
    placed = cut_lineage(laid.join(chained, ["conv", "seg"], "left").withColumn("tile", F.coalesce("tile", root)))
    top = placed.agg(F.max("seg").alias("seg")).first().seg
    spark = turns.sparkSession
    if top is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                                         "saved_tokens long, ends_sha256 string")
    nodes, hanging = None, None
    for level in range(top, -1, -1):
        distinct = (placed.where(F.col("seg") == level).groupBy("tile", "seq")
                    .agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.first("words").alias("words"), F.first("digest").alias("digest")))
        less = [F.lit(0).cast("long")] * 3
        if hanging is not None:
            distinct = distinct.join(hanging, (F.octet_length("seq") == 16 * segment) & (below(F.col("tile"), F.col("digest")) == F.col("top")), "left")
            less = [F.coalesce(c, F.lit(0)) for c in ("kids", "leaves", "saved")]
        found = _rounds(distinct.select("tile", "seq", "words", F.array("n", "conv", *less).alias("gathered")), level, segment, shard_rows)
        if level:  # the top of a trie is the last node of the segment above
            hanging = found.where(F.col("depth") == level * segment).select(
                F.col("key").alias("top"), F.col("n_children").alias("kids"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
            found = found.where(F.col("depth") > level * segment)
        nodes = found if nodes is None else nodes.unionByName(found)
    last = F.greatest(F.lit(0), F.ceil(F.col("turns") / segment) - 1)
    ends = (placed.join(conversations, "conv").where(F.col("seg") == last)
            .select(F.when(F.octet_length("seq") == 0, F.col("tile")).otherwise(below(F.col("tile"), F.col("digest"))).alias("key"), "conv"))
    parents = nodes.where("n_children > 0").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found_conv"))
    return (nodes.join(parents, "parent_key", "left").join(_ends(ends), "key", "left")
            .select("conv_id", "depth", F.coalesce("parent_conv", "found_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                    "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))
