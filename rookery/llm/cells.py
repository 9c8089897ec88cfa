"""Exact links between sets that share a cell, in tasks of bounded size.

A cell of more than ``BLOCK`` sets is dealt into blocks by hash, and some of its
sets, the pivots, join every block; a task links what it holds. Near copies end
up in one part that way, whatever the cell's size, with about one comparison a
set. What stays apart from the cell's largest part then meets all its others, a
pair of blocks in a task. So a task holds at most about two blocks, each pair of
sets of a cell is either linked through others or compared, and no link is lost.
The second pass has about ``M * (S + M) / BLOCK`` rows for ``M`` sets apart among
``S`` of a cell. An operator that can tell which of the ``M`` may be linked with
each other gives ``regroup``, and only ``2 * M * (S - M) / BLOCK`` rows are left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm import sketch
from rookery.llm.components import components
from rookery.session import cut_lineage

BLOCK = 192   # sets of a block, about
PIVOTS = 24   # sets of a large cell that join all its blocks, about

#: Indices of linked pairs of some sets (in ascending size) that join their parts.
#: Given: the sets, a list of those that are linked already (one group each), and
#: the sides of which a pair must have both (or none).
Link = Callable[[list[np.ndarray], list[list[int]], "np.ndarray | None"], list[tuple[int, int]]]


def unpack(t: pa.Table) -> tuple[np.ndarray, list[np.ndarray], list[int]]:
    """Ids, sets and rows of a task, one row an id, in ascending size."""
    ids = t.column("g").to_numpy()
    sets = [np.frombuffer(x.as_buffer(), dtype="<u8") for x in t.column("shingles")]
    order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    seen, out = set(), []
    for i in order:
        if ids[i] not in seen:
            seen.add(ids[i])
            out.append(i)
    return ids[out], [sets[i] for i in out], out


def _edges(ids: np.ndarray, found: list[tuple[int, int]]) -> pa.Table:
    u = np.array([ids[a] for a, _ in found], dtype=np.int64)
    v = np.array([ids[b] for _, b in found], dtype=np.int64)
    return pa.table({"u": u, "v": v})


def linked_parts(sets: DataFrame, link: Link, regroup: Callable[[DataFrame], DataFrame] | None = None,
                 block: int | None = None, pivots: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``sets``: ``g, cell, shingles`` (a set may be in several cells), as a
    written table. The links found (``u, v``) and their components.

    ``regroup``: given the sets (``g, cell, shingles``) that stay apart from the
    largest parts of their cells, says by new cells (``g, cell``) which may be
    linked; of those that share a cell but no new one none may be. ``block`` and
    ``pivots`` stand for ``BLOCK`` and ``PIVOTS``."""
    block, pivots = block or BLOCK, pivots or PIVOTS
    counts = cut_lineage(sets.groupBy("cell").agg(F.count(F.lit(1)).alias("members"))
                         .withColumn("blocks", F.ceil(F.col("members") / block).cast("int")))
    placed = (sets.join(counts, "cell").withColumn("own", F.pmod(F.xxhash64("g"), F.col("blocks")).cast("int"))
              .withColumn("pivot", (F.col("blocks") > 1) & (F.pmod(F.xxhash64(F.lit("pivot"), "g"), F.col("members")) < pivots)))
    in_blocks = placed.withColumn("block", F.explode(F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("blocks") - 1))
                                                     .otherwise(F.array("own"))))

    def within(t: pa.Table) -> pa.Table:
        ids, s, _ = unpack(t)
        return _edges(ids, link(s, [], None))

    links = cut_lineage(in_blocks.select("cell", "block", "g", "shingles").groupBy("cell", "block")
                        .applyInArrow(within, "u long, v long"))
    parts = components(links)
    large = counts.where("blocks > 1").select("cell")
    if large.isEmpty():
        return links, parts
    labelled = cut_lineage(sets.join(large, "cell").join(parts.withColumnRenamed("id", "g"), "g", "left")
                           .withColumn("part", F.coalesce("component", "g")).drop("component"))
    more = across_parts(labelled, link, regroup, block, pivots)
    if more.isEmpty():
        return links, parts
    links = links.unionByName(more)
    return links, components(links)


def across_parts(labelled: DataFrame, link: Link, regroup: Callable[[DataFrame], DataFrame] | None = None,
                 block: int | None = None, pivots: int | None = None) -> DataFrame:
    """``labelled``: ``g, cell, part, shingles``, as a written table. Links between
    sets of a cell that are of different parts, as far as they join parts: those
    outside the cell's largest part meet all others, in pairs of blocks."""
    block, pivots = block or BLOCK, pivots or PIVOTS
    largest = cut_lineage(labelled.groupBy("cell", "part").agg(F.count(F.lit(1)).alias("size"))
                          .groupBy("cell").agg(F.max_by("part", F.struct("size", "part")).alias("largest"), F.sum("size").alias("all"),
                                               F.max("size").alias("most")).where("most < all")
                          .select("cell", "largest", F.ceil((F.col("all") - F.col("most")) / block).cast("int").alias("apart"),
                                  F.ceil(F.col("most") / block).cast("int").alias("together")))
    # blocks numbered with those apart first
    numbered = (labelled.join(largest, "cell").withColumn("minor", F.col("part") != F.col("largest"))
                .withColumn("block", F.when(F.col("minor"), F.pmod(F.xxhash64(F.lit("apart"), "g"), F.col("apart")))
                            .otherwise(F.col("apart") + F.pmod(F.xxhash64(F.lit("apart"), "g"), F.col("together"))).cast("int")))
    others = F.sequence(F.lit(0), F.col("apart") - 1 + F.when(F.col("minor"), F.col("together")).otherwise(0))
    if regroup is not None:  # those apart do not meet each other here
        others = F.when(F.col("minor"), F.sequence(F.col("apart"), F.col("apart") + F.col("together") - 1)).otherwise(F.sequence(F.lit(0), F.col("apart") - 1))
    paired = (numbered.withColumn("other", F.explode(others))
              .select("cell", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "g", "shingles", "part", "block"))

    def across(t: pa.Table) -> pa.Table:
        ids, s, rows = unpack(t)
        of, side = {}, t.column("block").to_numpy()[rows]
        for i, part in enumerate(t.column("part").to_numpy()[rows].tolist()):
            of.setdefault(part, []).append(i)
        alone = t.column("low")[0].as_py() == t.column("high")[0].as_py()
        return _edges(ids, link(s, list(of.values()), None if alone else side))

    more = cut_lineage(paired.groupBy("cell", "low", "high").applyInArrow(across, "u long, v long"))
    if regroup is None:
        return more
    apart = cut_lineage(numbered.where("minor").select("g", "cell", "shingles"))
    again = cut_lineage(apart.drop("cell").join(regroup(apart), "g"))
    return more.unionByName(linked_parts(again, link, None, block, pivots)[0])


def gather_sets(docs: DataFrame, chosen: DataFrame, sets: Callable[[pa.Array], Iterator[np.ndarray]], name: Callable[[np.ndarray], int]) -> DataFrame:
    """``chosen`` (``g, doc_id`` and more) with the sets that ``sets`` makes of the
    texts of ``docs`` (``doc_id, text``), without ``doc_id``. ``name``: a set's ``g``."""
    # a bit for each class, so that other texts go no further than their task
    slots = sketch.slots_for(chosen.count(), each=16)
    held = sketch.bits(chosen.select(F.col("g").bitwiseAND(F.lit(slots - 1)).cast("long").alias("slot")), F.col("slot"), slots)
    wanted = docs.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            found = [(i, name(s), s) for i, s in enumerate(sets(b.column(1))) if len(s)]
            keep = [x for x in found if sketch.has(wanted.value, np.array([x[1] & (slots - 1)]))[0]]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i for i, _, _ in keep], pa.int64())),
                                              pa.array([g for _, g, _ in keep], pa.int64()),
                                              pa.array([s.astype("<u8").tobytes() for _, _, s in keep], pa.binary())],
                                             names=["doc_id", "g", "shingles"])

    own = chosen.withColumnsRenamed({"g": "own_g", "doc_id": "own_id"})
    return cut_lineage(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, g long, shingles binary")
                       .join(own, (F.col("g") == F.col("own_g")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
                       .drop("doc_id", "own_g", "own_id").dropDuplicates(["g"]))


def named(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_hash`` of ``rows`` (``doc_id,
    text_hash, n, g``): a part is called by its smallest id."""
    at = cut_lineage(rows.select("doc_id", "text_hash", "n", "g").join(parts.withColumnRenamed("id", "g"), "g", "left")
                     .select("doc_id", "text_hash", "n", F.coalesce("component", "g").alias("part")))
    leads = cut_lineage(at.where("n > 0").groupBy("part").agg(F.min("doc_id").alias("lead"), F.count(F.lit(1)).alias("copies"))
                        .where("copies > 1").select("part", "lead"))
    return (at.join(leads, "part", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.coalesce("lead", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"), "text_hash"))
