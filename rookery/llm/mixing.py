"""Mixing sources to target weights by a splitting tree.

Each source's documents fall into blocks by a keyed hash, and the blocks stand
in a keyed order. A source's target makes an exact quota of block draws: whole
rounds over all its blocks, then the first blocks of one more round, the last
of them cut to fit. The quotas of all sources go down a binary tree whose leaves
are the output shards: at each node a multivariate hypergeometric draw splits
them between the children, so every shard gets whole numbers of draws that add
up to the quotas. A shard takes the next draws of each source in the keyed order
and orders its documents by a keyed hash.

Every choice is a hash of the seed and the ids, so reruns agree, whatever the
partitions. What is gathered: one row a source on the driver (at most
``Mix.sources``, or an error), at most ``BLOCKS`` block rows a source in a
window, and the documents of one cut block a source.

Defined results: a null source is a source of its own, after the others; a
document of size 0 or null is never taken; rows that repeat an id are separate
documents; an empty table gives an empty result; input columns named like a new
one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rookery.llm.cluster import ship

BLOCKS = 4096
ROW_BYTES = 256             # of a block's row with its draws, more than it takes
BROADCAST_BYTES = 64 << 20  # a table of blocks beyond this is joined by a shuffle


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (3, 1, 2)  # of the sources by code point, repeating
    share: float = 1.5                    # of all sizes
    most: float = 2.0                     # times a source's size
    shards: int = 32
    seed: int = 20
    tree_seed: int = 20                   # of the splits between shards
    sources: int = 1_000_000              # more are refused: their sizes are one row each on the driver


def targets(sizes: list[int], mix: Mix) -> list[float]:
    """Share out the total by weight; what goes beyond a source's most is
    shared out again among the others."""
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(sizes))]
    out, left = [0.0] * len(sizes), mix.share * sum(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        total = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / total > mix.most * sizes[i]]
        if not above:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in above:
            out[i] = mix.most * sizes[i]
            left -= out[i]
        left = max(left, 0.0)
        open_ = [i for i in open_ if i not in set(above)]
    return out


def shard_quotas(shard: int, shards: int, quotas: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Go down the tree to one leaf: draws of each source in the shards before
    it, and its own."""
    lo, hi, node = 0, shards, 1
    before, have = np.zeros_like(quotas), quotas.copy()
    while hi - lo > 1:
        mid = (lo + hi) // 2
        total = int(have.sum())
        to_left = total * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, node])
        left = rng.multivariate_hypergeometric(have, to_left, method="marginals") if total else have
        if shard < mid:
            have, hi, node = left, mid, 2 * node
        else:
            before, have, lo, node = before + left, have - left, mid, 2 * node + 1
    return before, have


def mix_sources(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size",
                mix: Mix = Mix()) -> DataFrame:
    """All rows and columns of ``df`` with ``source_size``, ``target`` and
    ``draws``: an array of ``(shard, round, words)``, one for each time that
    the mix takes the document (``words``: how many of its words)."""
    spark = df.sparkSession
    ship(spark)
    df = df.drop("source_size", "target", "draws")
    names, at = df.columns, {c.lower(): f"c{i}" for i, c in enumerate(df.columns)}  # own names would clash with some
    df = df.toDF(*at.values())
    id_col, source_col, size_col = (at[c.lower()] for c in (id_col, source_col, size_col))
    source, ident = F.col(f"`{source_col}`").cast("string"), F.col(f"`{id_col}`")
    size = F.coalesce(F.col(f"`{size_col}`"), F.lit(0)).cast("long")
    seed = F.lit(mix.seed)
    totals = (df.groupBy(source.alias("s")).agg(F.sum(size).alias("words"), F.count(F.lit(1)).alias("docs"))
              .limit(mix.sources + 1).collect())
    if len(totals) > mix.sources:
        raise ValueError(f"more than {mix.sources} sources")
    totals.sort(key=lambda r: (r.s is None, r.s or ""))
    wanted = targets([r.words for r in totals], mix)
    plan = [(i, r.s, int(r.words), float(t), min(BLOCKS, int(r.docs)),
             int(round(t)) // r.words if r.words else 0, int(round(t)) % r.words if r.words else 0)
            for i, (r, t) in enumerate(zip(totals, wanted))]
    sources = spark.createDataFrame(plan, "__sid int, __s string, source_size long, target double, __n int, __rounds int, __rest long")

    # a small row a source
    docs = (df.join(F.broadcast(sources), source.eqNullSafe(F.col("__s")), "left")
            .withColumn("__size", size)
            .withColumn("__block", F.pmod(F.xxhash64(seed, F.lit("block"), F.col("__s"), ident), F.col("__n")).cast("int")))
    by_source = Window.partitionBy("__sid").orderBy("__key", "__block")
    blocks = (docs.groupBy("__sid", "__block").agg(F.sum("__size").alias("__block_words"), F.first("__rounds").alias("__rounds"),
                                                   F.first("__rest").alias("__rest"))
              .where("__block_words > 0")
              .withColumn("__key", F.xxhash64(seed, F.lit("order"), F.col("__sid"), F.col("__block")))
              .withColumn("__rank", F.row_number().over(by_source) - 1)
              .withColumn("__count", F.count(F.lit(1)).over(Window.partitionBy("__sid")))
              .withColumn("__until", F.sum("__block_words").over(by_source))
              # words of the last, partial round that fall on this block
              .withColumn("__extra", F.greatest(F.lit(0), F.least("__block_words", F.col("__rest") - F.col("__until") + F.col("__block_words"))))
              .drop("__key", "__until"))
    draws = (blocks.withColumn("__draws", F.col("__rounds") + F.when(F.col("__extra") > 0, 1).otherwise(0))
             .where("__draws > 0")
             .withColumn("__round", F.explode(F.sequence(F.lit(0), F.col("__draws") - 1)))
             .withColumn("__at", F.col("__round") * F.col("__count") + F.col("__rank")))

    quotas = draws.groupBy("__sid").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a source
    vector = np.zeros(len(plan), dtype=np.int64)
    for r in quotas:
        vector[r["__sid"]] = r["n"]
    shards, tree_seed = mix.shards, mix.tree_seed

    def leaves(it):
        for pdf in it:
            for shard in pdf["id"]:
                before, own = shard_quotas(int(shard), shards, vector, tree_seed)
                sid = np.flatnonzero(own)
                yield pd.DataFrame({"__sid": sid.astype(np.int32), "shard": np.int32(shard), "__from": before[sid], "__own": own[sid]})

    ranges = (spark.range(0, shards, 1, min(shards, 8)).mapInPandas(leaves, "__sid int, shard int, __from long, __own long")
              .select("__sid", "shard", F.explode(F.sequence(F.col("__from"), F.col("__from") + F.col("__own") - 1)).alias("__at")))
    placed = (draws.join(ranges, ["__sid", "__at"])
              .groupBy("__sid", "__block").agg(F.array_sort(F.collect_list(F.struct("__round", "shard"))).alias("__placed"),
                                               F.first("__block_words").alias("__block_words"), F.first("__extra").alias("__extra")))

    # how many blocks there are is known, so the size of the table is
    small = sum(p[4] for p in plan) * ROW_BYTES <= BROADCAST_BYTES
    docs = docs.join(F.broadcast(placed) if small else placed, ["__sid", "__block"], "left")
    cut = (F.col("__extra") > 0) & (F.col("__extra") < F.col("__block_words"))
    key = F.xxhash64(seed, F.lit("cut"), ident)
    in_block = Window.partitionBy("__sid", "__block").orderBy("__cut", "__size", ident)
    # one block a source is cut: only its documents are ordered
    partly = (docs.where(cut).withColumn("__cut", key)
              .withColumn("__until", F.sum("__size").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("__take", F.greatest(F.lit(0), F.least("__size", F.col("__extra") - F.col("__until") + F.col("__size"))))
              .drop("__cut", "__until"))
    wholly = (docs.where(~F.coalesce(cut, F.lit(False)))
              .withColumn("__take", F.when(F.col("__extra") > 0, F.col("__size")).otherwise(F.lit(0))))

    taken = F.transform("__placed", lambda d: F.struct(
        d["shard"].alias("shard"), d["__round"].alias("round"),
        F.when(d["__round"] < F.col("__rounds"), F.col("__size")).otherwise(F.col("__take")).cast("long").alias("words")))
    return (wholly.unionByName(partly)
            .withColumn("draws", F.coalesce(F.filter(taken, lambda d: d["words"] > 0),
                                            F.array().cast("array<struct<shard:int,round:int,words:bigint>>")))
            .select(*df.columns, "source_size", "target", "draws").toDF(*names, "source_size", "target", "draws"))


def mixture(mixed: DataFrame, id_col: str = "doc_id", seed: int = 20) -> DataFrame:
    """The shards themselves: a row for each draw, dealt by shard and in the
    shard's keyed order."""
    rows = mixed.withColumn("draw", F.explode("draws"))
    key = F.xxhash64(F.lit(seed), F.lit("shuffle"), F.col("draw.shard"), F.col(f"`{id_col}`"), F.col("draw.round"))
    return (rows.withColumn("__key", key).repartition("draw.shard")
            .sortWithinPartitions("draw.shard", "__key").drop("__key", "draws"))
