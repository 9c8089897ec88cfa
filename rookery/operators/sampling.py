"""Keyed sampling, quotas and splits.

Every draw is ``hash_uniform(seed, key)``, so results do not depend on
partitioning, retries or arrival order.

Exact ranks over large groups (a quota per source, a global split) would
need one window task per group. ``bucketed_rank`` avoids that: the draw's
leading bits pick one of ``n_buckets`` buckets, a partial aggregate counts
rows per (group, bucket), a running sum over that small count table gives each
bucket's offset, and rows are ranked only inside their own bucket. The
result equals ``row_number() OVER (PARTITION BY group ORDER BY u, tie)``,
and no task holds more than one bucket.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rookery.functions.casts import rating_or_default

DEFAULT_BUCKETS = 1 << 16


def bucketed_rank(df: DataFrame, u: str, tie: list[str], group: list[str] | None = None,
                  limit: Column | int | None = None, n_buckets: int = DEFAULT_BUCKETS,
                  small_groups: bool = False, rank_col: str = "rank") -> DataFrame:
    """Exact 1-based rank by ``(u, *tie)`` within ``group`` (``u`` in [0, 1)).

    ``limit`` (a literal or a column already on ``df``) prunes whole buckets
    that start at or after it, so only about ``limit`` rows reach the final
    window. ``small_groups`` states that the number of groups is bounded by
    construction (a fixed list of sources, or no groups), which bounds the
    offset table at ``groups * n_buckets`` rows and allows broadcasting it.
    """
    group = list(group or [])
    d = df.withColumn("_b", F.least(F.floor(F.col(u) * n_buckets).cast("int"), F.lit(n_buckets - 1)))
    counts = d.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*group, "_b", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    offs = F.broadcast(offs) if small_groups else offs
    j = d.join(offs, [*group, "_b"])
    if limit is not None:
        lim = limit if isinstance(limit, Column) else F.lit(limit)
        j = j.filter(F.col("_off") < lim)
    wr = Window.partitionBy(*group, "_b").orderBy(F.col(u), *[F.col(t) for t in tie])
    out = j.withColumn(rank_col, (F.col("_off") + F.row_number().over(wr)).cast("bigint"))
    if limit is not None:
        out = out.filter(F.col(rank_col) <= lim)
    return out.drop("_b", "_off")


# --- fixed values -----------------------------------------------------------
# Average-rating bands -> keep weight (largest threshold <= rating wins;
# 0.01 below every band).
ELO_WEIGHTS = [(1200, 0.05), (1400, 0.10), (1600, 0.15), (1800, 0.25),
               (2000, 0.30), (2200, 0.20), (2400, 0.10)]
ELO_WEIGHT_FLOOR = 0.01
# --- end of fixed values -----------------------------------------------------


def band_table(spark: SparkSession, bands=ELO_WEIGHTS) -> DataFrame:
    """Bands as ``[lo, hi)`` rows; a handful of rows, broadcast by construction."""
    rows = []
    srt = sorted(bands)
    for i, (lo, wgt) in enumerate(srt):
        hi = srt[i + 1][0] if i + 1 < len(srt) else None
        rows.append((float(lo), None if hi is None else float(hi), float(wgt)))
    return F.broadcast(spark.createDataFrame(rows, "lo DOUBLE, hi DOUBLE, weight DOUBLE"))


def band_asof_join(df: DataFrame, value: str, bands: DataFrame, floor_weight: float) -> DataFrame:
    """Largest threshold <= value (as-of join) against a broadcast band table."""
    cond = (F.col(value) >= F.col("lo")) & (F.col("hi").isNull() | (F.col(value) < F.col("hi")))
    j = df.join(bands, cond, "left")
    return j.withColumn("weight", F.coalesce(F.col("weight"), F.lit(floor_weight))).drop("lo", "hi")


def with_avg_elo(games: DataFrame, default: int = 1500, zero_is_missing: bool = True) -> DataFrame:
    w = rating_or_default("white_elo", default, zero_is_missing)
    b = rating_or_default("black_elo", default, zero_is_missing)
    return games.withColumn("avg_elo", (w + b) / F.lit(2.0))


@dataclass(frozen=True)
class QuotaParams:
    target_size: int = 5000
    games_ratio: float = 0.7
    n_buckets: int = DEFAULT_BUCKETS


def quota_targets(spark: SparkSession, p: QuotaParams) -> DataFrame:
    games_target = int(p.target_size * p.games_ratio)
    return F.broadcast(spark.createDataFrame(
        [("game", games_target), ("puzzle", p.target_size - games_target)], "source STRING, target BIGINT"))


def source_quota(positions: DataFrame, targets: DataFrame, u: str, tie: list[str],
                 n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Exact per-source quota: the ``target`` rows with the smallest draws."""
    j = positions.join(targets, "source")
    # the targets are a fixed list of sources
    return bucketed_rank(j, u, tie, ["source"], limit=F.col("target"), n_buckets=n_buckets, small_groups=True)


def quota_shortfall(positions: DataFrame, targets: DataFrame) -> DataFrame:
    avail = positions.groupBy("source").agg(F.count(F.lit(1)).alias("available"))
    j = targets.join(avail, "source", "left")
    a = F.coalesce(F.col("available"), F.lit(0))
    return j.select("source", "target", a.alias("available"),
                    F.greatest(F.col("target") - a, F.lit(0)).alias("shortfall"),
                    (a < F.col("target")).alias("exhausted"))


def buffered_holdout_split(df: DataFrame, key: str, seed: int = 42, holdout: int = 500,
                           extra: int = 5000, u: str = "u") -> DataFrame:
    """The buffered form of :func:`holdout_split`: shuffle the first
    ``holdout + extra`` rows (by ``key``) with a keyed draw and hold out the
    first ``holdout`` of them. ``key`` is unique. The shuffle window spans only
    the buffer, whose size is the parameter."""
    first = df.select(key).orderBy(key).limit(holdout + extra)
    thr = F.broadcast(first.agg(F.max(key).alias("_thr")))
    d = df.crossJoin(thr).withColumn("_in", F.coalesce(F.col(key) <= F.col("_thr"), F.lit(False)))
    buf = d.filter("_in").withColumn(u, hash_uniform_col(seed, key))
    r = F.row_number().over(Window.orderBy(F.col(u), F.col(key)))
    buf = buf.withColumn("_r", r.cast("bigint"))
    buf = buf.select(*df.columns,
                     F.when(F.col("_r") <= holdout, F.lit("eval")).otherwise(F.lit("train")).alias("split"),
                     F.lit(0).alias("segment"),
                     F.when(F.col("_r") <= holdout, F.col("_r")).otherwise(F.col("_r") - holdout).alias("ord"))
    rest = d.filter(~F.col("_in")).select(*df.columns, F.lit("train").alias("split"),
                                          F.lit(1).alias("segment"), F.col(key).cast("bigint").alias("ord"))
    return buf.unionByName(rest)


def holdout_split(df: DataFrame, key: str, seed: int = 42, holdout: int = 500, u: str = "u") -> DataFrame:
    """Hold out the ``holdout`` rows with the smallest keyed draws of the whole
    table; the train stream is the rest in draw order. Adds split, segment
    (0: eval, 1: train) and ord (the draw's bits, which order both)."""
    d = df.withColumn(u, hash_uniform_col(seed, key))
    out = label_smallest(d, u, key, F.lit(holdout), flag="_eval")
    bits = (F.col(u) * F.lit(float(1 << 52))).cast("bigint")
    return (out.withColumn("split", F.when(F.col("_eval"), F.lit("eval")).otherwise(F.lit("train")))
            .withColumn("segment", F.when(F.col("_eval"), 0).otherwise(1)).withColumn("ord", bits)
            .select(*df.columns, "split", "segment", "ord"))


def hash_uniform_col(seed: int, key: str) -> Column:
    from rookery.functions.draws import hash_uniform
    return hash_uniform(seed, F.col(key))


def label_smallest(df: DataFrame, u: str, key: str, k: Column, n_buckets: int = DEFAULT_BUCKETS,
                   flag: str = "selected") -> DataFrame:
    """Flag the ``k`` rows with the smallest ``(u, key)`` without a join back:
    the bucketed rank finds the k-th row, a one-row threshold is broadcast
    and every row is labelled in a single pass."""
    top = bucketed_rank(df.withColumn("_k", k), u, [key], limit=F.col("_k"), n_buckets=n_buckets, small_groups=True)
    thr = top.agg(F.max_by(F.struct(F.col(u).alias("_tu"), F.col(key).alias("_tk")), F.col("rank")).alias("_t"))
    j = df.crossJoin(F.broadcast(thr))
    tu, tk = F.col("_t._tu"), F.col("_t._tk")
    sel = (F.col(u) < tu) | ((F.col(u) == tu) & (F.col(key) <= tk))
    return j.withColumn(flag, F.coalesce(sel, F.lit(False))).drop("_t", "_k")


def fraction_split(df: DataFrame, key: str, seed: int = 42, test_fraction: float = 0.05,
                   u: str = "u") -> DataFrame:
    """Exactly ``ceil(test_fraction * n)`` test rows: the smallest draws."""
    d = df.withColumn(u, hash_uniform_col(seed, key))
    n = F.broadcast(d.agg(F.count(F.lit(1)).alias("_n")))
    d = d.crossJoin(n)
    k = F.ceil(F.col("_n") * F.lit(float(test_fraction)))
    out = label_smallest(d, u, key, k, flag="_test")
    return out.withColumn("split", F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("train"))) \
        .drop("_test", "_n")


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42, u: str = "u") -> DataFrame:
    """n rows without replacement: the smallest keyed draws of all rows."""
    d = df.withColumn(u, hash_uniform_col(seed, key))
    return bucketed_rank(d, u, [key], limit=n, small_groups=True, rank_col="pick")


def head_n(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def ratio_interleave(spark: SparkSession, positions: DataFrame, n_slots: int, puzzle_ratio: float = 0.3,
                     seed: int = 42, order: tuple[str, ...] = ("id", "idx"), u: str = "u") -> DataFrame:
    """Slot i takes a puzzle when its draw is below ``puzzle_ratio``, else a
    game; the k-th slot of a source takes the source's position with the k-th
    smallest draw ``u``, recycling the source when it runs out.

    Every position of a source is eligible; whole draw buckets beyond the
    slots are pruned before ranks are made, so no task sees a whole source."""
    from rookery.functions.draws import hash_uniform
    slots = spark.range(n_slots).select(F.col("id").alias("slot"))
    slots = slots.withColumn("source", F.when(hash_uniform(seed, F.lit("slot"), F.col("slot")) < puzzle_ratio,
                                              F.lit("puzzle")).otherwise(F.lit("game")))
    slots = slots.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy("slot")))
    counts = positions.groupBy("source").agg(F.count(F.lit(1)).alias("ns"))
    heads = bucketed_rank(positions, u, list(order), ["source"], limit=n_slots, small_groups=True, rank_col="r")
    s = slots.join(F.broadcast(counts), "source")  # two sources
    s = s.withColumn("r", ((F.col("k") - 1) % F.col("ns")) + 1)
    return s.join(heads, ["source", "r"]).drop("r", "k", "ns")


def dense_order(df: DataFrame, order: list[str], col: str = "stream_pos") -> DataFrame:
    """Dense 1-based position in the global order of ``order`` columns.

    A range-partitioned sort (sampled bounds, as in a global ``orderBy``)
    puts each key range in one partition; the frame is checkpointed to the
    shared checkpoint folder so partition ids stay fixed if executors are
    lost; per-partition counts (one row per partition) give the offsets."""
    from rookery.session import cut_lineage
    d = df.repartitionByRange(*order).sortWithinPartitions(*order)
    d = d.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    d = cut_lineage(d)
    counts = d.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"), F.min("_i").alias("_i0"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_p", "_i0", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    j = d.join(F.broadcast(offs), "_p")
    return j.withColumn(col, (F.col("_off") + F.col("_i") - F.col("_i0") + 1).cast("bigint")) \
        .drop("_p", "_i", "_i0", "_off")
