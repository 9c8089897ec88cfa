"""Principal-variation line analytics.

A line is the ordered plies of one position (``pv(pos_id, ply, uci,
forcing)``). Early-break loops become a first-stop index computed with a
running window (gaps and islands), then a filter ``ply <= stop``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LineParams:
    max_quiet: int = 2
    min_moves: int = 2
    refutation_max_len: int = 4
    perpetual_window: int = 6
    perpetual_min_checks: int = 2


def with_quiet_streak(pv: DataFrame) -> DataFrame:
    """``streak`` = consecutive non-forcing plies ending here; ``seen`` =
    a forcing ply occurred at or before this one."""
    w = Window.partitionBy("pos_id").orderBy("ply").rowsBetween(Window.unboundedPreceding, 0)
    last_forcing = F.max(F.when(F.col("forcing"), F.col("ply"))).over(w)
    first_ply = F.min("ply").over(w)
    d = pv.withColumn("_lf", last_forcing).withColumn("_p0", first_ply)
    d = d.withColumn("streak", F.col("ply") - F.coalesce(F.col("_lf"), F.col("_p0") - 1))
    return d.withColumn("seen", F.col("_lf").isNotNull()).drop("_lf", "_p0")


def pv_prune_quiet(pv: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """Keep plies up to the first one where ``max_quiet`` quiet plies follow
    each other and at least ``min_moves`` were kept."""
    d = with_quiet_streak(pv)
    d = d.withColumn("_n", F.row_number().over(Window.partitionBy("pos_id").orderBy("ply")))
    stop = F.min(F.when((F.col("streak") >= p.max_quiet) & (F.col("_n") >= p.min_moves), F.col("_n"))) \
        .over(Window.partitionBy("pos_id"))
    d = d.withColumn("_stop", stop)
    d = d.withColumn("pruned", F.col("_stop").isNotNull())
    return d.filter(F.col("_stop").isNull() | (F.col("_n") <= F.col("_stop"))).drop("_stop", "streak", "seen")


def line_string(df: DataFrame, order: str = "_n", col: str = "uci", out: str = "line") -> DataFrame:
    """Per position: plies joined in order (arrays are bounded by the line)."""
    ordered = F.array_sort(F.collect_list(F.struct(order, col)))
    return df.groupBy("pos_id").agg(F.array_join(F.transform(ordered, lambda x: x[col]), " ").alias(out),
                                    F.count(F.lit(1)).alias("n_plies"))


def pv_key_moments(pv: DataFrame) -> DataFrame:
    d = with_quiet_streak(pv)
    d = d.withColumn("_i", F.row_number().over(Window.partitionBy("pos_id").orderBy("ply")) - 1)
    return d.groupBy("pos_id").agg(
        F.count(F.lit(1)).alias("plies"),
        F.count_if(F.col("forcing")).alias("forcing_count"),
        F.min(F.when(F.col("forcing"), F.col("_i"))).alias("first_forcing_idx"),
        F.min(F.when(~F.col("forcing") & F.col("seen") & (F.col("streak") >= 2), F.col("_i"))).alias("settle_idx"),
    )


def perpetual_indicator(pv: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """Attacker's checking plies (odd plies of the line) within the first
    ``perpetual_window`` plies; flagged when at least ``perpetual_min_checks``."""
    d = pv.withColumn("_n", F.row_number().over(Window.partitionBy("pos_id").orderBy("ply")))
    d = d.filter(F.col("_n") <= p.perpetual_window)
    g = d.groupBy("pos_id").agg(F.count_if(F.col("forcing") & (F.col("_n") % 2 == 1)).alias("attacker_checks"))
    return g.withColumn("repeated_check", F.col("attacker_checks") >= p.perpetual_min_checks)


def refutation_line(pv: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """Drop the own first move, cap the length, prune quiet tails, join."""
    d = pv.withColumn("_n", F.row_number().over(Window.partitionBy("pos_id").orderBy("ply")))
    d = d.filter((F.col("_n") >= 2) & (F.col("_n") <= p.refutation_max_len + 1)).drop("_n")
    pr = pv_prune_quiet(d, p)
    return line_string(pr, "_n", "uci", "refutation")
