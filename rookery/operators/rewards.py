"""Rollout rewards and RL diagnostics.

Per-position analysis is collapsed to one row (a map of move -> rank/score
plus the legal list) and joined to the rollouts once on the position key, so
scoring N completions of a prompt costs one shuffle of the rollouts and no
per-move join. Completions sharing a FEN are grouped by FEN (reference quirk).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.functions.scores import RL_MATE_CP, score_expectation
from rookery.functions.text import FORMAT_PATTERN, extract_move_lenient, prefix_completion
from rookery.operators.scoring import analyse_candidates


@dataclass(frozen=True)
class RewardParams:
    # top-N ranking reward
    reward_top1: float = 1.5
    reward_top3: float = 1.0
    reward_top5: float = 0.6
    reward_legal: float = 0.1
    reward_illegal: float = -0.5
    reward_no_move: float = -1.0
    top_n: int = 5
    # win-probability-delta reward
    base_reward: float = 1.0
    wpd_penalty_scale: float = 4.0
    excellent_threshold: float = 0.02
    excellent_bonus: float = 0.5
    good_threshold: float = 0.05
    min_reward: float = -1.0
    unknown_factor: float = 0.3
    # format rewards
    reward_format_bonus: float = 0.1
    reward_format_penalty: float = -0.1
    reward_xml_bonus: float = 0.05
    reward_xml_penalty: float = -0.15


P = RewardParams()


def position_analysis(cands: DataFrame, valid_list: DataFrame) -> DataFrame:
    """One row per position: legal list, move -> (rank, cp, mate_in) map, best move."""
    a = analyse_candidates(cands)
    per = a.groupBy("pos_id").agg(
        F.map_from_entries(F.collect_list(F.struct("uci", F.struct("rank", "cp", "mate_in")))).alias("evals"),
        F.max(F.when(F.col("rank") == 1, F.col("uci"))).alias("best_uci"),
        F.max(F.when(F.col("rank") == 1, F.col("cp"))).alias("best_cp"),
        F.max(F.when(F.col("rank") == 1, F.col("mate_in"))).alias("best_mate_in"),
    )
    return valid_list.join(per, "pos_id", "left")


def rl_cp(cp: Column, mate_in: Column) -> Column:
    """Score with mates at +-10000 (RL convention)."""
    return F.when(mate_in > 0, F.lit(RL_MATE_CP)).when(mate_in.isNotNull(), F.lit(-RL_MATE_CP)).otherwise(cp)


def score_rollouts(rollouts: DataFrame, positions: DataFrame, analysis: DataFrame,
                   p: RewardParams = P) -> DataFrame:
    """Adds fen, pred, legal, rank, wpd and the reward columns.

    ``rollouts(prompt_id, sample_id, completion)``; ``positions(pos_id, fen)``;
    ``analysis`` from :func:`position_analysis`. What needs the completion's
    text is taken from it first, so the joins carry no text; a registered
    reward that needs more of it adds its column to ``rollouts`` beforehand.
    """
    r = rollouts.withColumn("_text", prefix_completion("completion"))
    r = (r.withColumn("pred", extract_move_lenient("_text"))
         .withColumn("reward_format", reward_format("_text", p))
         .withColumn("reward_tag_count", reward_tag_count("_text", p))
         .withColumn("completion_chars", F.length("completion"))
         .drop("_text", "completion"))
    pos = positions.select(F.col("pos_id").alias("prompt_id"), "fen")
    an = analysis.withColumnRenamed("pos_id", "prompt_id")
    j = r.join(pos, "prompt_id", "left").join(an, "prompt_id", "left")
    ev = F.try_element_at(F.col("evals"), F.col("pred"))
    j = j.withColumn("legal", F.coalesce(F.array_contains("valid_moves", F.col("pred")), F.lit(False)))
    j = j.withColumn("pred_rank", ev["rank"]).withColumn("pred_cp", ev["cp"]).withColumn("pred_mate", ev["mate_in"])
    j = j.withColumn("outcome", outcome(p))
    j = j.withColumn("reward_topn", reward_topn(p))
    j = j.withColumn("wpd", wpd(p))
    return j.withColumn("reward_wpd", reward_wpd(p))


def outcome(p: RewardParams = P) -> Column:
    pred, fen, rank = F.col("pred"), F.col("fen"), F.col("pred_rank")
    return (F.when(pred.isNull() | fen.isNull(), F.lit("no_move"))
            .when(~F.col("legal"), F.lit("illegal"))
            .when(F.col("evals").isNull(), F.lit("legal"))
            .when(rank == 1, F.lit("top1"))
            .when(rank <= 3, F.lit("top3"))
            .when(rank <= p.top_n, F.lit("top5"))
            .otherwise(F.lit("legal")))


def reward_topn(p: RewardParams = P) -> Column:
    o = F.col("outcome")
    return (F.when(o == "no_move", F.lit(p.reward_no_move)).when(o == "illegal", F.lit(p.reward_illegal))
            .when(o == "top1", F.lit(p.reward_top1)).when(o == "top3", F.lit(p.reward_top3))
            .when(o == "top5", F.lit(p.reward_top5)).otherwise(F.lit(p.reward_legal)))


def wpd(p: RewardParams = P) -> Column:
    """Win-probability delta of a legal prediction; NULL when unknown.

    Predictions in the top-N use the cached expectation; others use the
    post-move score seen from the opponent (``1 - E(-cp)``); moves without
    any score are unknown."""
    best_e = score_expectation(rl_cp(F.col("best_cp"), F.col("best_mate_in")))
    cp = rl_cp(F.col("pred_cp"), F.col("pred_mate"))
    in_top = F.col("pred_rank") <= p.top_n
    pred_e = F.when(in_top, score_expectation(cp)).when(
        F.col("pred_cp").isNotNull(), F.lit(1.0) - score_expectation(-cp))
    d = F.greatest(F.lit(0.0), F.least(F.lit(1.0), best_e - pred_e))
    legal_known = F.col("pred").isNotNull() & F.col("fen").isNotNull() & F.col("legal")
    return F.when(legal_known & (F.col("pred") == F.col("best_uci")), F.lit(0.0)).when(legal_known, d)


def reward_wpd(p: RewardParams = P) -> Column:
    w = F.col("wpd")
    base = F.lit(p.base_reward) - w * F.lit(p.wpd_penalty_scale)
    bonus = F.when(w < p.good_threshold, F.lit(p.excellent_bonus) * (F.lit(1.0) - w / F.lit(p.good_threshold))) \
        .otherwise(F.lit(0.0))
    o = F.col("outcome")
    return (F.when(o == "no_move", F.lit(p.reward_no_move)).when(o == "illegal", F.lit(p.reward_illegal))
            .when(w.isNull(), F.lit(p.base_reward * p.unknown_factor))
            .otherwise(F.greatest(F.lit(p.min_reward), base + bonus)))


def wpd_class(w) -> Column:
    c = F.col(w) if isinstance(w, str) else w
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(c < 0.02, "excellent").when(c < 0.05, "good").when(c < 0.10, "acceptable")
            .when(c < 0.20, "inaccuracy").when(c < 0.35, "mistake").otherwise("blunder"))


def reward_format(text, p: RewardParams = P) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.when(t.rlike(FORMAT_PATTERN), F.lit(p.reward_format_bonus)).otherwise(F.lit(p.reward_format_penalty))


TAGS = ("<think>", "</think>", "<uci_move>", "</uci_move>")


def tag_counts(text) -> list[Column]:
    t = F.col(text) if isinstance(text, str) else text
    return [F.regexp_count(t, F.lit("(?i)" + tag)) for tag in TAGS]


def reward_tag_count(text, p: RewardParams = P) -> Column:
    ok = None
    for c in tag_counts(text):
        ok = (c == 1) if ok is None else ok & (c == 1)
    return F.when(ok, F.lit(p.reward_xml_bonus)).otherwise(F.lit(p.reward_xml_penalty))


# Registry of reward functions: name -> Column expression over scored rollouts.
REWARDS: dict[str, Callable[[], Column]] = {
    "topn": lambda: F.col("reward_topn"),
    "wpd": lambda: F.col("reward_wpd"),
    "format": lambda: F.col("reward_format"),
    "xml_count": lambda: F.col("reward_tag_count"),
}


def register_reward(name: str, fn: Callable[[], Column]) -> None:
    """Add a reward: a Column factory."""
    REWARDS[name] = fn


def register_arrow_reward(name: str, fn: Callable, columns: list[str]) -> None:
    """Add a user's reward function. It gets Arrow arrays of ``columns`` of the
    scored rollouts, a batch at a time, and returns one double for each row; a
    null counts as 0, like a reward that does not apply."""
    from pyspark.sql.functions import ArrowUDFType, arrow_udf

    def batch(*arrays):
        import pyarrow as pa
        out = fn(*arrays)
        if len(out) != len(arrays[0]):
            raise ValueError(f"reward {name} returned {len(out)} values for {len(arrays[0])} rows")
        return out.cast(pa.float64())

    call = arrow_udf(batch, "double", ArrowUDFType.SCALAR)
    REWARDS[name] = lambda: F.coalesce(call(*[F.col(c) for c in columns]), F.lit(0.0))


def reward_total(names: list[str]) -> Column:
    total = None
    for n in names:
        c = REWARDS[n]()
        total = c if total is None else total + c
    return total


def reward_stats(scored: DataFrame) -> DataFrame:
    o = F.col("outcome")
    rate = lambda v: F.avg((o == v).cast("double"))
    return scored.agg(F.count(F.lit(1)).alias("total"), rate("top1").alias("top1_rate"),
                      rate("top3").alias("top3_rate"), rate("top5").alias("top5_rate"),
                      rate("legal").alias("legal_rate"), rate("illegal").alias("illegal_rate"),
                      rate("no_move").alias("no_move_rate"))


def group_diversity(scored: DataFrame, reward: str = "reward_total") -> DataFrame:
    """Per-FEN group: size, parse rate, unique moves, mode share, reward stdev.

    One aggregate by ``(fen, pred)``, rolled up by ``fen``: count, mean and
    squared deviations add up (no second scan, no distinct)."""
    n, mean = F.col("_n"), F.col("_mean")
    by_move = scored.groupBy("fen", "pred").agg(
        F.count(F.lit(1)).alias("_all"), F.count(reward).alias("_n"), F.avg(reward).alias("_mean"),
        F.coalesce(F.var_pop(reward) * F.count(reward), F.lit(0.0)).alias("_dev"))
    parsed = F.col("pred").isNotNull()
    g = by_move.groupBy("fen").agg(
        F.sum("_all").alias("group_size"),
        F.coalesce(F.sum(F.when(parsed, F.col("_all"))), F.lit(0)).alias("parsed"),
        F.count("pred").alias("unique_moves"),
        F.max(F.when(parsed, F.col("_all"))).alias("mode_count"),
        F.sum("_n").alias("_count"), F.sum(n * mean).alias("_sum"),
        F.sum("_dev").alias("_within"),
        F.collect_list(F.struct("_n", "_mean")).alias("_parts"))  # one entry a move
    total_mean = F.col("_sum") / F.col("_count")
    between = F.aggregate("_parts", F.lit(0.0), lambda a, x: a + F.coalesce(
        x["_n"] * (x["_mean"] - total_mean) * (x["_mean"] - total_mean), F.lit(0.0)))
    std = F.when(F.col("_count") > 1, F.sqrt((F.col("_within") + between) / (F.col("_count") - 1))).otherwise(F.lit(0.0))
    return g.select("fen", "group_size", (F.col("parsed") / F.col("group_size")).alias("parse_rate"),
                    "unique_moves",
                    F.when(F.col("parsed") > 0, F.col("mode_count") / F.col("parsed")).otherwise(F.lit(1.0))
                    .alias("mode_share"),
                    F.coalesce(std, F.lit(0.0)).alias("reward_std"))
