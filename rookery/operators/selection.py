"""Candidate selection, styles, traps and quality bands.

Per-position work is windowed on ``pos_id`` (bounded groups); per-row
weighted choices over a fixed list (styles) compare running totals in the row,
so they need neither an explode nor a shuffle.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rookery.functions.draws import hash_uniform
from rookery.functions.scores import win_probability
from rookery.operators.scoring import merged


@dataclass(frozen=True)
class PoolParams:
    min_candidates: int = 3
    max_candidates: int = 8
    pool_size: int = 12
    sampling: str = "softmax"     # top | uniform | softmax
    temperature: float = 0.25
    seed: int = 42


@dataclass(frozen=True)
class TrapParams:
    min_cp_swing: int = 80
    min_wp_swing: float = 0.12
    shallow_good_cp: int = 30
    shallow_bad_cp: int = 120
    shallow_good_wp: float = 0.06
    shallow_bad_wp: float = 0.18
    confirm_cp_tol: int = 30
    confirm_wp_tol: float = 0.05


def candidate_pool(analysed: DataFrame, p: PoolParams = PoolParams()) -> DataFrame:
    """Pick ``count`` candidates per position from the top ``pool_cap``.

    count ~ U{min..max} by a keyed draw; ``softmax`` sampling without
    replacement uses exponential keys ``ln(u)/w`` (Efraimidis-Spirakis), which
    has the distribution of successive weighted draws. Adds ``pick`` (1-based
    selection order)."""
    return with_picks(analysed, p).filter("picked").drop("picked")


def with_picks(analysed: DataFrame, p: PoolParams = PoolParams()) -> DataFrame:
    """All rows, ``picked`` where ``candidate_pool`` keeps them. ``pick`` numbers the
    top ``pool_cap`` only."""
    w = Window.partitionBy("pos_id")
    a = analysed.withColumn("_n", F.count(F.lit(1)).over(w))
    min_c = F.lit(max(1, p.min_candidates))
    max_c = F.least(F.lit(max(p.min_candidates, p.max_candidates)), F.col("_n"))
    u = hash_uniform(p.seed, F.col("pos_id"), F.lit("count"))
    count = F.when(max_c > min_c, min_c + F.floor(u * (max_c - min_c + 1)).cast("int")).otherwise(max_c)
    a = a.withColumn("_count", count)
    a = a.withColumn("_cap", F.greatest(F.col("_count"), F.least(F.lit(p.pool_size), F.col("_n"))))
    top = (F.lit(p.sampling) == "top") | (F.col("_cap") <= F.col("_count"))
    ui = hash_uniform(p.seed, F.col("pos_id"), F.col("uci"), F.lit("pool"))
    if p.sampling == "softmax":
        weight = F.coalesce(F.exp(F.col("win_prob") / F.lit(max(1e-6, p.temperature))), F.lit(1.0))
        key = F.ln(F.greatest(ui, F.lit(1e-300))) / weight
    else:
        key = ui
    a = a.withColumn("_out", F.col("rank") > F.col("_cap"))
    a = a.withColumn("_key", F.when(top, -F.col("rank").cast("double")).otherwise(key))
    a = a.withColumn("_pick", F.row_number().over(w.orderBy("_out", F.col("_key").desc(), F.col("rank"))))
    a = a.withColumn("pick", F.when(~F.col("_out"), F.col("_pick")))
    return a.withColumn("picked", F.coalesce(F.col("pick") <= F.col("_count"), F.lit(False))).drop("_n", "_count", "_cap", "_out", "_key", "_pick")


def weighted_sample_wor(df: DataFrame, key: str, item: str, weight: Column, k: int, seed: int = 42) -> DataFrame:
    """k items per group without replacement, P proportional to weight."""
    u = hash_uniform(seed, F.col(key), F.col(item), F.lit("wor"))
    d = df.withColumn("_k", F.ln(F.greatest(u, F.lit(1e-300))) / weight)
    d = d.withColumn("pick", F.row_number().over(Window.partitionBy(key).orderBy(F.col("_k").desc(), F.col(item))))
    return d.filter(F.col("pick") <= k).drop("_k")


def weighted_choice(df: DataFrame, key: str, order: str, weight: str, seed: int = 42) -> DataFrame:
    """One row per group: first item (in ``order``) whose running weight
    reaches ``u * total`` (negative weights count as 0)."""
    w = Window.partitionBy(key)
    wr = w.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    wt = F.greatest(F.col(weight), F.lit(0.0))
    d = df.withColumn("_cum", F.sum(wt).over(wr)).withColumn("_tot", F.sum(wt).over(w))
    d = d.withColumn("_pick", hash_uniform(seed, F.col(key), F.lit("choice")) * F.col("_tot"))
    hit = d.filter(F.col("_pick") <= F.col("_cum"))
    first = hit.withColumn("_r", F.row_number().over(w.orderBy(order))).filter("_r = 1")
    return first.drop("_cum", "_tot", "_pick", "_r")


# --- fixed values -----------------------------------------------------------
STYLES = ["thorough", "concise", "tactical", "quick", "problem_focused", "intuition",
          "comparison_focused", "dialogue"]
STYLE_WEIGHTS = {
    "game": {"thorough": 0.42, "concise": 0.18, "comparison_focused": 0.12, "intuition": 0.10,
             "quick": 0.08, "tactical": 0.06, "problem_focused": 0.04, "dialogue": 0.03},
    "puzzle": {"tactical": 0.32, "problem_focused": 0.22, "quick": 0.14, "intuition": 0.10,
               "comparison_focused": 0.08, "thorough": 0.08, "concise": 0.06, "dialogue": 0.06},
}
# Puzzle bumps: (condition, [(style, factor), ...]) applied in this order.
TACTICAL_MARKERS = ["fork", "pin", "skewer", "discovered", "double", "sacrifice", "deflection",
                    "attraction", "interference", "clearance", "xray", "hanging", "trapped", "backrank"]
PUZZLE_BUMPS = [
    ("theme_contains:endgame", [("thorough", 1.25), ("concise", 1.15), ("intuition", 1.15),
                                ("tactical", 0.85), ("problem_focused", 0.90)]),
    ("theme_contains:mate", [("tactical", 1.45), ("problem_focused", 1.25), ("thorough", 1.15), ("quick", 0.90)]),
    ("theme_tactical", [("tactical", 1.20), ("problem_focused", 1.10)]),
    ("theme_is:opening", [("quick", 1.20), ("concise", 1.15), ("thorough", 0.85)]),
    ("theme_is:middlegame", [("thorough", 1.05)]),
    ("theme_is:long", [("thorough", 1.10), ("comparison_focused", 1.10), ("quick", 0.90)]),
    ("rating_ge:2200", [("thorough", 1.20), ("comparison_focused", 1.15), ("quick", 0.70)]),
    ("rating_le:1200", [("quick", 1.20), ("concise", 1.10), ("thorough", 0.85)]),
]
STYLE_OVERRIDE_PROB = 0.35
OVERRIDE_POOLS = {
    "forced_mate": ["tactical", "problem_focused", "thorough"],
    "only_move": ["problem_focused", "tactical", None],       # None = keep the current style
    "many_options": ["comparison_focused", "intuition", None],
}
# --- end of fixed values -----------------------------------------------------


def _condition(cond: str, themes: Column, rating: Column) -> Column:
    kind, _, arg = cond.partition(":")
    lc = F.transform(themes, lambda t: F.lower(F.trim(t)))
    if kind == "theme_contains":
        return F.exists(lc, lambda t: F.instr(t, arg) > 0)
    if kind == "theme_is":
        return F.array_contains(lc, arg)
    if kind == "theme_tactical":
        return F.exists(lc, lambda t: functools.reduce(lambda a, b: a | b,
                                                        [F.instr(t, m) > 0 for m in TACTICAL_MARKERS]))
    if kind == "rating_ge":
        return F.coalesce(rating >= int(arg), F.lit(False))
    if kind == "rating_le":
        return F.coalesce(rating <= int(arg), F.lit(False))
    raise ValueError(cond)


def style_weights(source: Column, hits: dict[str, Column]) -> list[Column]:
    """The 8 weights (STYLES order) after the source table and, for
    puzzles, the theme/rating bumps (multiplied in rule order). ``hits`` maps
    each bump condition to a boolean column computed once per row."""
    out = []
    for s in STYLES:
        w = F.when(source == "puzzle", F.lit(STYLE_WEIGHTS["puzzle"].get(s, 0.0))) \
            .otherwise(F.lit(STYLE_WEIGHTS["game"].get(s, 0.0)))
        for cond, bumps in PUZZLE_BUMPS:
            for style, factor in bumps:
                if style == s:
                    # factors are positive, so max(0, w*f) == w*f; a miss multiplies by exactly 1.0
                    w = w * F.when((source == "puzzle") & hits[cond], F.lit(factor)).otherwise(F.lit(1.0))
        out.append(w)
    return out


def weighted_pick_index(df: DataFrame, weights: list[Column], u: Column, out: str) -> DataFrame:
    """Adds ``out``: the 0-based index chosen by a running total over ``weights``
    (the first one when the total is not positive).

    The running totals and the draw are columns that the comparisons read: as one
    expression every comparison would work out the total and the hash again."""
    names = [f"_w{i}" for i in range(len(weights))]
    df = df.withColumns({n: F.greatest(w, F.lit(0.0)) for n, w in zip(names, weights)})
    run = [F.lit(0.0)]
    for n in names:
        run.append(run[-1] + F.col(n))
    df = df.withColumns({f"_r{i}": r for i, r in enumerate(run[1:])})
    last = f"_r{len(names) - 1}"
    df = df.withColumn("_pick", u * F.col(last))
    idx = F.lit(0)  # when no total is reached, too
    for i in reversed(range(len(names))):
        idx = F.when(F.col("_pick") <= F.col(f"_r{i}"), F.lit(i)).otherwise(idx)
    return df.withColumn(out, F.when(F.col(last) <= 0, F.lit(0)).otherwise(idx)) \
        .drop("_pick", *names, *[f"_r{i}" for i in range(len(names))])


def select_style(df: DataFrame, source: str, key: str, themes: str, rating: str, seed: int = 42) -> DataFrame:
    th = F.coalesce(F.col(themes), F.array().cast("array<string>"))
    names = {cond: f"_c{i}" for i, (cond, _) in enumerate(PUZZLE_BUMPS)}
    d = df.select("*", *[_condition(cond, th, F.col(rating)).alias(n) for cond, n in names.items()])
    w = style_weights(F.col(source), {cond: F.col(n) for cond, n in names.items()})
    u = hash_uniform(seed, F.col(source), F.col(key), F.lit("style"))
    d = weighted_pick_index(d, w, u, "_style")
    return d.withColumn("style", F.element_at(F.array(*[F.lit(s) for s in STYLES]), F.col("_style") + 1)) \
        .drop("_style", *names.values())


def override_style(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """With probability 0.35 re-pick the style from a profile-driven pool."""
    u = hash_uniform(seed, F.col(key), F.lit("override"))
    u2 = hash_uniform(seed, F.col(key), F.lit("override_pick"))
    def pool(name):
        items = [F.lit(x) if x is not None else F.col("style") for x in OVERRIDE_POOLS[name]]
        return F.element_at(F.array(*items), (F.floor(u2 * len(items)) + 1).cast("int"))
    new = (F.when(F.col("forced_mate"), pool("forced_mate")).when(F.col("only_move"), pool("only_move"))
           .when(F.col("many_options"), pool("many_options")).otherwise(F.col("style")))
    return df.withColumn("final_style", F.when(u < STYLE_OVERRIDE_PROB, new).otherwise(F.col("style")))


def trap_detect(analysed: DataFrame, p: TrapParams = TrapParams()) -> DataFrame:
    """Shallow-vs-deep disagreement per candidate (cp rule first, then the
    win-probability rule): kind in {trap, resource} or NULL, plus the rule."""
    w = Window.partitionBy("pos_id")
    a = analysed.withColumn("_bs", F.max("shallow_cp").over(w))
    # the best win probability is that of the best score
    a = a.withColumn("_swp", win_probability("shallow_cp")).withColumn("_bswp", win_probability("_bs"))
    cp, sh, bs = F.col("cp"), F.col("shallow_cp"), F.col("_bs")
    swing = F.abs(cp - sh)
    sg, sb = sh >= bs - p.shallow_good_cp, sh <= bs - p.shallow_bad_cp
    db, dg = cp <= bs - p.shallow_bad_cp, cp >= bs - p.shallow_good_cp
    cp_ok = sh.isNotNull() & cp.isNotNull() & bs.isNotNull()
    cp_trap = cp_ok & (swing >= p.min_cp_swing) & sg & db
    cp_res = cp_ok & (swing >= p.min_cp_swing) & sb & dg
    dwp, swp, bw = F.col("win_prob"), F.col("_swp"), F.col("_bswp")
    wswing = F.abs(dwp - swp)
    wsg, wsb = swp >= bw - p.shallow_good_wp, swp <= bw - p.shallow_bad_wp
    wdb, wdg = dwp <= bw - p.shallow_bad_wp, dwp >= bw - p.shallow_good_wp
    wp_ok = swp.isNotNull() & dwp.isNotNull() & bw.isNotNull()
    wp_trap = wp_ok & (wswing >= p.min_wp_swing) & wsg & wdb
    wp_res = wp_ok & (wswing >= p.min_wp_swing) & wsb & wdg
    kind = (F.when(cp_trap, "trap").when(cp_res, "resource").when(wp_trap, "trap").when(wp_res, "resource"))
    rule = F.when(cp_trap | cp_res, "cp").when(wp_trap | wp_res, "wp")
    return a.withColumn("trap_kind", kind).withColumn("trap_rule", rule).drop("_bs", "_swp", "_bswp")


def trap_confirm(traps: DataFrame, p: TrapParams = TrapParams()) -> DataFrame:
    c, d = F.col("confirm_cp"), F.col("cp")
    cwp = win_probability("confirm_cp")
    conf = (F.when(c.isNotNull() & d.isNotNull(),
                   F.when(F.abs(c - d) <= p.confirm_cp_tol, "confirmed").otherwise("uncertain"))
            .when(cwp.isNotNull() & F.col("win_prob").isNotNull(),
                  F.when(F.abs(cwp - F.col("win_prob")) <= p.confirm_wp_tol, "confirmed").otherwise("uncertain"))
            .otherwise("uncertain"))
    return traps.withColumn("confidence", F.when(F.col("trap_kind").isNotNull(), conf))


def quality_band(best_win: Column, win_prob: Column, mate_in: Column, margin: float = 0.04) -> Column:
    delta = best_win - win_prob
    eq = F.abs(win_prob - 0.5) <= margin
    return (F.when(mate_in > 0, "forced_mate").when(mate_in.isNotNull(), "allows_mate")
            .when(eq & (delta <= 0.02), "equal_best").when(eq & (delta <= 0.06), "equal_close")
            .when(delta <= 0.02, "best").when(delta <= 0.06, "close").when(delta <= 0.12, "inferior")
            .otherwise("bad"))


def failure_band(wp: Column) -> Column:
    return F.when(wp < 0.35, "bad").when(wp < 0.45, "ok").otherwise("close")


def pros_band(wp: Column) -> Column:
    return F.when(wp > 0.55, "strong").when(wp > 0.45, "solid").otherwise("fighting")


def cons_band(is_best: Column, wp: Column, best_wp: Column) -> Column:
    return (F.when(is_best, "best").when(wp < best_wp - 0.1, "inferior").when(wp < best_wp - 0.05, "close")
            .otherwise("marginal"))


def assessment_band(tb_result: Column, best_wp: Column, margin: float = 0.04) -> Column:
    return (F.when(tb_result.isNotNull(), F.concat(F.lit("tablebase_"), tb_result))
            .when(best_wp.isNull(), "no_eval")
            .when(F.abs(best_wp - 0.5) <= margin, "balanced")
            .when(best_wp >= 0.60, "better").when(best_wp <= 0.40, "worse").otherwise("slight"))


def avoid_blunder(analysed: DataFrame, policy: DataFrame, min_cp_loss: int = 120, min_prob: float = 0.05,
                  gate: float = 0.25, seed: int = 42, trap: TrapParams = TrapParams()) -> DataFrame:
    """Most tempting serious mistake per position (never the best move):
    argmax of (tempting, p, cp_loss), first in rank order on ties; the
    table-derivable tempting term is the shallow-good / deep-bad swing."""
    w = Window.partitionBy("pos_id")
    # a map a position, so the join keeps the partitioning by position
    pol = policy.groupBy("pos_id").agg(F.map_from_entries(F.collect_list(F.struct("uci", "prob"))).alias("_probs"))
    j = analysed.join(merged(pol), "pos_id", "left").withColumn("p", F.coalesce(F.try_element_at("_probs", F.col("uci")), F.lit(0.0))).drop("_probs")
    j = j.withColumn("bs", F.max("shallow_cp").over(w))
    j = j.filter(_is_mistake(min_cp_loss, min_prob)).withColumn("tempting", _tempting(trap))
    j = j.withColumn("r", F.row_number().over(w.orderBy(F.col("tempting").desc(), F.col("p").desc(),
                                                        F.col("cp_loss").desc(), "rank")))
    j = j.filter((F.col("r") == 1) & avoids(gate, seed))
    return j.select("pos_id", F.col("uci").alias("avoid_uci"), "tempting")


def _is_mistake(min_cp_loss: int, min_prob: float) -> Column:
    return (F.col("rank") != 1) & (F.col("cp_loss") >= min_cp_loss) & (F.col("p") >= min_prob)


def _tempting(trap: TrapParams) -> Column:
    return F.when(F.col("bs").isNotNull() & F.col("shallow_cp").isNotNull()
                  & (F.col("shallow_cp") >= F.col("bs") - trap.shallow_good_cp)
                  & (F.col("cp") <= F.col("bs") - trap.shallow_bad_cp), 3).otherwise(0)


def avoided_move(min_cp_loss: int = 120, min_prob: float = 0.05, trap: TrapParams = TrapParams()) -> Column:
    """The move of ``avoid_blunder`` as an aggregate of a position's moves, with their
    policy ``p`` and the position's best shallow score ``bs``; null where there is none."""
    order = F.struct(_tempting(trap), F.col("p"), F.col("cp_loss"), -F.col("rank"))
    return F.max_by("uci", F.when(_is_mistake(min_cp_loss, min_prob), order))


def avoids(gate: float = 0.25, seed: int = 42) -> Column:
    """The gate of ``avoid_blunder``: a draw a position."""
    return hash_uniform(seed, F.col("pos_id"), F.lit("avoid")) < gate
