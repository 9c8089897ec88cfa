"""Candidate scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.functions.scores import normalized_score, score_label
from rookery.operators.scoring import (analyse_candidates, decision_profile, rank_candidates,
                                       round6, softmax_policy)
from rookery.plans.registry import register
from rookery.sources.fixtures import plan_memo
from rookery.sources.fixtures import fx_candidates, fx_valid_moves, with_fx

CATEGORY_SQL = """CASE WHEN mate_in > 0 THEN 'winning mate' WHEN mate_in IS NOT NULL THEN 'blunder'
 WHEN cp_loss = 0 THEN 'best move' WHEN cp_loss <= 10 THEN 'excellent' WHEN cp_loss <= 30 THEN 'good'
 WHEN cp_loss <= 50 THEN 'slight inaccuracy' WHEN cp_loss <= 100 THEN 'inaccuracy'
 WHEN cp_loss <= 200 THEN 'mistake' ELSE 'blunder' END"""


def win_prob_sql(cp: str) -> str:
    return f"(1.0::DOUBLE / (1.0::DOUBLE + pow(10.0::DOUBLE, -{cp} / 400.0::DOUBLE)))"


ANALYSED = f"""analysed0 AS (
 SELECT c.*, CAST(row_number() OVER (PARTITION BY pos_id ORDER BY cp DESC, slot) AS INT) AS rank,
        max(cp) OVER (PARTITION BY pos_id) AS best_cp
 FROM fx_candidates c),
analysed1 AS (SELECT *, best_cp - cp AS cp_loss FROM analysed0),
analysed AS (SELECT *, {CATEGORY_SQL} AS category, {win_prob_sql('cp')} AS win_prob FROM analysed1)"""

POLICY = """pol_j AS (
 SELECT v.pos_id, v.uci, c.cp FROM fx_valid_moves v
 LEFT JOIN fx_candidates c ON c.pos_id = v.pos_id AND c.uci = v.uci),
pol_e AS (SELECT *, count(*) OVER (PARTITION BY pos_id) AS n,
   exp((cp - max(cp) OVER (PARTITION BY pos_id)) / 100.0::DOUBLE) AS e FROM pol_j),
pol_d AS (SELECT *, sum(e) OVER (PARTITION BY pos_id) AS d FROM pol_e),
pol_r AS (SELECT *, 0.001::DOUBLE + coalesce(e / d, 0.0::DOUBLE) * (1.0::DOUBLE - 0.001::DOUBLE * n) AS raw
   FROM pol_d),
pol AS (SELECT pos_id, uci, cp,
   CASE WHEN 0.001::DOUBLE * n >= 1.0::DOUBLE OR d IS NULL OR d <= 0 THEN 1.0::DOUBLE / n
        ELSE raw / sum(raw) OVER (PARTITION BY pos_id) END AS prob FROM pol_r)"""

PROFILE = f"""pp AS (
 SELECT pos_id, max(CASE WHEN rank = 1 THEN uci END) AS best_uci,
   max(CASE WHEN rank = 1 THEN cp END) AS best_cp,
   max(CASE WHEN rank = 1 THEN mate_in END) AS best_mate_in,
   max(CASE WHEN rank = 2 THEN cp END) AS second_cp,
   max(CASE WHEN rank = 2 THEN cp_loss END) AS second_cp_loss,
   CAST(count_if(cp_loss <= 30) AS BIGINT) AS close_moves
 FROM analysed GROUP BY pos_id),
ent AS (SELECT pos_id, sum(CASE WHEN prob > 0 THEN -prob * ln(prob) END) AS entropy,
   CAST(count_if(prob > 0) AS BIGINT) AS n_probs FROM pol GROUP BY pos_id),
prof0 AS (
 SELECT pp.*, coalesce(ent.entropy, 0.0::DOUBLE) AS entropy, coalesce(ent.n_probs, 0) AS n_probs,
   coalesce(pol.prob, 0.0::DOUBLE) AS best_prob
 FROM pp LEFT JOIN ent ON ent.pos_id = pp.pos_id
 LEFT JOIN pol ON pol.pos_id = pp.pos_id AND pol.uci = pp.best_uci),
prof1 AS (SELECT *, CASE WHEN n_probs > 1 THEN entropy / ln(CAST(n_probs AS DOUBLE)) ELSE 0.0::DOUBLE END
   AS entropy_norm, coalesce(best_mate_in > 0, false) AS forced_mate FROM prof0),
profile AS (
 SELECT pos_id, best_uci, best_prob, entropy, entropy_norm,
   CASE WHEN n_probs > 0 THEN exp(entropy) ELSE 0.0::DOUBLE END AS effective_moves,
   best_cp - second_cp AS cp_gap, second_cp_loss, close_moves,
   abs({win_prob_sql('best_cp')} - 0.5::DOUBLE) <= 0.04::DOUBLE AS near_equal,
   (forced_mate OR coalesce(second_cp_loss >= 150, false)
     OR (best_prob >= 0.55::DOUBLE AND close_moves <= 2)) AS only_move,
   forced_mate,
   ((entropy_norm >= 0.82::DOUBLE AND best_prob <= 0.35::DOUBLE)
     OR (best_prob <= 0.22::DOUBLE AND close_moves >= 3)
     OR (coalesce(second_cp_loss <= 20, false) AND close_moves >= 3)) AS many_options
 FROM prof1)"""


def _cands(spark, sf):
    return fx_candidates(spark, sf)


@register("rank_candidates", with_fx(
    "SELECT pos_id, slot, uci, cp, CAST(row_number() OVER (PARTITION BY pos_id ORDER BY cp DESC, slot)"
    " AS INT) AS rank FROM fx_candidates", "fx_candidates"))
def q_rank_candidates(spark, sf):
    return rank_candidates(_cands(spark, sf)).select("pos_id", "slot", "uci", "cp", "rank")


@register("best_candidate", with_fx(
    f"WITH {ANALYSED} SELECT pos_id, uci AS best_uci, cp AS best_cp, mate_in AS best_mate_in "
    "FROM analysed WHERE rank = 1", "fx_candidates"))
def q_best_candidate(spark, sf):
    a = analyse_candidates(_cands(spark, sf))
    return a.filter("rank = 1").select(
        "pos_id", F.col("uci").alias("best_uci"), F.col("cp").alias("best_cp"),
        F.col("mate_in").alias("best_mate_in"))


@register("cp_loss", with_fx(
    f"WITH {ANALYSED} SELECT pos_id, uci, cp, best_cp, cp_loss FROM analysed", "fx_candidates"))
def q_cp_loss(spark, sf):
    return analyse_candidates(_cands(spark, sf)).select("pos_id", "uci", "cp", "best_cp", "cp_loss")


@register("categorize_move", with_fx(
    f"WITH {ANALYSED} SELECT pos_id, uci, cp_loss, mate_in, category FROM analysed", "fx_candidates"))
def q_categorize_move(spark, sf):
    return analyse_candidates(_cands(spark, sf)).select("pos_id", "uci", "cp_loss", "mate_in", "category")


@register("win_probability", with_fx(
    f"SELECT pos_id, uci, cp, round({win_prob_sql('cp')}, 6) AS win_prob FROM fx_candidates",
    "fx_candidates"))
def q_win_probability(spark, sf):
    a = analyse_candidates(_cands(spark, sf))
    return a.select("pos_id", "uci", "cp", round6("win_prob").alias("win_prob"))


@register("softmax_policy", with_fx(
    f"WITH {POLICY} SELECT pos_id, uci, cp, round(prob, 6) AS prob FROM pol",
    "fx_candidates", "fx_valid_moves"))
def q_softmax_policy(spark, sf):
    p = softmax_policy(fx_valid_moves(spark, sf), _cands(spark, sf))
    return p.select("pos_id", "uci", "cp", round6("prob").alias("prob"))


@register("topk_moves", with_fx(
    f"WITH {ANALYSED} SELECT pos_id, string_agg(uci, ' ' ORDER BY rank) AS top_moves "
    "FROM analysed WHERE rank <= 5 GROUP BY pos_id", "fx_candidates"))
def q_topk_moves(spark, sf):
    a = rank_candidates(_cands(spark, sf)).filter("rank <= 5")
    ordered = F.array_sort(F.collect_list(F.struct("rank", "uci")))
    return a.groupBy("pos_id").agg(
        F.array_join(F.transform(ordered, lambda x: x["uci"]), " ").alias("top_moves"))


@register("policy_entropy", with_fx(
    f"WITH {ANALYSED}, {POLICY}, {PROFILE} SELECT pos_id, round(entropy, 6) AS entropy, "
    "round(entropy_norm, 6) AS entropy_norm, round(effective_moves, 6) AS effective_moves FROM profile",
    "fx_candidates", "fx_valid_moves"))
def q_policy_entropy(spark, sf):
    d = decision_profile(_cands(spark, sf), fx_valid_moves(spark, sf))
    return d.select("pos_id", round6("entropy").alias("entropy"),
                    round6("entropy_norm").alias("entropy_norm"),
                    round6("effective_moves").alias("effective_moves"))


@register("second_best_gap", with_fx(
    f"WITH {ANALYSED} SELECT pos_id, max(CASE WHEN rank = 1 THEN cp END) - max(CASE WHEN rank = 2 THEN cp END)"
    " AS cp_gap, max(CASE WHEN rank = 2 THEN cp_loss END) AS second_cp_loss FROM analysed GROUP BY pos_id",
    "fx_candidates"))
def q_second_best_gap(spark, sf):
    a = analyse_candidates(_cands(spark, sf))
    return a.groupBy("pos_id").agg(
        (F.max(F.when(F.col("rank") == 1, F.col("cp"))) - F.max(F.when(F.col("rank") == 2, F.col("cp"))))
        .alias("cp_gap"),
        F.max(F.when(F.col("rank") == 2, F.col("cp_loss"))).alias("second_cp_loss"))


@register("close_moves", with_fx(
    f"WITH {ANALYSED} SELECT pos_id, CAST(count_if(cp_loss <= 30) AS BIGINT) AS close_moves FROM analysed GROUP BY pos_id",
    "fx_candidates"))
def q_close_moves(spark, sf):
    a = analyse_candidates(_cands(spark, sf))
    return a.groupBy("pos_id").agg(F.count_if(F.col("cp_loss") <= 30).alias("close_moves"))


PROFILE_COLS = ("pos_id, best_uci, round(best_prob, 6) AS best_prob, round(entropy, 6) AS entropy, "
                "round(entropy_norm, 6) AS entropy_norm, round(effective_moves, 6) AS effective_moves, "
                "cp_gap, second_cp_loss, close_moves, near_equal, only_move, forced_mate, many_options")


@plan_memo
def profile_frame(spark, sf):
    d = decision_profile(_cands(spark, sf), fx_valid_moves(spark, sf))
    return d.select("pos_id", "best_uci", round6("best_prob").alias("best_prob"),
                    round6("entropy").alias("entropy"), round6("entropy_norm").alias("entropy_norm"),
                    round6("effective_moves").alias("effective_moves"), "cp_gap", "second_cp_loss",
                    "close_moves", "near_equal", "only_move", "forced_mate", "many_options")


@register("decision_profile", with_fx(
    f"WITH {ANALYSED}, {POLICY}, {PROFILE} SELECT {PROFILE_COLS} FROM profile",
    "fx_candidates", "fx_valid_moves"))
def q_decision_profile(spark, sf):
    return profile_frame(spark, sf)


@register("normalized_score", with_fx(
    "SELECT pos_id, uci, CASE WHEN mate_in > 0 THEN 1.0::DOUBLE WHEN mate_in IS NOT NULL THEN -1.0::DOUBLE "
    "ELSE greatest(-1.0::DOUBLE, least(1.0::DOUBLE, cp / 1000.0::DOUBLE)) END AS norm_score FROM fx_candidates",
    "fx_candidates"))
def q_normalized_score(spark, sf):
    c = _cands(spark, sf)
    return c.select("pos_id", "uci", normalized_score("cp", "mate_in").alias("norm_score"))


@register("score_label", with_fx(
    "SELECT pos_id, uci, CASE WHEN mate_in IS NOT NULL THEN 'M' || CAST(mate_in AS VARCHAR) "
    "ELSE (CASE WHEN cp >= 0 THEN '+' ELSE '' END) || CAST(cp AS VARCHAR) || 'cp' END AS label "
    "FROM fx_candidates", "fx_candidates"))
def q_score_label(spark, sf):
    c = _cands(spark, sf)
    return c.select("pos_id", "uci", score_label("cp", "mate_in").alias("label"))
