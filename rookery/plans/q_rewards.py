"""Reward, diagnostics and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.functions import text as T
from rookery.functions.scores import score_expectation
from rookery.operators import evaluation as EV
from rookery.operators import rewards as R
from rookery.plans import sqlfrag as S
from rookery.plans.q_scoring import ANALYSED
from rookery.plans.registry import register
from rookery.sources.fixtures import plan_memo
from rookery.sources.fixtures import (fx_candidates, fx_positions, fx_rollouts, fx_valid_list,
                                      with_fx)

FX = ("fx_rollouts", "fx_positions", "fx_valid_list", "fx_candidates")
NL = "chr(10)"


@plan_memo
def analysis(spark, sf):
    return R.position_analysis(fx_candidates(spark, sf), fx_valid_list(spark, sf))


@plan_memo
def scored(spark, sf):
    r = fx_rollouts(spark, sf)
    return R.score_rollouts(r, fx_positions(spark, sf).select("pos_id", "fen"), analysis(spark, sf))


def e_sql(x: str) -> str:
    return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({x}) / 300.0::DOUBLE)))"


def rl_cp_sql(cp: str, mate: str) -> str:
    return f"(CASE WHEN {mate} > 0 THEN 10000 WHEN {mate} IS NOT NULL THEN -10000 ELSE {cp} END)"


LENIENT = S.q(T.MOVE_LENIENT)
FORMAT = S.q(T.FORMAT_PATTERN)


def tag_count_sql(x: str, tag: str) -> str:
    return f"len(regexp_extract_all({x}, {S.q('(?i)' + tag)}))"


SCORED_SQL = f"""{ANALYSED},
best AS (SELECT pos_id, uci AS best_uci, cp AS best_cp, mate_in AS best_mate_in FROM analysed WHERE rank = 1),
rs AS (SELECT prompt_id, sample_id, completion, '<think>' || {NL} || completion AS text FROM fx_rollouts),
rp AS (SELECT *, CASE WHEN regexp_matches(text, {LENIENT}) THEN lower(regexp_extract(text, {LENIENT}, 1)) END AS pred
  FROM rs),
sj AS (SELECT rp.*, p.fen, v.valid_moves, coalesce(list_contains(v.valid_moves, rp.pred), false) AS legal,
  a.rank AS pred_rank, a.cp AS pred_cp, a.mate_in AS pred_mate, b.best_uci, b.best_cp, b.best_mate_in,
  v.pos_id IS NOT NULL AS has_eval
  FROM rp LEFT JOIN fx_positions p ON p.pos_id = rp.prompt_id
  LEFT JOIN fx_valid_list v ON v.pos_id = rp.prompt_id
  LEFT JOIN analysed a ON a.pos_id = rp.prompt_id AND a.uci = rp.pred
  LEFT JOIN best b ON b.pos_id = rp.prompt_id),
so AS (SELECT *, CASE WHEN pred IS NULL OR fen IS NULL THEN 'no_move' WHEN NOT legal THEN 'illegal'
  WHEN NOT has_eval THEN 'legal' WHEN pred_rank = 1 THEN 'top1' WHEN pred_rank <= 3 THEN 'top3'
  WHEN pred_rank <= 5 THEN 'top5' ELSE 'legal' END AS outcome,
  {e_sql(rl_cp_sql('best_cp', 'best_mate_in'))} AS best_e,
  CASE WHEN pred_rank <= 5 THEN {e_sql(rl_cp_sql('pred_cp', 'pred_mate'))}
       WHEN pred_cp IS NOT NULL THEN 1.0::DOUBLE - {e_sql('-' + rl_cp_sql('pred_cp', 'pred_mate'))} END AS pred_e
  FROM sj),
sw AS (SELECT *, CASE WHEN pred IS NOT NULL AND fen IS NOT NULL AND legal AND pred = best_uci THEN 0.0::DOUBLE
  WHEN pred IS NOT NULL AND fen IS NOT NULL AND legal THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, best_e - pred_e))
  END AS wpd FROM so),
scored AS (SELECT *,
  CASE outcome WHEN 'no_move' THEN -1.0 WHEN 'illegal' THEN -0.5 WHEN 'top1' THEN 1.5 WHEN 'top3' THEN 1.0
    WHEN 'top5' THEN 0.6 ELSE 0.1 END::DOUBLE AS reward_topn,
  CASE WHEN outcome = 'no_move' THEN -1.0::DOUBLE WHEN outcome = 'illegal' THEN -0.5::DOUBLE
    WHEN wpd IS NULL THEN 0.3::DOUBLE
    ELSE greatest(-1.0::DOUBLE, 1.0::DOUBLE - wpd * 4.0::DOUBLE + CASE WHEN wpd < 0.05::DOUBLE
      THEN 0.5::DOUBLE * (1.0::DOUBLE - wpd / 0.05::DOUBLE) ELSE 0.0::DOUBLE END) END AS reward_wpd,
  CASE WHEN regexp_matches(text, {FORMAT}) THEN 0.1::DOUBLE ELSE -0.1::DOUBLE END AS reward_format,
  CASE WHEN {tag_count_sql('text', '<think>')} = 1 AND {tag_count_sql('text', '</think>')} = 1
    AND {tag_count_sql('text', '<uci_move>')} = 1 AND {tag_count_sql('text', '</uci_move>')} = 1
    THEN 0.05::DOUBLE ELSE -0.15::DOUBLE END AS reward_tag_count
  FROM sw)"""


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


@register("prefix_completion", with_fx(
    f"SELECT prompt_id, sample_id, CAST(length('<think>' || {NL} || completion) AS INT) AS n_chars, "
    f"starts_with('<think>' || {NL} || completion, '<think>' || {NL}) AS has_prefix FROM fx_rollouts", *FX))
def q_prefix_completion(spark, sf):
    r = fx_rollouts(spark, sf).withColumn("t", T.prefix_completion("completion"))
    return r.select("prompt_id", "sample_id", F.length("t").alias("n_chars"),
                    F.col("t").startswith(T.GENERATION_PREFIX).alias("has_prefix"))


@register("extract_move_lenient", with_fx(
    f"WITH {SCORED_SQL} SELECT prompt_id, sample_id, pred FROM scored", *FX))
def q_extract_move_lenient(spark, sf):
    r = fx_rollouts(spark, sf)
    return r.select("prompt_id", "sample_id", T.extract_move_lenient(T.prefix_completion("completion")).alias("pred"))


STRICT = S.q(T.MOVE_STRICT)


@register("extract_move_strict", with_fx(
    f"SELECT prompt_id, sample_id, CASE WHEN regexp_matches(completion, {STRICT}) "
    f"THEN regexp_extract(completion, {STRICT}, 1) END AS pred FROM fx_rollouts", *FX))
def q_extract_move_strict(spark, sf):
    r = fx_rollouts(spark, sf)
    return r.select("prompt_id", "sample_id", T.extract_move_strict("completion").alias("pred"))


@register("legal_semijoin", with_fx(
    f"WITH {SCORED_SQL} SELECT prompt_id, sample_id, pred FROM scored s WHERE EXISTS "
    "(SELECT 1 FROM fx_valid_moves v WHERE v.pos_id = s.prompt_id AND v.uci = s.pred)", *FX, "fx_valid_moves"))
def q_legal_semijoin(spark, sf):
    """Predictions whose move is in the position's legal set (left semi join)."""
    from rookery.sources.fixtures import fx_valid_moves
    r = fx_rollouts(spark, sf).select(
        "prompt_id", "sample_id", T.extract_move_lenient(T.prefix_completion("completion")).alias("pred"))
    v = fx_valid_moves(spark, sf).select(F.col("pos_id").alias("prompt_id"), F.col("uci").alias("pred"))
    return r.join(v, ["prompt_id", "pred"], "left_semi").select("prompt_id", "sample_id", "pred")


@register("prediction_rank", with_fx(
    f"WITH {SCORED_SQL} SELECT prompt_id, sample_id, pred, pred_rank FROM scored", *FX))
def q_prediction_rank(spark, sf):
    return scored(spark, sf).select("prompt_id", "sample_id", "pred", "pred_rank")


@register("topn_residual", with_fx(
    f"WITH {SCORED_SQL} SELECT prompt_id, sample_id, pred FROM scored s WHERE legal AND pred IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM analysed a WHERE a.pos_id = s.prompt_id AND a.uci = s.pred AND a.rank <= 5)",
    *FX))
def q_topn_residual(spark, sf):
    """Legal predictions outside the top-N (need a second evaluation): anti join."""
    from rookery.operators.scoring import rank_candidates
    s = scored(spark, sf).filter(F.col("legal") & F.col("pred").isNotNull())
    top = rank_candidates(fx_candidates(spark, sf)).filter("rank <= 5").select(
        F.col("pos_id").alias("prompt_id"), F.col("uci").alias("pred"))
    return s.join(top, ["prompt_id", "pred"], "left_anti").select("prompt_id", "sample_id", "pred")


@register("distinct_pos_move", with_fx(
    f"WITH {SCORED_SQL}, dm AS (SELECT DISTINCT fen, pred FROM scored WHERE legal AND pred IS NOT NULL), "
    "ev AS (SELECT dm.fen, dm.pred, CAST(length(dm.fen) + length(dm.pred) AS INT) AS work FROM dm) "
    "SELECT s.prompt_id, s.sample_id, ev.work FROM scored s JOIN ev ON ev.fen = s.fen AND ev.pred = s.pred "
    "WHERE s.legal AND s.pred IS NOT NULL", *FX))
def q_distinct_pos_move(spark, sf):
    """Per-(position, move) work runs once on the distinct pairs and joins back."""
    s = scored(spark, sf).filter(F.col("legal") & F.col("pred").isNotNull())
    dm = s.select("fen", "pred").dropDuplicates(["fen", "pred"])
    ev = dm.select("fen", "pred", (F.length("fen") + F.length("pred")).alias("work"))
    return s.join(ev, ["fen", "pred"]).select("prompt_id", "sample_id", "work")


@register("reward_topn", with_fx(
    f"WITH {SCORED_SQL} SELECT prompt_id, sample_id, pred, outcome, reward_topn FROM scored", *FX))
def q_reward_topn(spark, sf):
    return scored(spark, sf).select("prompt_id", "sample_id", "pred", "outcome", "reward_topn")


@register("wpd", with_fx(
    f"WITH {SCORED_SQL} SELECT prompt_id, sample_id, pred, round(wpd, 6) AS wpd FROM scored", *FX))
def q_wpd(spark, sf):
    return scored(spark, sf).select("prompt_id", "sample_id", "pred", _r6("wpd"))


@register("reward_wpd", with_fx(
    f"WITH {SCORED_SQL} SELECT prompt_id, sample_id, round(reward_wpd, 6) AS reward_wpd FROM scored", *FX))
def q_reward_wpd(spark, sf):
    return scored(spark, sf).select("prompt_id", "sample_id", _r6("reward_wpd"))


WPD_CLASS_SQL = ("CASE WHEN wpd IS NULL THEN NULL WHEN wpd < 0.02 THEN 'excellent' WHEN wpd < 0.05 THEN 'good' "
                 "WHEN wpd < 0.10 THEN 'acceptable' WHEN wpd < 0.20 THEN 'inaccuracy' WHEN wpd < 0.35 THEN 'mistake' "
                 "ELSE 'blunder' END")


@register("wpd_class", with_fx(
    f"WITH {SCORED_SQL} SELECT prompt_id, sample_id, {WPD_CLASS_SQL} AS wpd_class FROM scored", *FX))
def q_wpd_class(spark, sf):
    return scored(spark, sf).select("prompt_id", "sample_id", R.wpd_class("wpd").alias("wpd_class"))


@register("score_expectation", with_fx(
    f"SELECT pos_id, uci, round({e_sql(rl_cp_sql('cp', 'mate_in'))}, 6) AS expectation, "
    f"round(1.0::DOUBLE - {e_sql('-' + rl_cp_sql('cp', 'mate_in'))}, 6) AS opponent_view FROM fx_candidates",
    "fx_candidates"))
def q_score_expectation(spark, sf):
    c = fx_candidates(spark, sf)
    cp = R.rl_cp(F.col("cp"), F.col("mate_in"))
    return c.select("pos_id", "uci", F.round(score_expectation(cp), 6).alias("expectation"),
                    F.round(F.lit(1.0) - score_expectation(-cp), 6).alias("opponent_view"))


@register("reward_format", with_fx(
    f"WITH {SCORED_SQL} SELECT prompt_id, sample_id, reward_format FROM scored", *FX))
def q_reward_format(spark, sf):
    return scored(spark, sf).select("prompt_id", "sample_id", "reward_format")


@register("reward_tag_count", with_fx(
    f"WITH {SCORED_SQL} SELECT prompt_id, sample_id, reward_tag_count FROM scored", *FX))
def q_reward_tag_count(spark, sf):
    return scored(spark, sf).select("prompt_id", "sample_id", "reward_tag_count")


@register("reward_total", with_fx(
    f"WITH {SCORED_SQL} SELECT prompt_id, sample_id, round(reward_wpd + reward_format + reward_tag_count, 6) "
    "AS reward_total FROM scored", *FX))
def q_reward_total(spark, sf):
    s = scored(spark, sf)
    return s.select("prompt_id", "sample_id",
                    F.round(R.reward_total(["wpd", "format", "xml_count"]), 6).alias("reward_total"))


def brevity(chars):
    """A user's reward: up to 0.1 for a short completion."""
    import pyarrow as pa
    import pyarrow.compute as pc
    share = pc.subtract(1.0, pc.divide(chars.cast(pa.float64()), 4000.0))
    return pc.multiply(0.1, pc.max_element_wise(share, 0.0, skip_nulls=False))


@register("reward_registry", with_fx(
    f"WITH {SCORED_SQL} SELECT prompt_id, sample_id, round(reward_topn + reward_format + reward_tag_count, 6) "
    "AS reward_topn_total, round(reward_wpd + reward_format + reward_tag_count, 6) AS reward_wpd_total, "
    "round(reward_format + reward_tag_count + CASE WHEN length(completion) > 2000 THEN -0.05 ELSE 0.0 END, 6) "
    "AS reward_custom, round(reward_format + 0.1::DOUBLE * greatest(0.0::DOUBLE, 1.0::DOUBLE - length(completion) / 4000.0::DOUBLE), 6) AS reward_arrow FROM scored", *FX))
def q_reward_registry(spark, sf):
    """Rewards chosen by name and summed; rewards that a user registers, a column
    and a function over Arrow batches, join the sum."""
    R.register_arrow_reward("brevity", brevity, ["completion_chars"])
    R.register_reward("length_penalty", lambda: F.when(F.col("completion_chars") > 2000, F.lit(-0.05))
                      .otherwise(F.lit(0.0)))
    s = scored(spark, sf)
    return s.select("prompt_id", "sample_id",
                    F.round(R.reward_total(["topn", "format", "xml_count"]), 6).alias("reward_topn_total"),
                    F.round(R.reward_total(["wpd", "format", "xml_count"]), 6).alias("reward_wpd_total"),
                    F.round(R.reward_total(["format", "xml_count", "length_penalty"]), 6).alias("reward_custom"),
                    F.round(R.reward_total(["format", "brevity"]), 6).alias("reward_arrow"))


@register("reward_stats", with_fx(
    f"WITH {SCORED_SQL} SELECT count(*) AS total, "
    + ", ".join(f"round(avg(CASE WHEN outcome = '{o}' THEN 1.0 ELSE 0.0 END::DOUBLE), 6) AS {o}_rate"
                for o in ("top1", "top3", "top5", "legal", "illegal", "no_move")) + " FROM scored", *FX))
def q_reward_stats(spark, sf):
    st = R.reward_stats(scored(spark, sf))
    return st.select("total", *[_r6(f"{o}_rate") for o in ("top1", "top3", "top5", "legal", "illegal", "no_move")])


WPD_CLASSES = ("excellent", "good", "acceptable", "inaccuracy", "mistake", "blunder")


@register("wpd_stats", with_fx(
    f"WITH {SCORED_SQL}, c AS (SELECT *, {WPD_CLASS_SQL} AS cls FROM scored) SELECT "
    "count(*) FILTER (WHERE outcome NOT IN ('no_move', 'illegal')) AS legal, "
    + ", ".join(f"round(coalesce(count(*) FILTER (WHERE cls = '{c}')::DOUBLE / nullif(count(*) FILTER "
                f"(WHERE outcome NOT IN ('no_move', 'illegal')), 0), 0.0), 6) AS {c}_rate" for c in WPD_CLASSES)
    + ", round(avg(wpd), 6) AS avg_wpd FROM c", *FX))
def q_wpd_stats(spark, sf):
    """Class rates over legal predictions, mean WPD over known WPDs."""
    s = scored(spark, sf).withColumn("cls", R.wpd_class("wpd"))
    legal = F.count(F.when(~F.col("outcome").isin("no_move", "illegal"), 1))
    aggs = [legal.alias("legal")]
    for c in WPD_CLASSES:
        rate = F.count(F.when(F.col("cls") == c, 1)) / F.when(legal > 0, legal)
        aggs.append(F.round(F.coalesce(rate, F.lit(0.0)), 6).alias(f"{c}_rate"))
    aggs.append(F.round(F.avg("wpd"), 6).alias("avg_wpd"))
    return s.agg(*aggs)


@register("reuse_rates", with_fx(
    f"WITH {SCORED_SQL}, lg AS (SELECT * FROM scored WHERE outcome NOT IN ('no_move', 'illegal')), "
    "mp AS (SELECT count(*) AS n FROM lg WHERE pred <> best_uci AND pred_rank <= 5), "
    "nd AS (SELECT count(*) AS n, count(DISTINCT (fen, pred)) AS d FROM lg WHERE pred <> best_uci "
    "AND (pred_rank IS NULL OR pred_rank > 5)) "
    "SELECT round(1.0 - (SELECT count(DISTINCT fen) FROM scored WHERE fen IS NOT NULL)::DOUBLE / "
    "greatest((SELECT count(fen) FROM scored), 1), 6) AS position_reuse, "
    "round((SELECT n FROM mp)::DOUBLE / greatest((SELECT count(*) FROM lg), 1), 6) AS multipv_hit_rate, "
    "round(((SELECT n FROM nd) - (SELECT d FROM nd))::DOUBLE / greatest((SELECT count(*) FROM lg) - "
    "(SELECT n FROM mp), 1), 6) AS postmove_reuse", *FX))
def q_reuse_rates(spark, sf):
    s = scored(spark, sf)
    lg = F.col("pred").isNotNull() & F.col("fen").isNotNull() & F.col("legal")
    multipv = lg & (F.col("pred") != F.col("best_uci")) & (F.col("pred_rank") <= 5)
    need = lg & (F.col("pred") != F.col("best_uci")) & (F.col("pred_rank").isNull() | (F.col("pred_rank") > 5))
    a = s.agg(
        F.count_distinct("fen").alias("dfen"), F.count("fen").alias("nfen"),
        F.count(F.when(lg, 1)).alias("nlegal"), F.count(F.when(multipv, 1)).alias("nmp"),
        F.count(F.when(need, 1)).alias("nneed"),
        F.count_distinct(F.when(need, F.struct("fen", "pred"))).alias("dneed"))
    return a.select(
        F.round(1.0 - F.col("dfen") / F.greatest(F.col("nfen"), F.lit(1)), 6).alias("position_reuse"),
        F.round(F.col("nmp") / F.greatest(F.col("nlegal"), F.lit(1)), 6).alias("multipv_hit_rate"),
        F.round((F.col("nneed") - F.col("dneed")) / F.greatest(F.col("nlegal") - F.col("nmp"), F.lit(1)), 6)
        .alias("postmove_reuse"))


DIVERSITY_SQL = f"""{SCORED_SQL},
tot AS (SELECT *, reward_wpd + reward_format + reward_tag_count AS reward_total FROM scored),
md AS (SELECT fen, max(c) AS mode_count FROM (SELECT fen, pred, count(*) AS c FROM tot WHERE pred IS NOT NULL
  GROUP BY fen, pred) GROUP BY fen),
gd AS (SELECT t.fen, count(*) AS group_size, count(pred) AS parsed, count(DISTINCT pred) AS unique_moves,
  coalesce(stddev_samp(reward_total), 0.0) AS reward_std FROM tot t GROUP BY t.fen),
div AS (SELECT gd.fen, group_size, parsed::DOUBLE / group_size AS parse_rate, unique_moves,
  CASE WHEN parsed > 0 THEN md.mode_count::DOUBLE / parsed ELSE 1.0 END AS mode_share, reward_std
  FROM gd LEFT JOIN md ON md.fen IS NOT DISTINCT FROM gd.fen)"""


@plan_memo
def diversity(spark, sf):
    s = scored(spark, sf).withColumn("reward_total", R.reward_total(["wpd", "format", "xml_count"]))
    return R.group_diversity(s)


@register("group_diversity", with_fx(
    f"WITH {DIVERSITY_SQL} SELECT fen, group_size, round(parse_rate, 6) AS parse_rate, unique_moves, "
    "round(mode_share, 6) AS mode_share, round(reward_std, 6) AS reward_std FROM div", *FX))
def q_group_diversity(spark, sf):
    d = diversity(spark, sf)
    return d.select("fen", "group_size", _r6("parse_rate"), "unique_moves", _r6("mode_share"), _r6("reward_std"))


@register("diversity_summary", with_fx(
    f"WITH {DIVERSITY_SQL} SELECT count(*) AS prompts, round(avg(group_size), 6) AS avg_group_size, "
    "round(avg(unique_moves), 6) AS avg_unique_moves, min(unique_moves) AS min_unique_moves, "
    "round(avg(mode_share), 6) AS avg_mode_share, round(avg(parse_rate), 6) AS avg_parse_rate, "
    "round(avg(reward_std), 6) AS avg_reward_std, "
    "round(avg(CASE WHEN reward_std < 0.001 THEN 1.0 ELSE 0.0 END), 6) AS near_zero_std_rate FROM div", *FX))
def q_diversity_summary(spark, sf):
    d = diversity(spark, sf)
    return d.agg(F.count(F.lit(1)).alias("prompts"), F.round(F.avg("group_size"), 6).alias("avg_group_size"),
                 F.round(F.avg("unique_moves"), 6).alias("avg_unique_moves"),
                 F.min("unique_moves").alias("min_unique_moves"),
                 F.round(F.avg("mode_share"), 6).alias("avg_mode_share"),
                 F.round(F.avg("parse_rate"), 6).alias("avg_parse_rate"),
                 F.round(F.avg("reward_std"), 6).alias("avg_reward_std"),
                 F.round(F.avg(F.when(F.col("reward_std") < 1e-3, 1.0).otherwise(0.0)), 6).alias("near_zero_std_rate"))


# ---- offline evaluation -------------------------------------------------------

EVAL_SQL = f"""{ANALYSED},
best AS (SELECT pos_id, uci AS best_uci, cp AS best_cp, mate_in AS best_mate_in FROM analysed WHERE rank = 1),
ep AS (SELECT prompt_id, sample_id, CASE WHEN regexp_matches(completion, {STRICT})
  THEN regexp_extract(completion, {STRICT}, 1) END AS pred FROM fx_rollouts),
ej AS (SELECT ep.*, ep.pred IS NOT NULL AS is_parsed,
  ep.pred IS NOT NULL AND coalesce(list_contains(v.valid_moves, ep.pred), false) AS is_legal,
  b.best_uci, a.rank AS pred_rank,
  CASE WHEN a.mate_in > 0 THEN 10000 WHEN a.mate_in IS NOT NULL THEN -10000 ELSE a.cp END AS pred_cp,
  CASE WHEN b.best_mate_in > 0 THEN 10000 WHEN b.best_mate_in IS NOT NULL THEN -10000 ELSE b.best_cp END AS best_cp
  FROM ep LEFT JOIN fx_valid_list v ON v.pos_id = ep.prompt_id
  LEFT JOIN best b ON b.pos_id = ep.prompt_id
  LEFT JOIN analysed a ON a.pos_id = ep.prompt_id AND a.uci = ep.pred),
flags AS (SELECT prompt_id, sample_id, pred, is_parsed, is_legal,
  is_legal AND best_uci IS NOT NULL AND pred = best_uci AS is_exact_match,
  is_legal AND best_uci IS NOT NULL AND coalesce(pred_rank <= 3, false) AS is_top3,
  is_legal AND best_uci IS NOT NULL AND coalesce(pred_rank <= 5, false) AS is_top5,
  CAST(CASE WHEN is_legal AND best_uci IS NOT NULL AND pred_cp IS NOT NULL THEN abs(best_cp - pred_cp) END AS INT)
    AS centipawn_loss FROM ej)"""

BUCKET_SQL = ("CASE WHEN centipawn_loss <= 10 THEN '0-10' WHEN centipawn_loss <= 25 THEN '10-25' "
              "WHEN centipawn_loss <= 50 THEN '25-50' WHEN centipawn_loss <= 100 THEN '50-100' "
              "WHEN centipawn_loss <= 200 THEN '100-200' ELSE '200+' END")
BUCKETS_SQL = ("bk AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{lbl}')" for i, (lbl, _) in enumerate(EV.CP_LOSS_BUCKETS)) + ") t(bucket_ord, bucket))")
HIST_SQL = (f"{BUCKETS_SQL}, hc AS (SELECT {BUCKET_SQL} AS bucket, count(*) AS n FROM flags WHERE centipawn_loss "
            "IS NOT NULL GROUP BY 1), hist AS (SELECT bk.bucket_ord, bk.bucket, coalesce(hc.n, 0) AS n FROM bk "
            "LEFT JOIN hc ON hc.bucket = bk.bucket)")


@plan_memo
def eval_flags(spark, sf):
    return EV.eval_flags(fx_rollouts(spark, sf), analysis(spark, sf))


@register("eval_flags", with_fx(f"WITH {EVAL_SQL} SELECT * FROM flags", *FX))
def q_eval_flags(spark, sf):
    return eval_flags(spark, sf)


@register("eval_cp_loss", with_fx(
    f"WITH {EVAL_SQL} SELECT prompt_id, sample_id, centipawn_loss FROM flags WHERE centipawn_loss IS NOT NULL", *FX))
def q_eval_cp_loss(spark, sf):
    return eval_flags(spark, sf).filter(F.col("centipawn_loss").isNotNull()).select(
        "prompt_id", "sample_id", "centipawn_loss")


@register("cp_loss_histogram", with_fx(
    f"WITH {EVAL_SQL}, {HIST_SQL} SELECT CAST(bucket_ord AS INT) AS bucket_ord, bucket, n FROM hist", *FX))
def q_cp_loss_histogram(spark, sf):
    return EV.cp_loss_histogram(spark, eval_flags(spark, sf))


@register("histogram_report", with_fx(
    f"WITH {EVAL_SQL}, {HIST_SQL}, hp AS (SELECT *, CASE WHEN sum(n) OVER () > 0 THEN n * 100.0::DOUBLE / "
    "sum(n) OVER () ELSE 0.0::DOUBLE END AS pct FROM hist) SELECT CAST(bucket_ord AS INT) AS bucket_ord, bucket, n, "
    "round(pct, 6) AS pct, repeat('█', CAST(floor(pct / 2) AS INT)) AS bar FROM hp", *FX))
def q_histogram_report(spark, sf):
    return EV.histogram_report(EV.cp_loss_histogram(spark, eval_flags(spark, sf)))


METRICS_SQL = ("count(*) AS num_samples, "
               + ", ".join(f"round(coalesce(avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END::DOUBLE), 0.0), 6) AS {n}"
                           for c, n in (("is_parsed", "tag_parse_rate"), ("is_legal", "legal_move_rate"),
                                        ("is_exact_match", "exact_match_rate"), ("is_top3", "top_3_match_rate"),
                                        ("is_top5", "top_5_match_rate")))
               + ", round(CASE WHEN count(centipawn_loss) > 0 THEN sum(centipawn_loss)::DOUBLE / "
                 "count(centipawn_loss) ELSE 0.0 END, 6) AS avg_centipawn_loss")
METRIC_COLS = ("tag_parse_rate", "legal_move_rate", "exact_match_rate", "top_3_match_rate", "top_5_match_rate",
               "avg_centipawn_loss")


def metrics_frame(flags):
    m = EV.eval_metrics(flags)
    return m.select("num_samples", *[_r6(c) for c in METRIC_COLS])


@register("eval_metrics", with_fx(f"WITH {EVAL_SQL} SELECT {METRICS_SQL} FROM flags", *FX))
def q_eval_metrics(spark, sf):
    return metrics_frame(eval_flags(spark, sf))


@register("metrics_long", with_fx(
    f"WITH {EVAL_SQL}, m AS (SELECT CAST(prompt_id % 4 AS INT) AS step, {METRICS_SQL} FROM flags GROUP BY 1) "
    "SELECT step, metric, value FROM (UNPIVOT m ON " + ", ".join(METRIC_COLS)
    + " INTO NAME metric VALUE value)", *FX))
def q_metrics_long(spark, sf):
    """Per-step metrics (step = prompt_id mod 4) unpivoted to (step, metric, value)."""
    f = eval_flags(spark, sf).withColumn("step", (F.col("prompt_id") % 4).cast("int"))
    per = []
    m = None
    from rookery.operators.evaluation import eval_metrics  # noqa: F401
    rate = lambda c: F.round(F.coalesce(F.avg(F.col(c).cast("int").cast("double")), F.lit(0.0)), 6)
    valid = F.count("centipawn_loss")
    m = f.groupBy("step").agg(
        rate("is_parsed").alias("tag_parse_rate"), rate("is_legal").alias("legal_move_rate"),
        rate("is_exact_match").alias("exact_match_rate"), rate("is_top3").alias("top_3_match_rate"),
        rate("is_top5").alias("top_5_match_rate"),
        F.round(F.when(valid > 0, F.sum("centipawn_loss") / valid).otherwise(F.lit(0.0)), 6)
        .alias("avg_centipawn_loss"))
    del per
    return m.unpivot("step", list(METRIC_COLS), "metric", "value")


@register("class_mix_sample", with_fx(
    f"WITH {EVAL_SQL}, c AS (SELECT *, CASE WHEN is_exact_match THEN 'exact' WHEN is_legal THEN 'legal' "
    f"ELSE 'fail' END AS cls, {S.uniform(42, 'prompt_id', 'sample_id')} AS u FROM flags), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY u, prompt_id, sample_id) AS pick FROM c), "
    "k AS (SELECT *, CASE cls WHEN 'exact' THEN 0 WHEN 'legal' THEN 1 ELSE 2 END AS cls_ord FROM r "
    "WHERE pick <= CASE cls WHEN 'exact' THEN 4 ELSE 3 END) "
    "SELECT prompt_id, sample_id, cls, CAST(row_number() OVER (ORDER BY cls_ord, u, prompt_id, sample_id) AS INT) "
    "AS slot FROM k", *FX))
def q_class_mix_sample(spark, sf):
    return EV.class_mix_sample(eval_flags(spark, sf)).select("prompt_id", "sample_id", "cls", "slot")
