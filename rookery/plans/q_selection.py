"""Selection, styles, traps, bands, PV lines, depth merge and config
overrides (SURVEY 2.6: 65-78, 2.7: 79-82, 2.5 #52, 2.2 #20)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rookery.functions.draws import hash_uniform
from rookery.functions.scores import win_probability
from rookery.operators import lines as LN
from rookery.operators import selection as SEL
from rookery.operators.scoring import analyse_candidates, softmax_policy
from rookery.plans import sqlfrag as S
from rookery.plans.q_scoring import ANALYSED, POLICY, PROFILE, profile_frame, win_prob_sql
from rookery.plans.registry import register
from rookery.session import cut_lineage
from rookery.sources.fixtures import plan_memo
from rookery.sources.fixtures import (fx_candidates, fx_games, fx_positions, fx_puzzle_records, fx_puzzles,
                                      fx_pv, fx_valid_moves, with_fx)
from rookery.sources.sinks import write_bucketed
from rookery.functions.casts import rating_or_default
from rookery.functions.text import tokens

C = ("fx_candidates",)


@plan_memo
def analysed(spark, sf):
    return analyse_candidates(fx_candidates(spark, sf))


POOL_SQL = f"""{ANALYSED},
cp0 AS (SELECT *, count(*) OVER (PARTITION BY pos_id) AS n FROM analysed),
cp1 AS (SELECT *, least(8, n) AS max_c, {S.uniform(42, 'pos_id', "'count'")} AS uc FROM cp0),
cp2 AS (SELECT *, CASE WHEN max_c > 3 THEN 3 + CAST(floor(uc * (max_c - 3 + 1)) AS INT) ELSE max_c END AS cnt FROM cp1),
cp3 AS (SELECT *, greatest(cnt, least(12, n)) AS cap FROM cp2),
cp4 AS (SELECT *, CASE WHEN cap <= cnt THEN -CAST(rank AS DOUBLE) ELSE
  ln(greatest({S.uniform(42, 'pos_id', 'uci', "'pool'")}, 1e-300::DOUBLE)) / coalesce(exp(win_prob / 0.25::DOUBLE), 1.0::DOUBLE)
  END AS k FROM cp3 WHERE rank <= cap),
pool AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pos_id ORDER BY k DESC, rank) AS pick FROM cp4)
  WHERE pick <= cnt)"""


@plan_memo
def pool_frame(spark, sf):
    return SEL.candidate_pool(analysed(spark, sf))


@register("candidate_pool", with_fx(
    f"WITH {POOL_SQL} SELECT pos_id, uci, rank, CAST(pick AS INT) AS pick FROM pool", *C))
def q_candidate_pool(spark, sf):
    return pool_frame(spark, sf).select("pos_id", "uci", "rank", "pick")


@register("weighted_sample_wor", with_fx(
    f"WITH {ANALYSED} SELECT pos_id, uci, CAST(pick AS INT) AS pick FROM (SELECT pos_id, uci, row_number() OVER "
    f"(PARTITION BY pos_id ORDER BY ln(greatest({S.uniform(42, 'pos_id', 'uci', chr(39) + 'wor' + chr(39))}, "
    "1e-300::DOUBLE)) / exp(win_prob / 0.25::DOUBLE) DESC, uci) AS pick FROM analysed) WHERE pick <= 3", *C))
def q_weighted_sample_wor(spark, sf):
    a = analysed(spark, sf)
    s = SEL.weighted_sample_wor(a, "pos_id", "uci", F.exp(F.col("win_prob") / F.lit(0.25)), 3)
    return s.select("pos_id", "uci", "pick")


@register("weighted_choice", with_fx(
    f"WITH {ANALYSED}, wc AS (SELECT pos_id, uci, rank, sum(greatest(win_prob, 0.0::DOUBLE)) OVER (PARTITION BY pos_id "
    "ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum, sum(greatest(win_prob, 0.0::DOUBLE)) OVER "
    f"(PARTITION BY pos_id) AS tot, {S.uniform(42, 'pos_id', chr(39) + 'choice' + chr(39))} AS u FROM analysed) "
    "SELECT pos_id, uci, rank FROM (SELECT *, row_number() OVER (PARTITION BY pos_id ORDER BY rank) AS r FROM wc "
    "WHERE u * tot <= cum) WHERE r = 1", *C))
def q_weighted_choice(spark, sf):
    return SEL.weighted_choice(analysed(spark, sf), "pos_id", "rank", "win_prob").select("pos_id", "uci", "rank")


# ---- styles ----------------------------------------------------------------------

def style_inputs(spark, sf):
    g = fx_positions(spark, sf).select(F.lit("game").alias("source"), F.col("pos_id").alias("id"),
                                       F.array().cast("array<string>").alias("themes"),
                                       F.lit(None).cast("int").alias("rating"))
    p = fx_puzzle_records(spark, sf).select(F.lit("puzzle").alias("source"), F.col("puzzle_id").alias("id"),
                                            tokens(F.coalesce(F.col("themes"), F.lit(""))).alias("themes"),
                                            rating_or_default("rating").alias("rating"))
    return g.unionByName(p)


def _cond_sql(cond: str) -> str:
    kind, _, arg = cond.partition(":")
    lc = "list_transform(themes, lambda t: lower(trim(t)))"
    if kind == "theme_contains":
        return f"len(list_filter({lc}, lambda t: strpos(t, {S.q(arg)}) > 0)) > 0"
    if kind == "theme_is":
        return f"list_contains({lc}, {S.q(arg)})"
    if kind == "theme_tactical":
        ors = " OR ".join(f"strpos(t, {S.q(m)}) > 0" for m in SEL.TACTICAL_MARKERS)
        return f"len(list_filter({lc}, lambda t: {ors})) > 0"
    if kind == "rating_ge":
        return f"coalesce(rating >= {arg}, false)"
    if kind == "rating_le":
        return f"coalesce(rating <= {arg}, false)"
    raise ValueError(cond)


def _weights_sql() -> str:
    out = []
    for s in SEL.STYLES:
        w = (f"(CASE WHEN source = 'puzzle' THEN {SEL.STYLE_WEIGHTS['puzzle'].get(s, 0.0)}::DOUBLE "
             f"ELSE {SEL.STYLE_WEIGHTS['game'].get(s, 0.0)}::DOUBLE END)")
        for cond, bumps in SEL.PUZZLE_BUMPS:
            for style, factor in bumps:
                if style == s:
                    w = (f"({w} * CASE WHEN source = 'puzzle' AND {_cond_sql(cond)} THEN {factor}::DOUBLE "
                         "ELSE 1.0::DOUBLE END)")
        out.append(w)
    return "[" + ", ".join(out) + "]"


STYLE_LIST = "[" + ", ".join(S.q(s) for s in SEL.STYLES) + "]"
STYLE_SQL = f"""si AS (
 SELECT 'game' AS source, pos_id AS id, []::VARCHAR[] AS themes, CAST(NULL AS INT) AS rating FROM fx_positions
 UNION ALL SELECT 'puzzle', puzzle_id, {S.tokens("coalesce(themes, '')")}, {S.rating_or_default('rating')}
 FROM fx_puzzle_records),
sw AS (SELECT *, list_transform({_weights_sql()}, lambda x: greatest(x, 0.0::DOUBLE)) AS w,
  {S.uniform(42, 'source', 'id', chr(39) + 'style' + chr(39))} AS u FROM si),
st AS (SELECT *, list_reduce(w, lambda a, x: a + x, 0.0::DOUBLE) AS tot FROM sw),
sp AS (SELECT *, list_reduce(w, lambda acc, x: struct_pack(run := acc.run + x,
  idx := CASE WHEN acc.idx < 0 AND u * tot <= acc.run + x THEN acc.i ELSE acc.idx END, i := acc.i + 1),
  struct_pack(run := 0.0::DOUBLE, idx := -1, i := 0)).idx AS idx FROM st),
styles AS (SELECT source, id, {STYLE_LIST}[CASE WHEN tot <= 0 THEN 0 ELSE greatest(idx, 0) END + 1] AS style FROM sp)"""


@plan_memo
def styles_frame(spark, sf):
    return SEL.select_style(style_inputs(spark, sf), "source", "id", "themes", "rating")


@register("style_select", with_fx(f"WITH {STYLE_SQL} SELECT source, id, style FROM styles",
                                  "fx_positions", "fx_puzzle_records"))
def q_style_select(spark, sf):
    return styles_frame(spark, sf).select("source", "id", "style")


def _pool_sql(name: str, u2: str) -> str:
    items = [S.q(x) if x is not None else "style" for x in SEL.OVERRIDE_POOLS[name]]
    return f"[{', '.join(items)}][CAST(floor({u2} * {len(items)}) AS INT) + 1]"


@register("style_override", with_fx(
    f"WITH {STYLE_SQL}, {ANALYSED}, {POLICY}, {PROFILE}, so AS (SELECT s.id AS pos_id, s.style, p.forced_mate, "
    f"p.only_move, p.many_options, {S.uniform(42, 's.id', chr(39) + 'override' + chr(39))} AS u, "
    f"{S.uniform(42, 's.id', chr(39) + 'override_pick' + chr(39))} AS u2 FROM styles s JOIN profile p "
    "ON p.pos_id = s.id WHERE s.source = 'game') SELECT pos_id, style, CASE WHEN u < 0.35::DOUBLE THEN CASE "
    f"WHEN forced_mate THEN {_pool_sql('forced_mate', 'u2')} WHEN only_move THEN {_pool_sql('only_move', 'u2')} "
    f"WHEN many_options THEN {_pool_sql('many_options', 'u2')} ELSE style END ELSE style END AS final_style FROM so",
    "fx_positions", "fx_puzzle_records", "fx_candidates", "fx_valid_moves"))
def q_style_override(spark, sf):
    s = styles_frame(spark, sf).filter(F.col("source") == "game").select(F.col("id").alias("pos_id"), "style")
    prof = profile_frame(spark, sf).select("pos_id", "forced_mate", "only_move", "many_options")
    j = s.join(prof, "pos_id")
    return SEL.override_style(j, "pos_id").select("pos_id", "style", "final_style")


# ---- traps and bands ---------------------------------------------------------------

TRAP_SQL = f"""{ANALYSED},
t0 AS (SELECT *, max(shallow_cp) OVER (PARTITION BY pos_id) AS bs, {win_prob_sql('shallow_cp')} AS swp FROM analysed),
t1 AS (SELECT *, max(swp) OVER (PARTITION BY pos_id) AS bswp FROM t0),
t2 AS (SELECT *,
  shallow_cp IS NOT NULL AND bs IS NOT NULL AND abs(cp - shallow_cp) >= 80 AND shallow_cp >= bs - 30 AND cp <= bs - 120 AS cpt,
  shallow_cp IS NOT NULL AND bs IS NOT NULL AND abs(cp - shallow_cp) >= 80 AND shallow_cp <= bs - 120 AND cp >= bs - 30 AS cpr,
  swp IS NOT NULL AND bswp IS NOT NULL AND abs(win_prob - swp) >= 0.12::DOUBLE AND swp >= bswp - 0.06::DOUBLE
    AND win_prob <= bswp - 0.18::DOUBLE AS wpt,
  swp IS NOT NULL AND bswp IS NOT NULL AND abs(win_prob - swp) >= 0.12::DOUBLE AND swp <= bswp - 0.18::DOUBLE
    AND win_prob >= bswp - 0.06::DOUBLE AS wpr FROM t1),
traps AS (SELECT *, CASE WHEN cpt THEN 'trap' WHEN cpr THEN 'resource' WHEN wpt THEN 'trap' WHEN wpr THEN 'resource'
  END AS trap_kind, CASE WHEN cpt OR cpr THEN 'cp' WHEN wpt OR wpr THEN 'wp' END AS trap_rule FROM t2)"""


@plan_memo
def traps_frame(spark, sf):
    return SEL.trap_detect(analysed(spark, sf))


@register("trap_detect", with_fx(f"WITH {TRAP_SQL} SELECT pos_id, uci, trap_kind, trap_rule FROM traps", *C))
def q_trap_detect(spark, sf):
    return traps_frame(spark, sf).select("pos_id", "uci", "trap_kind", "trap_rule")


@register("trap_confirm", with_fx(
    f"WITH {TRAP_SQL} SELECT pos_id, uci, trap_kind, CASE WHEN confirm_cp IS NOT NULL AND cp IS NOT NULL THEN "
    "CASE WHEN abs(confirm_cp - cp) <= 30 THEN 'confirmed' ELSE 'uncertain' END ELSE 'uncertain' END AS confidence "
    "FROM traps WHERE trap_kind IS NOT NULL", *C))
def q_trap_confirm(spark, sf):
    t = SEL.trap_confirm(traps_frame(spark, sf)).filter(F.col("trap_kind").isNotNull())
    return t.select("pos_id", "uci", "trap_kind", "confidence")


@register("avoid_blunder", with_fx(
    f"WITH {ANALYSED}, {POLICY}, ab0 AS (SELECT a.*, coalesce(p.prob, 0.0::DOUBLE) AS p, "
    "max(a.shallow_cp) OVER (PARTITION BY a.pos_id) AS bs FROM analysed a LEFT JOIN pol p ON p.pos_id = a.pos_id "
    "AND p.uci = a.uci), ab1 AS (SELECT *, CASE WHEN bs IS NOT NULL AND shallow_cp IS NOT NULL AND "
    "shallow_cp >= bs - 30 AND cp <= bs - 120 THEN 3 ELSE 0 END AS tempting FROM ab0 WHERE rank <> 1 "
    "AND cp_loss >= 120 AND p >= 0.05::DOUBLE), ab2 AS (SELECT *, row_number() OVER (PARTITION BY pos_id ORDER BY "
    "tempting DESC, p DESC, cp_loss DESC, rank) AS r FROM ab1) SELECT pos_id, uci AS avoid_uci, tempting FROM ab2 "
    f"WHERE r = 1 AND {S.uniform(42, 'pos_id', chr(39) + 'avoid' + chr(39))} < 0.25::DOUBLE",
    "fx_candidates", "fx_valid_moves"))
def q_avoid_blunder(spark, sf):
    """Most tempting serious mistake (not the best move), gated at 25%."""
    a = analysed(spark, sf)
    pol = softmax_policy(fx_valid_moves(spark, sf), fx_candidates(spark, sf))
    return SEL.avoid_blunder(a, pol)


BEST_WIN_SQL = "max(CASE WHEN rank = 1 THEN win_prob END) OVER (PARTITION BY pos_id)"


@register("quality_band", with_fx(
    f"WITH {ANALYSED}, qb AS (SELECT *, {BEST_WIN_SQL} AS bw FROM analysed) SELECT pos_id, uci, CASE "
    "WHEN mate_in > 0 THEN 'forced_mate' WHEN mate_in IS NOT NULL THEN 'allows_mate' "
    "WHEN abs(win_prob - 0.5::DOUBLE) <= 0.04::DOUBLE AND bw - win_prob <= 0.02::DOUBLE THEN 'equal_best' "
    "WHEN abs(win_prob - 0.5::DOUBLE) <= 0.04::DOUBLE AND bw - win_prob <= 0.06::DOUBLE THEN 'equal_close' "
    "WHEN bw - win_prob <= 0.02::DOUBLE THEN 'best' WHEN bw - win_prob <= 0.06::DOUBLE THEN 'close' "
    "WHEN bw - win_prob <= 0.12::DOUBLE THEN 'inferior' ELSE 'bad' END AS band FROM qb", *C))
def q_quality_band(spark, sf):
    a = analysed(spark, sf)
    a = a.withColumn("bw", F.max(F.when(F.col("rank") == 1, F.col("win_prob"))).over(Window.partitionBy("pos_id")))
    return a.select("pos_id", "uci", SEL.quality_band(F.col("bw"), F.col("win_prob"), F.col("mate_in")).alias("band"))


@register("pros_cons_band", with_fx(
    f"WITH {ANALYSED}, qb AS (SELECT *, {BEST_WIN_SQL} AS bw FROM analysed) SELECT pos_id, uci, "
    "CASE WHEN win_prob < 0.35::DOUBLE THEN 'bad' WHEN win_prob < 0.45::DOUBLE THEN 'ok' ELSE 'close' END AS failure, "
    "CASE WHEN win_prob > 0.55::DOUBLE THEN 'strong' WHEN win_prob > 0.45::DOUBLE THEN 'solid' ELSE 'fighting' END "
    "AS pros, CASE WHEN rank = 1 THEN 'best' WHEN win_prob < bw - 0.1::DOUBLE THEN 'inferior' "
    "WHEN win_prob < bw - 0.05::DOUBLE THEN 'close' ELSE 'marginal' END AS cons FROM qb", *C))
def q_pros_cons_band(spark, sf):
    a = analysed(spark, sf)
    a = a.withColumn("bw", F.max(F.when(F.col("rank") == 1, F.col("win_prob"))).over(Window.partitionBy("pos_id")))
    wp = F.col("win_prob")
    return a.select("pos_id", "uci", SEL.failure_band(wp).alias("failure"), SEL.pros_band(wp).alias("pros"),
                    SEL.cons_band(F.col("rank") == 1, wp, F.col("bw")).alias("cons"))


@register("worst_and_top2", with_fx(
    f"WITH {POOL_SQL}, wt AS (SELECT pos_id, uci, pick, win_prob, count(*) OVER (PARTITION BY pos_id) AS k, "
    "row_number() OVER (PARTITION BY pos_id ORDER BY win_prob, pick) AS lo, "
    "row_number() OVER (PARTITION BY pos_id ORDER BY win_prob DESC, pick) AS hi FROM pool) "
    "SELECT pos_id, max(CASE WHEN lo = 1 THEN uci END) AS worst_uci, max(CASE WHEN hi = 1 THEN uci END) AS first_uci, "
    "max(CASE WHEN hi = 2 THEN uci END) AS second_uci FROM wt WHERE k >= 2 GROUP BY pos_id", *C))
def q_worst_and_top2(spark, sf):
    p = pool_frame(spark, sf)
    w = Window.partitionBy("pos_id")
    p = p.withColumn("k", F.count(F.lit(1)).over(w)).filter(F.col("k") >= 2)
    g = p.groupBy("pos_id").agg(
        F.min_by("uci", F.struct("win_prob", "pick")).alias("worst_uci"),
        F.max_by("uci", F.struct("win_prob", -F.col("pick"))).alias("first_uci"),
        F.sort_array(F.collect_list(F.struct(-F.col("win_prob"), F.col("pick"), F.col("uci")))).alias("_o"))
    return g.select("pos_id", "worst_uci", "first_uci", F.col("_o")[1]["uci"].alias("second_uci"))


@register("assessment_band", with_fx(
    f"WITH {ANALYSED}, pk AS (SELECT pos_id, concat_ws(' ', split_part(fen, ' ', 1), split_part(fen, ' ', 2), "
    "split_part(fen, ' ', 3), split_part(fen, ' ', 4)) AS key, CAST(length(regexp_replace(split_part(fen, ' ', 1), "
    "'[^a-zA-Z]', '', 'g')) AS INT) AS n_pieces FROM fx_positions), tb AS (SELECT DISTINCT key, "
    "CAST(n_pieces % 3 AS INT) - 1 AS wdl FROM pk WHERE n_pieces <= 7 AND length(key) % 2 = 0), "
    "bw AS (SELECT pos_id, win_prob AS bwp FROM analysed WHERE rank = 1) "
    "SELECT pk.pos_id, CASE WHEN tb.wdl IS NOT NULL THEN 'tablebase_' || CASE WHEN tb.wdl > 0 THEN 'winning' "
    "WHEN tb.wdl < 0 THEN 'losing' ELSE 'drawing' END WHEN bw.bwp IS NULL THEN 'no_eval' "
    "WHEN abs(bw.bwp - 0.5::DOUBLE) <= 0.04::DOUBLE THEN 'balanced' WHEN bw.bwp >= 0.60::DOUBLE THEN 'better' "
    "WHEN bw.bwp <= 0.40::DOUBLE THEN 'worse' ELSE 'slight' END AS assessment FROM pk "
    "LEFT JOIN tb ON tb.key = pk.key AND pk.n_pieces <= 7 LEFT JOIN bw ON bw.pos_id = pk.pos_id",
    "fx_positions", "fx_candidates"))
def q_assessment_band(spark, sf):
    from rookery.plans.q_board import q_endgame_table_lookup
    tb = q_endgame_table_lookup(spark, sf).select("pos_id", "tb_result")
    bw = analysed(spark, sf).filter("rank = 1").select("pos_id", F.col("win_prob").alias("bwp"))
    j = tb.join(bw, "pos_id", "left")
    return j.select("pos_id", SEL.assessment_band(F.col("tb_result"), F.col("bwp")).alias("assessment"))


# ---- PV storage and lines -------------------------------------------------------------

PV_SQL = f"""{ANALYSED},
cpv AS (SELECT a.pos_id, a.uci, a.rank, string_agg(p.uci, ' ' ORDER BY p.ply) AS pv_all,
  list(p.uci ORDER BY p.ply) AS pv FROM analysed a JOIN fx_pv p ON p.pos_id = a.pos_id AND p.ply >= a.slot
  GROUP BY a.pos_id, a.uci, a.rank)"""


@register("pv_truncate", with_fx(
    f"WITH {PV_SQL} SELECT pos_id, uci, CASE WHEN rank <= 12 THEN array_to_string(pv[1:8], ' ') ELSE '' END AS pv, "
    "CAST(CASE WHEN rank <= 12 THEN len(pv[1:8]) ELSE 0 END AS INT) AS pv_len FROM cpv", "fx_candidates", "fx_pv"))
def q_pv_truncate(spark, sf):
    """Store the PV only for the first K candidates, capped at the longest
    configured length (both fixed before any shuffle of the arrays)."""
    a = analysed(spark, sf).select("pos_id", "uci", "rank", "slot")
    pv = fx_pv(spark, sf).select("pos_id", F.col("ply"), F.col("uci").alias("m"))
    j = a.join(pv, "pos_id").filter(F.col("ply") >= F.col("slot"))
    g = j.groupBy("pos_id", "uci", "rank").agg(F.array_sort(F.collect_list(F.struct("ply", "m"))).alias("_s"))
    full = F.transform("_s", lambda x: x["m"])
    cut = F.when(F.col("rank") <= 12, F.slice(full, 1, 8)).otherwise(F.array().cast("array<string>"))
    return g.select("pos_id", "uci", F.array_join(cut, " ").alias("pv"), F.size(cut).alias("pv_len"))


def _streak_sql(src: str) -> str:
    return (f"SELECT *, ply - coalesce(max(CASE WHEN forcing THEN ply END) OVER (PARTITION BY pos_id ORDER BY ply "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), min(ply) OVER (PARTITION BY pos_id) - 1) AS streak, "
            "max(CASE WHEN forcing THEN ply END) OVER (PARTITION BY pos_id ORDER BY ply ROWS BETWEEN UNBOUNDED "
            "PRECEDING AND CURRENT ROW) IS NOT NULL AS seen, CAST(row_number() OVER (PARTITION BY pos_id ORDER BY ply) "
            f"AS INT) AS n FROM {src}")


def _prune_sql(src: str) -> str:
    return (f"SELECT * FROM (SELECT *, min(CASE WHEN streak >= 2 AND n >= 2 THEN n END) OVER (PARTITION BY pos_id) "
            f"AS stop FROM ({_streak_sql(src)})) WHERE stop IS NULL OR n <= stop")


@register("pv_prune_quiet", with_fx(
    f"SELECT pos_id, string_agg(uci, ' ' ORDER BY n) AS line, count(*) AS n_plies, bool_or(stop IS NOT NULL) AS pruned "
    f"FROM ({_prune_sql('fx_pv')}) GROUP BY pos_id", "fx_pv"))
def q_pv_prune_quiet(spark, sf):
    p = LN.pv_prune_quiet(fx_pv(spark, sf))
    ls = LN.line_string(p)
    flag = p.groupBy("pos_id").agg(F.max(F.col("pruned").cast("int")).cast("boolean").alias("pruned"))
    return ls.join(flag, "pos_id")


@register("pv_key_moments", with_fx(
    f"SELECT pos_id, count(*) AS plies, CAST(count_if(forcing) AS BIGINT) AS forcing_count, "
    "CAST(min(CASE WHEN forcing THEN n - 1 END) AS INT) AS first_forcing_idx, "
    "CAST(min(CASE WHEN NOT forcing AND seen AND streak >= 2 THEN n - 1 END) AS INT) AS settle_idx "
    f"FROM ({_streak_sql('fx_pv')}) GROUP BY pos_id", "fx_pv"))
def q_pv_key_moments(spark, sf):
    return LN.pv_key_moments(fx_pv(spark, sf))


@register("perpetual_indicator", with_fx(
    "SELECT pos_id, CAST(count_if(forcing AND n % 2 = 1) AS BIGINT) AS attacker_checks, "
    "count_if(forcing AND n % 2 = 1) >= 2 AS repeated_check FROM (SELECT *, row_number() OVER (PARTITION BY pos_id "
    "ORDER BY ply) AS n FROM fx_pv) WHERE n <= 6 GROUP BY pos_id", "fx_pv"))
def q_perpetual_indicator(spark, sf):
    return LN.perpetual_indicator(fx_pv(spark, sf))


@register("refutation_line", with_fx(
    "SELECT pos_id, string_agg(uci, ' ' ORDER BY n) AS refutation, count(*) AS n_plies FROM ("
    + _prune_sql("(SELECT pos_id, ply, uci, forcing FROM (SELECT *, row_number() OVER (PARTITION BY pos_id ORDER BY "
                 "ply) AS n0 FROM fx_pv) WHERE n0 >= 2 AND n0 <= 5)") + ") GROUP BY pos_id", "fx_pv"))
def q_refutation_line(spark, sf):
    return LN.refutation_line(fx_pv(spark, sf))


# ---- depth merge, config overrides ------------------------------------------------------

@register("depth_merge", with_fx(
    f"WITH {ANALYSED}, m AS (SELECT pos_id, uci, cp, rank FROM analysed), "
    "sh AS (SELECT pos_id, uci, shallow_cp FROM analysed), "
    "cf AS (SELECT pos_id, uci, confirm_cp FROM analysed) "
    "SELECT m.pos_id, m.uci, m.cp, sh.shallow_cp, cf.confirm_cp, "
    f"round({win_prob_sql('sh.shallow_cp')}, 6) AS shallow_wp, round({win_prob_sql('cf.confirm_cp')}, 6) AS confirm_wp "
    "FROM m LEFT JOIN sh ON sh.pos_id = m.pos_id AND sh.uci = m.uci LEFT JOIN cf ON cf.pos_id = m.pos_id "
    "AND cf.uci = m.uci", *C))
def q_depth_merge(spark, sf):
    """Main scores of every move with those of the shallow and the confirming probe,
    three tables of their own."""
    return depth_merge(*score_tables(spark, sf)).select(
        "pos_id", "uci", "cp", "shallow_cp", "confirm_cp",
        F.round(win_probability("shallow_cp"), 6).alias("shallow_wp"),
        F.round(win_probability("confirm_cp"), 6).alias("confirm_wp"))


def score_tables(spark, sf):
    """The three score tables, each written by itself in the same buckets."""
    a = cut_lineage(analysed(spark, sf))
    return tuple(write_bucketed(df, name, ["pos_id", "uci"]) for name, df in (
        ("scores_main", a.select("pos_id", "uci", "cp", "rank")),
        ("scores_shallow", a.select("pos_id", "uci", "shallow_cp")),
        ("scores_confirm", a.select("pos_id", "uci", "confirm_cp"))))


def depth_merge(main, shallow, confirm):
    """``main`` with the probes' scores, null where a probe has none. Tables in the
    same buckets of ``(pos_id, uci)`` are joined bucket by bucket, without a shuffle."""
    on = ["pos_id", "uci"]
    return main.join(shallow.hint("merge"), on, "left").join(confirm.hint("merge"), on, "left")


# --- fixed values -----------------------------------------------------------
BASE_CONFIG = {"sample_rate": 0.3, "max_candidates": 8.0, "pv_prob": 0.55, "context_hint_mult": 1.0,
               "decision_profile_mult": 1.0}
SOURCE_OVERRIDES = {"puzzle": {"context_hint_mult": 1.5, "decision_profile_mult": 1.2},
                    "game": {"context_hint_mult": 0.7, "decision_profile_mult": 0.8}}
# --- end of fixed values -----------------------------------------------------


def config_table(spark):
    rows = []
    for src in ("game", "puzzle"):
        for k, v in BASE_CONFIG.items():
            rows.append((src, k, float(v), SOURCE_OVERRIDES.get(src, {}).get(k)))
    return F.broadcast(spark.createDataFrame(rows, "source STRING, key STRING, base DOUBLE, override DOUBLE"))


@register("config_override", with_fx(
    "WITH cfg AS (SELECT * FROM (VALUES " + ", ".join(
        f"('{src}', '{k}', {float(v)}::DOUBLE, " + (f"{float(SOURCE_OVERRIDES[src][k])}::DOUBLE"
                                                     if k in SOURCE_OVERRIDES.get(src, {}) else "NULL::DOUBLE") + ")"
        for src in ("game", "puzzle") for k, v in BASE_CONFIG.items()) + ") t(source, key, base, override)), "
    "pos AS (SELECT 'game' AS source, game_id AS id FROM fx_games UNION ALL SELECT 'puzzle', puzzle_id FROM fx_puzzles), "
    "eff AS (SELECT source, " + ", ".join(f"max(CASE WHEN key = '{k}' THEN coalesce(override, base) END) AS {k}"
                                           for k in BASE_CONFIG) + " FROM cfg GROUP BY source) "
    "SELECT pos.source, pos.id, " + ", ".join(f"eff.{k}" for k in BASE_CONFIG) + " FROM pos JOIN eff "
    "ON eff.source = pos.source", "fx_games", "fx_puzzles"))
def q_config_override(spark, sf):
    """Per-source config merge (override else base) as a tiny pivoted table,
    broadcast-joined onto every position by source."""
    cfg = config_table(spark)
    eff = cfg.groupBy("source").pivot("key", list(BASE_CONFIG)).agg(F.first(F.coalesce("override", "base")))
    pos = fx_games(spark, sf).select(F.lit("game").alias("source"), F.col("game_id").alias("id")).unionByName(
        fx_puzzles(spark, sf).select(F.lit("puzzle").alias("source"), F.col("puzzle_id").alias("id")))
    return pos.join(F.broadcast(eff), "source").select("source", "id", *BASE_CONFIG)
