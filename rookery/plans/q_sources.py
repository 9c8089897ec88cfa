"""Source scans, predicates and sequence explode."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.functions.casts import safe_int
from rookery.functions.text import (SAN_MOVE, UCI_MOVE, first_invalid_index, parse_movetext,
                                    parse_movetext_rl, tokens, valid_prefix)
from rookery.operators import filters as flt
from rookery.operators.sampling import band_asof_join, band_table, ELO_WEIGHTS, ELO_WEIGHT_FLOOR
from rookery.operators.sequences import (ExplodeParams, explode_plies, explode_puzzle_turns,
                                         movetext_fallback)
from rookery.plans import sqlfrag as S
from rookery.plans.registry import register
from rookery.sources.fixtures import plan_memo
from rookery.sources.fixtures import (fx_candidates, fx_game_records, fx_puzzle_records,
                                      fx_valid_list, with_fx)
from rookery.sources.records import scan_games, scan_puzzles
from rookery.functions.draws import hash_uniform

G = "fx_game_records"
P = "fx_puzzle_records"


@register("scan_games", with_fx(
    f"SELECT game_id, termination, result, white_elo, black_elo, movetext, moves FROM {G}", G))
def q_scan_games(spark, sf):
    return scan_games(fx_game_records(spark, sf))


THEMES_SQL = S.tokens("coalesce(themes, '')")
TAGS_SQL = "CASE WHEN opening_tags IS NULL OR opening_tags = '' THEN []::VARCHAR[] ELSE [opening_tags] END"


@register("scan_puzzles", with_fx(
    f"SELECT puzzle_id, rating, array_to_string({THEMES_SQL}, ',') AS themes, "
    f"CAST(len({THEMES_SQL}) AS INT) AS n_themes, array_to_string({TAGS_SQL}, ',') AS opening_tags, "
    f"CAST(len({TAGS_SQL}) AS INT) AS n_tags, fen, moves FROM {P}", P))
def q_scan_puzzles(spark, sf):
    p = scan_puzzles(fx_puzzle_records(spark, sf))
    return p.select("puzzle_id", "rating", F.array_join("themes", ",").alias("themes"),
                    F.size("themes").alias("n_themes"), F.array_join("opening_tags", ",").alias("opening_tags"),
                    F.size("opening_tags").alias("n_tags"), "fen", "moves")


FALLBACK_SQL = "coalesce(nullif(movetext, ''), nullif(moves, ''))"


@register("movetext_fallback", with_fx(f"SELECT game_id, {FALLBACK_SQL} AS movetext FROM {G}", G))
def q_movetext_fallback(spark, sf):
    return movetext_fallback(fx_game_records(spark, sf)).select("game_id", "movetext")


@register("safe_cast", with_fx(
    f"SELECT game_id, {S.safe_int('white_elo', 1500)} AS white_elo_int, "
    f"{S.safe_int('black_elo', 1500)} AS black_elo_int, {S.safe_int('white_elo', None)} AS white_elo_raw "
    f"FROM {G}", G))
def q_safe_cast(spark, sf):
    g = fx_game_records(spark, sf)
    return g.select("game_id", safe_int("white_elo", 1500).alias("white_elo_int"),
                    safe_int("black_elo", 1500).alias("black_elo_int"),
                    safe_int("white_elo", None).alias("white_elo_raw"))


# ---- predicates -------------------------------------------------------------

@register("filter_termination", with_fx(
    f"SELECT game_id, termination FROM {G} WHERE termination IS DISTINCT FROM 'Time forfeit'", G))
def q_filter_termination(spark, sf):
    return fx_game_records(spark, sf).filter(flt.not_time_forfeit()).select("game_id", "termination")


@register("filter_result", with_fx(
    f"SELECT game_id, result FROM {G} WHERE result IN ('1-0', '0-1', '1/2-1/2')", G))
def q_filter_result(spark, sf):
    return fx_game_records(spark, sf).filter(flt.decisive_result()).select("game_id", "result")


AVG_ELO_SQL = (f"(({S.rating_or_default('white_elo')} + {S.rating_or_default('black_elo')}) "
               "/ 2.0::DOUBLE)")


@register("filter_avg_elo", with_fx(
    f"SELECT game_id, avg_elo FROM (SELECT game_id, {AVG_ELO_SQL} AS avg_elo FROM {G}) "
    "WHERE avg_elo >= 1200", G))
def q_filter_avg_elo(spark, sf):
    g = fx_game_records(spark, sf).select("game_id", flt.avg_elo().alias("avg_elo"))
    return g.filter(F.col("avg_elo") >= 1200)


@register("filter_puzzle_rating", with_fx(
    f"SELECT puzzle_id, rating FROM {P} WHERE {S.rating_or_default('rating')} BETWEEN 1000 AND 2500", P))
def q_filter_puzzle_rating(spark, sf):
    return fx_puzzle_records(spark, sf).filter(flt.puzzle_rating_ok()).select("puzzle_id", "rating")


GAME_SANS = S.parse_movetext(FALLBACK_SQL)
PUZZLE_LINE = S.tokens("coalesce(moves, '')")


@register("filter_seq_len", with_fx(
    f"SELECT 'game' AS source, game_id AS id, CAST(len({GAME_SANS}) AS INT) AS n_moves FROM {G} "
    f"WHERE len({GAME_SANS}) >= 7 UNION ALL "
    f"SELECT 'puzzle', puzzle_id, CAST(len({PUZZLE_LINE}) AS INT) FROM {P} WHERE len({PUZZLE_LINE}) >= 2",
    G, P))
def q_filter_seq_len(spark, sf):
    g = movetext_fallback(fx_game_records(spark, sf)).select(
        F.lit("game").alias("source"), F.col("game_id").alias("id"),
        F.size(parse_movetext("movetext")).alias("n_moves")).filter("n_moves >= 7")
    p = fx_puzzle_records(spark, sf).select(
        F.lit("puzzle").alias("source"), F.col("puzzle_id").alias("id"),
        F.size(tokens(F.coalesce(F.col("moves"), F.lit("")))).alias("n_moves")).filter("n_moves >= 2")
    return g.unionByName(p)


def elo_weight_sql(x: str) -> str:
    parts = " ".join(f"WHEN {x} >= {t} THEN {w}::DOUBLE" for t, w in sorted(ELO_WEIGHTS, reverse=True))
    return f"(CASE {parts} ELSE {ELO_WEIGHT_FLOOR}::DOUBLE END)"


ELIGIBLE_SQL = f"""eg0 AS (
 SELECT game_id, line_id, fen_id, {AVG_ELO_SQL} AS avg_elo, {FALLBACK_SQL} AS movetext FROM {G}
 WHERE termination IS DISTINCT FROM 'Time forfeit' AND result IN ('1-0', '0-1', '1/2-1/2')),
eg1 AS (SELECT *, {elo_weight_sql('avg_elo')} AS weight, {S.uniform(42, 'game_id')} AS u FROM eg0
 WHERE avg_elo >= 1200),
eligible AS (SELECT game_id, line_id, fen_id, avg_elo, weight, movetext, {S.parse_movetext('movetext')} AS sans
 FROM eg1 WHERE u <= weight AND movetext IS NOT NULL AND len({S.parse_movetext('movetext')}) >= 7)"""


@plan_memo
def eligible_games(spark, sf):
    """Cheap predicates first; one conjunction per stage for Catalyst."""
    g = movetext_fallback(fx_game_records(spark, sf))
    g = g.filter(flt.not_time_forfeit() & flt.decisive_result())
    g = g.withColumn("avg_elo", flt.avg_elo()).filter(F.col("avg_elo") >= 1200)
    g = band_asof_join(g, "avg_elo", band_table(spark), ELO_WEIGHT_FLOOR)
    g = g.filter(hash_uniform(42, F.col("game_id")) <= F.col("weight"))
    g = g.filter(F.col("movetext").isNotNull())
    g = g.withColumn("sans", parse_movetext("movetext")).filter(F.size("sans") >= 7)
    return g


@register("eligible_games", with_fx(
    f"WITH {ELIGIBLE_SQL} SELECT game_id, avg_elo, weight, CAST(len(sans) AS INT) AS n_moves FROM eligible",
    G))
def q_eligible_games(spark, sf):
    return eligible_games(spark, sf).select("game_id", "avg_elo", "weight",
                                            F.size("sans").alias("n_moves"))


@register("elo_weighted_sample", with_fx(
    f"SELECT game_id, avg_elo, weight, round(u, 6) AS u FROM (SELECT game_id, {AVG_ELO_SQL} AS avg_elo FROM {G}) a,"
    f" LATERAL (SELECT {elo_weight_sql('a.avg_elo')} AS weight, {S.uniform(42, 'a.game_id')} AS u) b "
    "WHERE u <= weight", G))
def q_elo_weighted_sample(spark, sf):
    g = fx_game_records(spark, sf).select("game_id", flt.avg_elo().alias("avg_elo"))
    g = band_asof_join(g, "avg_elo", band_table(spark), ELO_WEIGHT_FLOOR)
    g = g.withColumn("u", hash_uniform(42, F.col("game_id"))).filter(F.col("u") <= F.col("weight"))
    return g.select("game_id", "avg_elo", "weight", F.round("u", 6).alias("u"))


@register("band_asof_join", with_fx(
    f"SELECT game_id, avg_elo, {elo_weight_sql('avg_elo')} AS weight FROM "
    f"(SELECT game_id, {AVG_ELO_SQL} AS avg_elo FROM {G})", G))
def q_band_asof_join(spark, sf):
    g = fx_game_records(spark, sf).select("game_id", flt.avg_elo().alias("avg_elo"))
    return band_asof_join(g, "avg_elo", band_table(spark), ELO_WEIGHT_FLOOR)


@register("filter_valid_fen", with_fx(
    f"SELECT puzzle_id, fen, moves FROM {P} WHERE fen IS NOT NULL AND fen <> '' AND "
    f"regexp_matches(fen, {S.q(flt.FEN_PATTERN)}) AND moves IS NOT NULL AND trim(moves) <> ''", P))
def q_filter_valid_fen(spark, sf):
    return flt.filter_valid_records(fx_puzzle_records(spark, sf)).select("puzzle_id", "fen", "moves")


@register("resolve_chosen_move", with_fx(
    """WITH best AS (SELECT pos_id, max(CASE WHEN rk = 1 THEN uci END) AS best_uci
       FROM (SELECT pos_id, uci, row_number() OVER (PARTITION BY pos_id ORDER BY cp DESC, slot) AS rk
             FROM fx_candidates) GROUP BY pos_id),
    j AS (SELECT v.pos_id, v.valid_moves, b.best_uci,
      CASE WHEN coalesce(nullif(b.best_uci, ''), '') <> '' AND list_contains(v.valid_moves, b.best_uci)
           THEN b.best_uci ELSE '' END AS pick
      FROM fx_valid_list v LEFT JOIN best b ON b.pos_id = v.pos_id)
    SELECT pos_id, best_uci, CASE WHEN pick = '' THEN coalesce(valid_moves[1], '') ELSE pick END AS chosen_move
    FROM j""", "fx_valid_list", "fx_candidates"))
def q_resolve_chosen_move(spark, sf):
    from rookery.operators.scoring import rank_candidates
    best = rank_candidates(fx_candidates(spark, sf)).filter("rank = 1").select(
        "pos_id", F.col("uci").alias("best_uci"))
    j = fx_valid_list(spark, sf).join(best, "pos_id", "left")
    return j.select("pos_id", "best_uci",
                    flt.resolve_chosen_move("best_uci", F.lit(None).cast("string"), "valid_moves")
                    .alias("chosen_move"))


# ---- sequences ---------------------------------------------------------------

@register("parse_movetext", with_fx(
    f"SELECT game_id, array_to_string({GAME_SANS}, ' ') AS sans, CAST(len({GAME_SANS}) AS INT) AS n_moves "
    f"FROM {G}", G))
def q_parse_movetext(spark, sf):
    g = movetext_fallback(fx_game_records(spark, sf)).withColumn("sans", parse_movetext("movetext"))
    return g.select("game_id", F.array_join("sans", " ").alias("sans"), F.size("sans").alias("n_moves"))


@register("parse_movetext_rl", with_fx(
    f"SELECT game_id, array_to_string({S.parse_movetext_rl(FALLBACK_SQL)}, ' ') AS sans FROM {G}", G))
def q_parse_movetext_rl(spark, sf):
    g = movetext_fallback(fx_game_records(spark, sf))
    return g.select("game_id", F.array_join(parse_movetext_rl("movetext"), " ").alias("sans"))


EXPLODE_SQL = f"""ex0 AS (SELECT game_id, sans, {S.first_invalid_index('sans', SAN_MOVE)} AS stop
  FROM (SELECT game_id, {GAME_SANS} AS sans FROM {G}) WHERE len(sans) >= 7),
ex1 AS (SELECT game_id, sans, stop, unnest(sans) AS san, CAST(unnest(range(len(sans))) AS INT) AS ply FROM ex0),
plies AS (SELECT game_id, ply, san FROM ex1
  WHERE ply >= 4 AND ply < len(sans) - 2 AND (stop IS NULL OR ply <= stop))"""


@register("explode_plies", with_fx(f"WITH {EXPLODE_SQL} SELECT game_id, ply, san FROM plies", G))
def q_explode_plies(spark, sf):
    g = movetext_fallback(fx_game_records(spark, sf))
    return explode_plies(g, ExplodeParams()).select("game_id", "ply", "san")


@register("bernoulli_positions", with_fx(
    f"WITH {EXPLODE_SQL} SELECT game_id, ply, san FROM plies WHERE {S.uniform(42, 'game_id', 'ply')} <= 0.3::DOUBLE",
    G))
def q_bernoulli_positions(spark, sf):
    g = movetext_fallback(fx_game_records(spark, sf))
    return explode_plies(g, ExplodeParams(), sample=True).select("game_id", "ply", "san")


PUZZLE_TURNS_SQL = f"""pt0 AS (SELECT puzzle_id, rating, fen, line, {S.first_invalid_index('line', UCI_MOVE)} AS stop
  FROM (SELECT puzzle_id, rating, fen, {PUZZLE_LINE} AS line FROM {P})
  WHERE fen IS NOT NULL AND fen <> '' AND len(line) >= 2),
pt1 AS (SELECT *, unnest(line) AS uci, CAST(unnest(range(len(line))) AS INT) AS move_index FROM pt0),
turns AS (SELECT puzzle_id, rating, fen, move_index, CAST(len(line) AS INT) AS line_length, uci FROM pt1
  WHERE move_index % 2 = 1 AND (stop IS NULL OR move_index < stop))"""


@register("explode_puzzle_turns", with_fx(
    f"WITH {PUZZLE_TURNS_SQL} SELECT puzzle_id, move_index, line_length, uci FROM turns", P))
def q_explode_puzzle_turns(spark, sf):
    t = explode_puzzle_turns(fx_puzzle_records(spark, sf))
    return t.select("puzzle_id", "move_index", F.size("line").alias("line_length"), "uci")


@register("valid_prefix", with_fx(
    f"SELECT puzzle_id, CAST({S.first_invalid_index(PUZZLE_LINE, UCI_MOVE)} AS INT) AS stop, "
    f"array_to_string(CASE WHEN {S.first_invalid_index(PUZZLE_LINE, UCI_MOVE)} IS NULL THEN {PUZZLE_LINE} "
    f"ELSE {PUZZLE_LINE}[1:{S.first_invalid_index(PUZZLE_LINE, UCI_MOVE)}] END, ' ') AS prefix FROM {P}", P))
def q_valid_prefix(spark, sf):
    p = fx_puzzle_records(spark, sf).withColumn("line", tokens(F.coalesce(F.col("moves"), F.lit(""))))
    return p.select("puzzle_id", first_invalid_index("line", UCI_MOVE).alias("stop"),
                    F.array_join(valid_prefix("line", UCI_MOVE), " ").alias("prefix"))
