"""Keyed draws, quotas, interleave and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.functions.draws import TWO_POW_52, hash_uniform
from rookery.functions.text import SAN_MOVE
from rookery.operators import filters as flt
from rookery.operators import sampling as smp
from rookery.operators.sequences import ExplodeParams, explode_plies, explode_puzzle_turns
from rookery.plans import sqlfrag as S
from rookery.plans.q_sources import ELIGIBLE_SQL, PUZZLE_TURNS_SQL, eligible_games
from rookery.plans.registry import register
from rookery.sources.fixtures import plan_memo
from rookery.sources.fixtures import fx_positions, fx_puzzle_records, with_fx

G, P = "fx_game_records", "fx_puzzle_records"
QP = smp.QuotaParams()
GAMES_TARGET = int(QP.target_size * QP.games_ratio)


@plan_memo
def source_positions(spark, sf):
    """Sampled game positions and puzzle solver turns, one keyed draw each."""
    g = explode_plies(eligible_games(spark, sf), ExplodeParams(), sample=True)
    g = g.select(F.lit("game").alias("source"), F.col("game_id").alias("id"), F.col("ply").alias("idx"))
    p = fx_puzzle_records(spark, sf).filter(flt.puzzle_rating_ok())
    p = explode_puzzle_turns(p).select(F.lit("puzzle").alias("source"), F.col("puzzle_id").alias("id"),
                                       F.col("move_index").alias("idx"))
    sp = g.unionByName(p)
    return sp.withColumn("u", hash_uniform(42, F.col("source"), F.col("id"), F.col("idx")))


SOURCE_POSITIONS_SQL = f"""{ELIGIBLE_SQL},
sg0 AS (SELECT game_id, sans, {S.first_invalid_index('sans', SAN_MOVE)} AS stop FROM eligible),
sg1 AS (SELECT game_id, sans, stop, CAST(unnest(range(len(sans))) AS INT) AS ply FROM sg0),
gpos AS (SELECT 'game' AS source, game_id AS id, ply AS idx FROM sg1
  WHERE ply >= 4 AND ply < len(sans) - 2 AND (stop IS NULL OR ply <= stop)
    AND {S.uniform(42, 'game_id', 'ply')} <= 0.3::DOUBLE),
{PUZZLE_TURNS_SQL},
ppos AS (SELECT 'puzzle' AS source, puzzle_id AS id, move_index AS idx FROM turns
  WHERE {S.rating_or_default('rating')} BETWEEN 1000 AND 2500),
sp AS (SELECT source, id, idx, {S.uniform(42, 'source', 'id', 'idx')} AS u
  FROM (SELECT * FROM gpos UNION ALL SELECT * FROM ppos))"""

TARGETS_SQL = (f"tg AS (SELECT * FROM (VALUES ('game', {GAMES_TARGET}), "
               f"('puzzle', {QP.target_size - GAMES_TARGET})) t(source, target))")


@register("hash_uniform", with_fx(
    f"SELECT game_id, {S.uniform(42, 'game_id')} AS u, "
    "CAST(('0x' || substr(sha256('42|' || CAST(game_id AS VARCHAR)), 1, 13))::BIGINT AS BIGINT) AS bits "
    "FROM fx_games", "fx_games"))
def q_hash_uniform(spark, sf):
    from rookery.sources.fixtures import fx_games
    g = fx_games(spark, sf)
    u = hash_uniform(42, F.col("game_id"))
    return g.select("game_id", u.alias("u"), (u * F.lit(TWO_POW_52)).cast("bigint").alias("bits"))


@register("source_quota", with_fx(
    f"WITH {SOURCE_POSITIONS_SQL}, {TARGETS_SQL}, "
    "qq AS (SELECT sp.source, id, idx, target, row_number() OVER (PARTITION BY sp.source ORDER BY u, id, idx) AS rk "
    "FROM sp JOIN tg ON tg.source = sp.source) "
    "SELECT source, id, idx, CAST(rk AS BIGINT) AS rank FROM qq WHERE rk <= target", G, P))
def q_source_quota(spark, sf):
    sp = source_positions(spark, sf)
    q = smp.source_quota(sp, smp.quota_targets(spark, QP), "u", ["id", "idx"])
    return q.select("source", "id", "idx", "rank")


@register("quota_shortfall", with_fx(
    f"WITH {SOURCE_POSITIONS_SQL}, {TARGETS_SQL}, "
    "av AS (SELECT source, count(*) AS available FROM sp GROUP BY source) "
    "SELECT tg.source, CAST(tg.target AS BIGINT) AS target, coalesce(av.available, 0) AS available, "
    "CAST(greatest(tg.target - coalesce(av.available, 0), 0) AS BIGINT) AS shortfall, "
    "coalesce(av.available, 0) < tg.target AS exhausted FROM tg LEFT JOIN av ON av.source = tg.source", G, P))
def q_quota_shortfall(spark, sf):
    return smp.quota_shortfall(source_positions(spark, sf), smp.quota_targets(spark, QP))


N_SLOTS = 2000


@register("ratio_interleave", with_fx(
    f"WITH {SOURCE_POSITIONS_SQL}, "
    f"slots AS (SELECT range AS slot, CASE WHEN {S.uniform(42, chr(39) + 'slot' + chr(39), 'range')} < 0.3::DOUBLE "
    f"THEN 'puzzle' ELSE 'game' END AS source FROM range({N_SLOTS})), "
    "sk AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY slot) AS k FROM slots), "
    "pr AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY u, id, idx) AS r, "
    "count(*) OVER (PARTITION BY source) AS ns FROM sp) "
    "SELECT sk.slot, sk.source, pr.id, pr.idx FROM sk JOIN pr ON pr.source = sk.source "
    "AND pr.r = ((sk.k - 1) % pr.ns) + 1", G, P))
def q_ratio_interleave(spark, sf):
    sp = source_positions(spark, sf)
    return smp.ratio_interleave(spark, sp, N_SLOTS).select("slot", "source", "id", "idx")


HOLDOUT_SQL = f"""s AS (SELECT pos_id, {S.uniform(42, 'pos_id')} AS u FROM fx_positions),
hs AS (SELECT pos_id, CASE WHEN r <= 500 THEN 'eval' ELSE 'train' END AS split,
  CASE WHEN r <= 500 THEN 0 ELSE 1 END AS segment, CAST(u * 4503599627370496 AS BIGINT) AS ord
  FROM (SELECT pos_id, u, row_number() OVER (ORDER BY u, pos_id) AS r FROM s))"""


@register("holdout_split", with_fx(f"WITH {HOLDOUT_SQL} SELECT pos_id, split, segment, ord FROM hs",
                                   "fx_positions"))
def q_holdout_split(spark, sf):
    p = fx_positions(spark, sf).select("pos_id")
    return smp.holdout_split(p, "pos_id").select("pos_id", "split", "segment", "ord")


@register("train_stream_order", with_fx(
    f"WITH {HOLDOUT_SQL} SELECT pos_id, CAST(row_number() OVER (ORDER BY ord, pos_id) AS BIGINT) AS stream_pos "
    "FROM hs WHERE split = 'train'", "fx_positions"))
def q_train_stream_order(spark, sf):
    """Dense stream positions; the global order is a range-partitioned sort
    on (ord, pos_id), and the dense index comes from per-bucket counts."""
    p = fx_positions(spark, sf).select("pos_id")
    h = smp.holdout_split(p, "pos_id").filter(F.col("split") == "train")
    return smp.dense_order(h, ["ord", "pos_id"]).select("pos_id", "stream_pos")


@register("fraction_split", with_fx(
    f"SELECT pos_id, CASE WHEN rk <= ceil(0.05::DOUBLE * n) THEN 'test' ELSE 'train' END AS split FROM "
    f"(SELECT pos_id, row_number() OVER (ORDER BY u, pos_id) AS rk, count(*) OVER () AS n FROM "
    f"(SELECT pos_id, {S.uniform(42, 'pos_id')} AS u FROM fx_positions))", "fx_positions"))
def q_fraction_split(spark, sf):
    p = fx_positions(spark, sf).select("pos_id")
    return smp.fraction_split(p, "pos_id").select("pos_id", "split")


@register("sample_n", with_fx(
    f"SELECT pos_id, CAST(pick AS BIGINT) AS pick FROM (SELECT pos_id, row_number() OVER (ORDER BY u, pos_id) AS pick "
    f"FROM (SELECT pos_id, {S.uniform(42, 'pos_id')} AS u FROM fx_positions)) WHERE pick <= 1000", "fx_positions"))
def q_sample_n(spark, sf):
    p = fx_positions(spark, sf).select("pos_id")
    return smp.sample_n(p, "pos_id", 1000).select("pos_id", "pick")


@register("head_n", with_fx("SELECT pos_id, fen FROM fx_positions ORDER BY pos_id LIMIT 100", "fx_positions"))
def q_head_n(spark, sf):
    return smp.head_n(fx_positions(spark, sf).select("pos_id", "fen"), "pos_id", 100)
