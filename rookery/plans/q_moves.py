"""Move-level motifs from before/after boards.

Moves come from the games' coordinate lines (real, legal moves): every
distinct line is replayed once with the board fold, giving the board before
each move, after it and after the reply. Pieces and attack edges are built
inside each distinct board's row, and the rules join back to every game that
plays the line. The oracle states the rules separately, over edge tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.functions.board import DUCK, replay_states, replay_states_sql
from rookery.functions.text import UCI_MOVE, tokens, valid_prefix
from rookery.operators import board as BD
from rookery.operators import board_features as BF
from rookery.operators.move_features import move_features
from rookery.plans import sqlfrag as S
from rookery.plans.registry import register
from rookery.sources.fixtures import START_FEN, with_fx


def spark_moves(spark, sf):
    from rookery.plans.q_board import game_lines
    g = game_lines(spark, sf)
    lines = g.select("line_uci").distinct()
    l = lines.withColumn("mvs", valid_prefix(tokens("line_uci"), UCI_MOVE)).withColumn("start", F.lit(START_FEN))
    l = l.withColumn("sts", replay_states("start", "mvs"))
    e = l.select("line_uci", "mvs", "sts", F.posexplode("mvs").alias("ply", "muci"))
    mv = e.select(
        "line_uci", F.col("ply").cast("int").alias("ply"), "muci",
        F.element_at("sts", F.col("ply") + 1).alias("bfen"),
        F.element_at("sts", F.col("ply") + 2).alias("afen"),
        F.try_element_at("mvs", F.col("ply") + 2).alias("ruci"),
        F.try_element_at("sts", F.col("ply") + 3).alias("rfen"))
    fens = (mv.select(F.col("bfen").alias("fen")).unionByName(mv.select(F.col("afen").alias("fen")))
            .unionByName(mv.select(F.col("rfen").alias("fen")).filter(F.col("fen").isNotNull())).distinct())
    return g, mv, fens


def _fidx(u: str, a: int, b: int) -> str:
    return f"((8 - CAST(substr({u}, {b}, 1) AS INT)) * 8 + ascii(substr({u}, {a}, 1)) - 96)"


VAL = ("CASE {t} WHEN 'p' THEN 1 WHEN 'n' THEN 3 WHEN 'b' THEN 3 WHEN 'r' THEN 5 WHEN 'q' THEN 9 ELSE 0 END")

KEY_VALUES = ", ".join(f"({n}, '{q}', {BF._idx(q)})" for n, q in enumerate(BF.WEAK_SQUARES))

# Motifs of a move, over the edge and piece tables of the boards before and after it.
_OUT = "CASE WHEN {c} = 'w' THEN {w} ELSE {b} END"
_RANKED = [  # as the reference's order of motifs; a row a motif that applies
    ("underpromotion", "underpromotion"), ("en_passant", "en_passant"), ("double_check", "ea_double"), ("fork", "n_fork >= 2"), ("pin", "ea_pins > 0"),
    ("skewer", "own_skewers > 0"), ("discovered_attack", "discovered_attack"), ("clearance", "clearance AND NOT discovered_attack"),
    ("deflection", "deflection IS NOT NULL"), ("interference", "interference IS NOT NULL"), ("xray", "own_xrays > 0"), ("desperado", "desperado"),
    ("sacrifice", "sacrifice"), ("decoy", "decoy"), ("overload", "foe_overloaded > 0"), ("back_rank", "foe_back_rank"), ("zwischenzug", "zwischenzug"),
    ("weak_square", "weak_move"), ("quiet", "quiet"), ("battery", "battery IS NOT NULL"), ("outpost", "outpost"), ("tempo", "tempo IS NOT NULL"),
    ("prophylactic", "prophylactic IS NOT NULL")]
MOTIF_SQL = f"""psm AS (SELECT e.fen, e.from_idx, e.from_color AS c, e.from_type AS t, e.to_idx AS x FROM edges e
    WHERE (e.to_color IS NULL AND e.from_type <> 'p') OR (e.to_color <> e.from_color AND e.to_type <> 'k')
  UNION ALL SELECT fen, idx, color, 'p', idx + s FROM (SELECT *, CASE color WHEN 'w' THEN -8 ELSE 8 END AS s FROM pcs WHERE type = 'p')
    WHERE idx + s BETWEEN 1 AND 64 AND substr(b, idx + s, 1) = '.'
  UNION ALL SELECT fen, idx, color, 'p', idx + 2 * s FROM (SELECT *, CASE color WHEN 'w' THEN -8 ELSE 8 END AS s FROM pcs WHERE type = 'p')
    WHERE rank = CASE color WHEN 'w' THEN 2 ELSE 7 END AND substr(b, idx + s, 1) = '.' AND substr(b, idx + 2 * s, 1) = '.'),
psm2 AS (SELECT *, t = 'p' AND (x <= 8 OR x >= 57) AS promo FROM psm),
kline AS (SELECT k.fen, k.color AS kc, r.kind, unnest(CASE WHEN list_contains(o, true) THEN r.cells[1:list_position(o, true)] ELSE r.cells END) AS x
  FROM pcs k JOIN (SELECT *, 1 AS one FROM rays) r ON r.from_idx = k.idx, LATERAL (SELECT list_transform(r.cells, lambda q: substr(k.b, q, 1) <> '.') AS o)
  WHERE k.type = 'k'),
kview AS (SELECT DISTINCT fen, kc, CASE kind WHEN 'orth' THEN 'r' ELSE 'b' END AS t, x FROM kline
  UNION SELECT DISTINCT fen, kc, 'q', x FROM kline
  UNION SELECT k.fen, k.color, 'n', l.to_idx FROM pcs k JOIN leaps l ON l.from_idx = k.idx AND l.kind = 'n' WHERE k.type = 'k'
  UNION SELECT k.fen, k.color, 'p', l.from_idx FROM pcs k JOIN leaps l ON l.to_idx = k.idx AND l.kind = CASE k.color WHEN 'w' THEN 'bp' ELSE 'wp' END WHERE k.type = 'k'),
chkm AS (SELECT m.fen, m.c FROM psm2 m JOIN kview v ON v.fen = m.fen AND v.kc <> m.c AND v.x = m.x AND (v.t = m.t OR (m.promo AND v.t IN ('q', 'n')))
  UNION SELECT e.fen, e.from_color FROM edges e JOIN pcs k ON k.fen = e.fen AND k.idx = e.second_idx AND k.type = 'k' AND k.color <> e.from_color
    JOIN rays r ON r.from_idx = e.from_idx AND r.dir = e.dir JOIN psm2 m ON m.fen = e.fen AND m.from_idx = e.to_idx
    WHERE e.to_color = e.from_color AND NOT list_contains(r.cells, m.x) AND (m.t <> 'p' OR abs(m.x - m.from_idx) <> 16)),
thr AS (SELECT p.fen, c.c, count(*) FILTER (p.color <> c.c AND (CASE c.c WHEN 'w' THEN p.aw ELSE p.ab END) > 0 AND (CASE c.c WHEN 'w' THEN p.ab ELSE p.aw END) = 0)
    + CASE WHEN EXISTS (SELECT 1 FROM chkm h WHERE h.fen = p.fen AND h.c = c.c) THEN 1 ELSE 0 END AS threats
  FROM tgt p, (VALUES ('w'), ('b')) c(c) GROUP BY p.fen, c.c),
held AS (SELECT fen, to_idx, from_color AS c FROM edges GROUP BY ALL),
mi AS (SELECT x.line_uci, x.ply, max(t.csq * 10000 + d.csq * 100 + t.idx) AS best FROM m6 x
  JOIN edges e ON e.fen = x.bfen AND e.from_color <> x.mover AND e.dir IS NOT NULL AND e.to_color = e.from_color AND e.to_type <> 'k'
  JOIN rays r ON r.from_idx = e.from_idx AND r.dir = e.dir
  JOIN pcs t ON t.fen = x.bfen AND t.idx = e.to_idx JOIN pcs d ON d.fen = x.bfen AND d.idx = e.from_idx
  WHERE NOT x.capture AND NOT x.promotion AND list_contains(r.cells[1:e.step - 1], x.ti)
    AND EXISTS (SELECT 1 FROM held h WHERE h.fen = x.afen AND h.to_idx = e.to_idx AND h.c = x.mover)
    AND NOT EXISTS (SELECT 1 FROM held h WHERE h.fen = x.afen AND h.to_idx = e.to_idx AND h.c <> x.mover) GROUP BY x.line_uci, x.ply),
min_ AS (SELECT mi.line_uci, mi.ply, t.type || t.sq || '/' || d.type || d.sq AS interference FROM mi JOIN m6 x ON x.line_uci = mi.line_uci AND x.ply = mi.ply
  JOIN pcs t ON t.fen = x.bfen AND t.csq = best // 10000 JOIN pcs d ON d.fen = x.bfen AND d.csq = (best // 100) % 100),
cp AS (SELECT x.line_uci, x.ply, x.bfen, x.afen, x.mover, p.idx, p.type, p.value FROM m6 x JOIN pcs p ON p.fen = x.bfen AND x.capture
  AND p.idx = CASE WHEN x.en_passant THEN x.ti + CASE x.mover WHEN 'w' THEN 8 ELSE -8 END ELSE x.ti END),
df AS (SELECT cp.line_uci, cp.ply, max(t.value * 100 + 63 - t.csq) AS best, arg_max(t.type || t.sq, t.value * 100 + 63 - t.csq) AS deflection FROM cp
  JOIN edges e ON e.fen = cp.bfen AND e.from_idx = cp.idx AND e.to_color = e.from_color AND e.to_type <> 'k' JOIN pcs t ON t.fen = cp.bfen AND t.idx = e.to_idx
  WHERE EXISTS (SELECT 1 FROM held h WHERE h.fen = cp.afen AND h.to_idx = e.to_idx AND h.c = cp.mover)
    AND NOT EXISTS (SELECT 1 FROM held h WHERE h.fen = cp.afen AND h.to_idx = e.to_idx AND h.c <> cp.mover) GROUP BY cp.line_uci, cp.ply),
hit AS (SELECT x.line_uci, x.ply, count(*) FILTER (t.type IN ('n', 'b', 'r', 'q')) AS n_fork, bool_or(t.type = 'k') AS hits_king,
    arg_min(t.type, t.csq) FILTER (t.type IN ('n', 'b', 'r', 'q')) AS first_hit FROM m6 x JOIN edges e ON e.fen = x.afen AND e.from_idx = x.ti
    AND e.to_color <> x.mover JOIN pcs t ON t.fen = x.afen AND t.idx = e.to_idx GROUP BY x.line_uci, x.ply),
bt AS (SELECT x.line_uci, x.ply, min(CASE WHEN me.type = 'r' AND o.type = 'r' AND o.file = me.file THEN 1
    WHEN o.file = me.file AND ((me.type IN ('q', 'r') AND o.type = 'q') OR (me.type = 'q' AND o.type = 'r')) THEN 2
    WHEN abs(o.file - me.file) = abs(o.rank - me.rank) AND ((me.type IN ('q', 'b') AND o.type = 'q') OR (me.type = 'q' AND o.type = 'b')) THEN 3 END) AS kind
  FROM m6 x JOIN pcs me ON me.fen = x.afen AND me.idx = x.ti JOIN pcs o ON o.fen = x.afen AND o.color = me.color AND o.idx <> me.idx GROUP BY x.line_uci, x.ply),
op AS (SELECT x.line_uci, x.ply FROM m6 x JOIN pcs me ON me.fen = x.afen AND me.idx = x.ti AND me.type = 'n' AND CASE x.mover WHEN 'w' THEN me.rank >= 4 ELSE me.rank <= 5 END
  WHERE EXISTS (SELECT 1 FROM edges e WHERE e.fen = x.afen AND e.to_idx = x.ti AND e.from_type = 'p' AND e.from_color = x.mover) AND NOT EXISTS (SELECT 1 FROM pcs p
    WHERE p.fen = x.afen AND p.type = 'p' AND p.color <> x.mover AND abs(p.file - me.file) = 1 AND CASE x.mover WHEN 'w' THEN p.rank > me.rank ELSE p.rank < me.rank END)),
mot0 AS (SELECT x.line_uci, x.ply, x.capture, x.gives_check, x.hanging_after, x.mover, lower(x.pc) AS kind, x.fi, x.underpromotion, x.en_passant, x.quiet, cp.type AS cap_type, cp.value AS cap_value,
    {VAL.format(t='lower(x.pc)')} AS worth, min_.interference, df.deflection, coalesce(hit.n_fork, 0) AS n_fork, hit.first_hit,
    x.gives_check AND NOT coalesce(hit.hits_king, false) AS clearance, op.line_uci IS NOT NULL AS outpost,
    CASE bt.kind WHEN 1 THEN 'rooks' WHEN 2 THEN 'queen_rook' WHEN 3 THEN 'queen_bishop' END AS battery,
    EXISTS (SELECT 1 FROM edges e JOIN pcs k ON k.fen = e.fen AND k.idx = e.second_idx WHERE e.fen = x.bfen AND e.from_color = x.mover AND e.dir IS NOT NULL
      AND e.to_idx = x.fi AND k.color <> x.mover) AS discovered_attack,
    EXISTS (SELECT 1 FROM held h WHERE h.fen = x.bfen AND h.to_idx = x.fi AND h.c <> x.mover)
      AND NOT EXISTS (SELECT 1 FROM held h WHERE h.fen = x.bfen AND h.to_idx = x.fi AND h.c = x.mover) AS loose_before,
    list_contains(string_split(sb.weak_squares, ','), substr(x.muci, 3, 2)) AS weak_move,
    {_OUT.format(c='x.mover', w='eb.hanging_w', b='eb.hanging_b')} AS own_loose, ea.double_check AS ea_double, ea.pinned_stm AS ea_pins,
    {_OUT.format(c='x.mover', w='ea.skewers_w', b='ea.skewers_b')} AS own_skewers, {_OUT.format(c='x.mover', w='ea.xrays_w', b='ea.xrays_b')} AS own_xrays,
    {_OUT.format(c='x.mover', w='ea.overloaded_b', b='ea.overloaded_w')} AS foe_overloaded, {_OUT.format(c='x.mover', w='ea.back_rank_b', b='ea.back_rank_w')} AS foe_back_rank,
    tb.threats AS threats_before, ta.threats AS threats_after
  FROM m6 x JOIN efeat2 eb ON eb.fen = x.bfen JOIN efeat2 ea ON ea.fen = x.afen JOIN sfeat sb ON sb.fen = x.bfen
  JOIN thr tb ON tb.fen = x.bfen AND tb.c <> x.mover JOIN thr ta ON ta.fen = x.afen AND ta.c <> x.mover
  LEFT JOIN min_ ON min_.line_uci = x.line_uci AND min_.ply = x.ply LEFT JOIN df ON df.line_uci = x.line_uci AND df.ply = x.ply
  LEFT JOIN hit ON hit.line_uci = x.line_uci AND hit.ply = x.ply LEFT JOIN cp ON cp.line_uci = x.line_uci AND cp.ply = x.ply
  LEFT JOIN bt ON bt.line_uci = x.line_uci AND bt.ply = x.ply LEFT JOIN op ON op.line_uci = x.line_uci AND op.ply = x.ply),
mot1 AS (SELECT *, (capture OR gives_check) AND hanging_after AND worth >= 3 AS gift FROM mot0),
mot2 AS (SELECT *, coalesce(gift AND loose_before AND cap_value >= 3 AND cap_value >= worth - 1, false) AS desperado FROM mot1),
mot3 AS (SELECT *, gift AND NOT desperado AS sacrifice, gives_check AND hanging_after AS decoy, (capture OR gives_check) AND own_loose > 0 AS zwischenzug,
    CASE WHEN NOT (CASE mover WHEN 'w' THEN fi >= 49 ELSE fi <= 16 END) THEN NULL WHEN gives_check THEN 'check' WHEN first_hit IN ('q', 'r') THEN 'heavy'
      WHEN first_hit IN ('n', 'b') THEN 'minor' END AS tempo,
    CASE WHEN threats_before - threats_after >= 2 THEN 'several' WHEN threats_before - threats_after = 1 THEN 'one' END AS prophylactic FROM mot2),
mot AS (SELECT line_uci, ply, clearance, discovered_attack, interference, deflection, desperado, sacrifice, decoy, zwischenzug, battery, outpost,
    threats_before, threats_after, tempo, prophylactic, list_filter([{', '.join(f"CASE WHEN {cond} THEN '{k}' END" for k, cond in _RANKED)}], lambda k: k IS NOT NULL) AS motifs FROM mot3)"""

MOVE_SQL = f"""m0 AS (SELECT mv.*, {_fidx('muci', 1, 2)} AS fi, {_fidx('muci', 3, 4)} AS ti,
  CASE WHEN ruci IS NOT NULL THEN {_fidx('ruci', 3, 4)} END AS rti FROM mv),
m1 AS (SELECT m0.*, substr(db.b, fi, 1) AS pc, substr(db.b, ti, 1) AS tp, db.side AS mover,
  substr(da.b, ti, 1) AS moved, CASE WHEN rti IS NOT NULL THEN substr(da.b, rti, 1) END AS rtp
  FROM m0 JOIN bds db ON db.fen = m0.bfen JOIN bds da ON da.fen = m0.afen),
m2 AS (SELECT m1.*, lower(pc) = 'p' AND substr(muci, 1, 1) <> substr(muci, 3, 1) AND tp = '.' AS en_passant,
  length(muci) = 5 AS promotion, length(muci) = 5 AND substr(muci, 5, 1) IN ('n', 'b', 'r') AS underpromotion,
  lower(pc) = 'k' AND abs(ascii(substr(muci, 3, 1)) - ascii(substr(muci, 1, 1))) = 2 AS castling FROM m1),
m3 AS (SELECT m2.*, (tp <> '.' OR en_passant) AS capture, ea.in_check AS gives_check,
  EXISTS (SELECT 1 FROM edges x JOIN pcs k ON k.fen = x.fen AND k.idx = x.to_idx WHERE x.fen = m2.afen
    AND k.type = 'k' AND k.color <> m2.mover AND x.from_color = m2.mover AND x.from_idx <> m2.ti) AS discovered_check
  FROM m2 JOIN efeat2 ea ON ea.fen = m2.afen),
m4 AS (SELECT m3.*, NOT (capture OR gives_check OR promotion OR castling) AS quiet,
  coalesce(t.ab, 0) AS opp_att_w, coalesce(t.aw, 0) AS own_att_w FROM m3
  LEFT JOIN att t ON t.fen = m3.afen AND t.to_idx = m3.ti),
m5 AS (SELECT m4.*,
  CASE WHEN mover = 'w' THEN opp_att_w ELSE own_att_w END AS attacked_by_opp,
  CASE WHEN mover = 'w' THEN own_att_w ELSE opp_att_w END AS defended_by_own FROM m4),
dx AS (SELECT m5.line_uci, m5.ply, m5.bfen, x.from_idx, x.to_idx FROM m5 JOIN edges x ON x.fen = m5.afen
  AND x.from_color = m5.mover AND x.from_idx <> m5.ti AND x.to_color IS NOT NULL AND x.to_color <> m5.mover),
dq AS (SELECT line_uci, ply, CAST(count(*) AS BIGINT) AS n FROM dx WHERE NOT EXISTS (SELECT 1 FROM edges y
  WHERE y.fen = dx.bfen AND y.from_idx = dx.from_idx AND y.to_idx = dx.to_idx) GROUP BY line_uci, ply),
m6 AS (SELECT m5.*, attacked_by_opp > 0 AND defended_by_own = 0 AS hanging_after,
  coalesce(dq.n, 0) AS discovered_attacks,
  (SELECT CAST(count(*) AS BIGINT) FROM edges x WHERE x.fen = m5.afen AND x.from_idx = m5.ti AND
    x.to_color IS NOT NULL AND x.to_color <> m5.mover) AS new_targets,
  (SELECT max({VAL.format(t='x.to_type')}) FROM edges x WHERE x.fen = m5.afen AND x.from_idx = m5.ti AND
    x.to_color IS NOT NULL AND x.to_color <> m5.mover AND x.to_type <> 'k') AS best_target_value FROM m5
  LEFT JOIN dq ON dq.line_uci = m5.line_uci AND dq.ply = m5.ply),
m7 AS (SELECT m6.*,
  CASE WHEN mover = 'w' THEN coalesce(hb.hang_w, 0) ELSE coalesce(hb.hang_b, 0) END AS own_hang_before,
  CASE WHEN mover = 'w' THEN coalesce(ha.hang_w, 0) ELSE coalesce(ha.hang_b, 0) END AS own_hang_after,
  CASE WHEN mover = 'w' THEN coalesce(hb.hang_b, 0) ELSE coalesce(hb.hang_w, 0) END AS opp_hang_before,
  CASE WHEN mover = 'w' THEN coalesce(ha.hang_b, 0) ELSE coalesce(ha.hang_w, 0) END AS opp_hang_after,
  fb.open_files AS open_before, fb.half_open_stm AS half_before, coalesce(pa.apw, 0) AS apw, coalesce(pa.apb, 0) AS apb,
  er.in_check AS reply_check, CASE WHEN mover = 'w' THEN er.hanging_w ELSE er.hanging_b END AS own_hang_reply,
  CASE WHEN mover = 'w' THEN er.forks_b ELSE er.forks_w END AS reply_forks, er.pinned_stm AS reply_pins,
  CASE WHEN mover = 'w' THEN er.skewers_b ELSE er.skewers_w END AS reply_skewers
  FROM m6 LEFT JOIN hangk hb ON hb.fen = m6.bfen LEFT JOIN hangk ha ON ha.fen = m6.afen
  JOIN feat fb ON fb.fen = m6.bfen LEFT JOIN att pa ON pa.fen = m6.afen AND pa.to_idx = m6.ti LEFT JOIN efeat2 er ON er.fen = m6.rfen),
{MOTIF_SQL},
key_squares AS (SELECT * FROM (VALUES {KEY_VALUES}) t(n, sq, i)),
press AS (SELECT m7.line_uci, m7.ply, min(k.n * 100 + k.i) AS p FROM m7 JOIN edges e ON e.fen = m7.afen AND e.from_idx = m7.ti
  JOIN key_squares k ON k.i = e.to_idx GROUP BY m7.line_uci, m7.ply),
moves0 AS (SELECT m7.*, CASE WHEN NOT quiet THEN '' ELSE concat_ws(',',
  CASE best_target_value WHEN 9 THEN 'targets_queen' WHEN 5 THEN 'targets_rook' WHEN 3 THEN 'targets_minor' END,
  CASE WHEN lower(moved) = 'r' THEN CASE WHEN instr(open_before, substr(muci, 3, 1)) > 0 THEN 'rook_open_file'
    WHEN instr(half_before, substr(muci, 3, 1)) > 0 THEN 'rook_half_open_file' END END,
  CASE WHEN lower(moved) = 'n' AND (substr(muci, 3, 2) IN (SELECT sq FROM key_squares) OR
    (mover = 'w' AND substr(muci, 4, 1) >= '5' AND apw > 0 AND apb = 0) OR
    (mover = 'b' AND substr(muci, 4, 1) <= '4' AND apb > 0 AND apw = 0)) THEN 'knight_post' END,
  (SELECT 'presses_' || k.sq FROM key_squares k WHERE k.n = floor(press.p / 100))) END AS move_target,
  CASE WHEN ruci IS NULL THEN NULL WHEN rtp IS NOT NULL AND rtp <> '.' THEN 'loses_' || lower(rtp)
    WHEN reply_check THEN 'allows_check' WHEN own_hang_reply > 0 THEN 'leaves_hanging' WHEN reply_forks > 0 THEN 'runs_into_fork'
    WHEN reply_pins > 0 THEN 'runs_into_pin' WHEN reply_skewers > 0 THEN 'runs_into_skewer' ELSE 'generic' END
    AS blunder_outcome FROM m7 LEFT JOIN press ON press.line_uci = m7.line_uci AND press.ply = m7.ply),
moves AS (SELECT x.*, {', '.join(f"array_to_string(motifs[1:{n}], ',') AS motifs_{n}" for n in (1, 2, 3))} FROM
  (SELECT y.* EXCLUDE (line_uci, ply), z.* FROM moves0 z JOIN mot y ON y.line_uci = z.line_uci AND y.ply = z.ply) x)"""


def _duck_moves() -> str:
    from rookery.plans.q_board import GAME_LINES_SQL, sql_valid_prefix
    from rookery.plans.q_boardfx import BOARD_SQL, DUCK_BASE
    sf = S.q(START_FEN)
    base = DUCK_BASE.replace("FROM (SELECT DISTINCT fen FROM fx_positions)", "FROM (SELECT DISTINCT fen FROM mvfens)")
    return (f"{GAME_LINES_SQL}, ld AS (SELECT DISTINCT line_uci FROM gl), "
            f"lr AS (SELECT line_uci, {sql_valid_prefix(S.tokens('line_uci'))} AS mvs FROM ld), "
            f"ls AS (SELECT line_uci, mvs, {replay_states_sql(DUCK, sf, 'mvs')} AS sts FROM lr), "
            "lx AS (SELECT line_uci, mvs, sts, CAST(unnest(range(len(mvs))) AS INT) AS ply FROM ls), "
            "mv AS (SELECT line_uci, ply, mvs[ply + 1] AS muci, sts[ply + 1] AS bfen, sts[ply + 2] AS afen, "
            "mvs[ply + 2] AS ruci, sts[ply + 3] AS rfen FROM lx), "
            "mvfens AS (SELECT bfen AS fen FROM mv UNION SELECT afen FROM mv UNION SELECT rfen FROM mv "
            f"WHERE rfen IS NOT NULL), {base},\n{BOARD_SQL},\n{MOVE_SQL}")


def move_query(key: str, cols: list[str]):
    sel = f"SELECT gl.game_id, m.ply, {', '.join(SQL_NAMES.get(c, f'm.{c}') for c in cols)} FROM gl JOIN moves m ON m.line_uci = gl.line_uci"

    def fn(spark, sf):
        """Moves of each distinct line, joined to every game that plays it."""
        g, mv, fens = spark_moves(spark, sf)
        found = move_features(mv, BD.boards(fens)).select("line_uci", "ply", *cols)
        return g.join(found, "line_uci").select("game_id", "ply", *cols)
    fn.__name__ = f"q_{key}"
    register(key, with_fx(f"WITH {_duck_moves()}\n{sel}", "fx_games", "fx_lines"))(fn)


SQL_NAMES = {"threat_reduced": "m.own_hang_before > m.own_hang_after AS threat_reduced",
             "threat_created": "m.opp_hang_after > m.opp_hang_before AS threat_created"}

move_query("move_flags", ["capture", "promotion", "underpromotion", "en_passant", "castling", "gives_check", "quiet", "discovered_check", "clearance"])
move_query("sacrifice_flags", ["hanging_after", "sacrifice", "desperado", "decoy"])
move_query("edge_delta_motifs", ["discovered_attacks", "new_targets", "interference", "deflection"])
move_query("tempo_threat_flags", ["threat_reduced", "threat_created", "threats_before", "threats_after", "prophylactic", "zwischenzug", "tempo"])
move_query("move_motifs", ["motifs_1", "motifs_2", "motifs_3", "battery", "outpost"])
move_query("move_targets", ["move_target"])
move_query("blunder_outcome", ["blunder_outcome"])
