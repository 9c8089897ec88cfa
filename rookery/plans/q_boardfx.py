"""Board analytics queries.

Spark computes a board's features inside its row (``operators.board_features``).
The oracle below states the same rules separately, as relational SQL: ``pcs`` (a
row a piece), ``edges`` (a row an attacked square) and aggregates over them.
"""

from __future__ import annotations

from rookery.operators import board as BD
from rookery.operators import board_features as BF
from rookery.plans.registry import register
from rookery.sources.fixtures import fx_positions, with_fx

FILES = "abcdefgh"


def _cnt(cond: str) -> str:
    return f"CAST(count_if({cond}) AS BIGINT)"


def _sq(file_expr: str, rank_expr: str) -> str:
    return f"(chr(CAST({file_expr} + 97 AS INT)) || CAST({rank_expr} AS STRING))"


# Per-board piece aggregates (file counts, kings, material, classes).
PF = ("pf AS (SELECT fen, max(side) AS side, max(fullmove) AS fullmove, count(*) AS n_pieces, "
      "CAST(sum(CASE WHEN color = 'w' THEN value ELSE 0 END) AS BIGINT) AS mat_w, "
      "CAST(sum(CASE WHEN color = 'b' THEN value ELSE 0 END) AS BIGINT) AS mat_b, "
      + ", ".join(f"{_cnt(f'type = {chr(39)}p{chr(39)} AND color = {chr(39)}{c}{chr(39)} AND file = {f}')} AS p{c}{f}"
                  for c in "wb" for f in range(8))
      + ", " + ", ".join(f"{_cnt(f'type = {chr(39)}{t}{chr(39)} AND color = {chr(39)}{c}{chr(39)}')} AS n_{t}{c}"
                         for t in "pnbrqk" for c in "wb")
      + ", max(CASE WHEN type = 'k' AND color = 'w' THEN file END) AS kfw, "
      "max(CASE WHEN type = 'k' AND color = 'w' THEN rank END) AS krw, "
      "max(CASE WHEN type = 'k' AND color = 'b' THEN file END) AS kfb, "
      "max(CASE WHEN type = 'k' AND color = 'b' THEN rank END) AS krb, "
      "max(CASE WHEN type = 'k' AND color = 'w' THEN idx END) AS kiw, "
      "max(CASE WHEN type = 'k' AND color = 'b' THEN idx END) AS kib, "
      "sum(CASE WHEN type = 'b' AND color = 'w' THEN (file + rank - 1) % 2 END) AS bpar_w, "
      "sum(CASE WHEN type = 'b' AND color = 'b' THEN (file + rank - 1) % 2 END) AS bpar_b, "
      + _cnt("type IN ('n', 'b') AND color = 'w' AND sq IN ('b1', 'g1', 'c1', 'f1')") + " AS undev_w, "
      + _cnt("type IN ('n', 'b') AND color = 'b' AND sq IN ('b8', 'g8', 'c8', 'f8')") + " AS undev_b, "
      + _cnt("type = 'r' AND color = 'w' AND rank = 7") + " AS r7_w, "
      + _cnt("type = 'r' AND color = 'b' AND rank = 2") + " AS r7_b "
      "FROM pcs GROUP BY fen)")


def _islands(c: str) -> str:
    terms = [f"CASE WHEN p{c}0 > 0 THEN 1 ELSE 0 END"] + [
        f"CASE WHEN p{c}{f} > 0 AND p{c}{f - 1} = 0 THEN 1 ELSE 0 END" for f in range(1, 8)]
    return "(" + " + ".join(terms) + ")"


def _doubled(c: str) -> str:
    return "CASE " + " ".join(f"WHEN p{c}{f} >= 2 THEN '{FILES[f]}'" for f in range(8)) + " END"


def _open_files() -> str:
    return "concat(" + ", ".join(f"CASE WHEN pw{f} + pb{f} = 0 THEN '{FILES[f]}' ELSE '' END" for f in range(8)) + ")"


def _half_open(own: str, opp: str) -> str:
    return "concat(" + ", ".join(f"CASE WHEN p{own}{f} = 0 AND p{opp}{f} > 0 THEN '{FILES[f]}' ELSE '' END"
                                 for f in range(8)) + ")"


def _majority(c: str) -> str:
    qs = " + ".join(f"p{c}{f}" for f in range(4))
    ks = " + ".join(f"p{c}{f}" for f in range(4, 8))
    return (f"CASE WHEN abs(({qs}) - ({ks})) < 2 THEN NULL WHEN ({qs}) > ({ks}) THEN 'queenside' "
            "ELSE 'kingside' END")


def _material_label() -> str:
    return ("CASE WHEN mat_w = mat_b THEN 'even' ELSE (CASE WHEN mat_w > mat_b THEN 'white' ELSE 'black' END) || "
            "CASE WHEN abs(mat_w - mat_b) = 1 THEN '_pawn' WHEN abs(mat_w - mat_b) = 2 THEN '_small' "
            "ELSE '_material' END END")


def _endgame_type() -> str:
    q, r, m = "(n_qw + n_qb)", "(n_rw + n_rb)", "(n_bw + n_bb + n_nw + n_nb)"
    return (f"CASE WHEN {q} = 0 AND {r} = 0 AND {m} = 0 THEN 'pawn endgame' "
            f"WHEN {q} = 0 AND {r} > 0 AND {m} = 0 THEN 'rook endgame' "
            f"WHEN {q} = 0 AND {r} = 0 AND {m} > 0 THEN 'minor-piece endgame' "
            f"WHEN {q} > 0 AND {r} = 0 THEN 'queen endgame' "
            f"WHEN {q} = 0 AND {r} > 0 AND {m} > 0 THEN 'rook + minor endgame' ELSE 'endgame' END")


# Pawn-level structure: isolated (most advanced), passed (first by square), king shield.
PAWNS = ("pw AS (SELECT p.fen, p.color, p.file, p.rank, p.csq, p.idx FROM pcs p WHERE p.type = 'p'), "
         "iso AS (SELECT a.fen, a.color, a.file, a.rank FROM pw a WHERE NOT EXISTS (SELECT 1 FROM pw x "
         "WHERE x.fen = a.fen AND x.color = a.color AND abs(x.file - a.file) = 1)), "
         "isok AS (SELECT fen, max(CASE WHEN color = 'w' THEN rank * 10 + (9 - file) END) AS kw, "
         "min(CASE WHEN color = 'b' THEN rank * 10 + file END) AS kb FROM iso GROUP BY fen), "
         "pas AS (SELECT a.fen, a.color, a.csq FROM pw a WHERE NOT EXISTS (SELECT 1 FROM pw x WHERE x.fen = a.fen "
         "AND x.color <> a.color AND abs(x.file - a.file) <= 1 AND ((a.color = 'w' AND x.rank > a.rank) OR "
         "(a.color = 'b' AND x.rank < a.rank)))), "
         "pask AS (SELECT fen, min(CASE WHEN color = 'w' THEN csq END) AS pw_sq, "
         "min(CASE WHEN color = 'b' THEN csq END) AS pb_sq FROM pas GROUP BY fen), "
         "shield AS (SELECT f.fen, " + _cnt("p.color = 'w' AND p.rank = f.krw + 1 AND abs(p.file - f.kfw) <= 1")
         + " AS sh_w, " + _cnt("p.color = 'b' AND p.rank = f.krb - 1 AND abs(p.file - f.kfb) <= 1")
         + " AS sh_b FROM pf f LEFT JOIN pw p ON p.fen = f.fen GROUP BY f.fen)")


# Rooks on files without pawns (first by square).
ROOKS = ("ropen AS (SELECT r.fen, min(CASE WHEN r.color = 'w' THEN r.csq END) AS ow_sq, min(CASE WHEN r.color = 'b' THEN r.csq END) AS ob_sq "
         "FROM pcs r WHERE r.type = 'r' AND NOT EXISTS (SELECT 1 FROM pw x WHERE x.fen = r.fen AND x.file = r.file) GROUP BY r.fen)")


def _csq_name(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN {_sq(f'{x} % 8', f'CAST(floor({x} / 8) AS INT) + 1')} END"


def _iso_w() -> str:
    return f"CASE WHEN kw IS NOT NULL THEN {_sq('9 - kw % 10', 'CAST(floor(kw / 10) AS INT)')} END"


def _iso_b() -> str:
    return f"CASE WHEN kb IS NOT NULL THEN {_sq('kb % 10', 'CAST(floor(kb / 10) AS INT)')} END"


# Edge aggregates: attackers per target square, hanging pieces, checks, forks, pins, skewers.
EDGE = ("att AS (SELECT fen, to_idx, " + _cnt("from_color = 'w'") + " AS aw, " + _cnt("from_color = 'b'")
        + " AS ab, " + _cnt("from_color = 'w' AND from_type = 'p'") + " AS apw, "
        + _cnt("from_color = 'b' AND from_type = 'p'") + " AS apb FROM edges GROUP BY fen, to_idx), "
        "tgt AS (SELECT p.fen, p.side, p.idx, p.color, p.type, p.value, p.csq, p.sq, coalesce(a.aw, 0) AS aw, "
        "coalesce(a.ab, 0) AS ab FROM pcs p LEFT JOIN att a ON a.fen = p.fen AND a.to_idx = p.idx), "
        "hang AS (SELECT *, CASE WHEN color = side THEN 1 ELSE 0 END AS bias FROM tgt WHERE type <> 'k' AND "
        "((color = 'w' AND ab > 0 AND aw = 0) OR (color = 'b' AND aw > 0 AND ab = 0))), "
        "hangk AS (SELECT fen, " + _cnt("color = 'w'") + " AS hang_w, " + _cnt("color = 'b'") + " AS hang_b, "
        "max(value * 1000 + bias * 100 + csq) AS hk FROM hang GROUP BY fen), "
        "chk AS (SELECT fen, max(CASE WHEN type = 'k' AND color = side THEN (CASE WHEN side = 'w' THEN ab ELSE aw END) "
        "END) AS checkers FROM tgt GROUP BY fen), "
        "fk AS (SELECT fen, from_idx, from_color, " + _cnt("to_color IS NOT NULL AND to_color <> from_color AND "
        "to_type <> 'k' AND to_type IN ('n', 'b', 'r', 'q')") + " AS big FROM edges GROUP BY fen, from_idx, from_color), "
        "fks AS (SELECT fen, " + _cnt("from_color = 'w' AND big >= 2") + " AS forks_w, "
        + _cnt("from_color = 'b' AND big >= 2") + " AS forks_b FROM fk GROUP BY fen), "
        "pin AS (SELECT e.fen, e.side, t.value, t.csq, t.color FROM edges e JOIN pcs t ON t.fen = e.fen AND t.idx = e.to_idx "
        "JOIN pcs k ON k.fen = e.fen AND k.idx = e.second_idx WHERE e.dir IS NOT NULL AND e.to_color IS NOT NULL "
        "AND e.to_color <> e.from_color AND k.type = 'k' AND k.color = e.to_color), "
        "pins AS (SELECT fen, " + _cnt("color = side") + " AS pinned_stm, max(CASE WHEN color = side THEN value * 100 "
        "+ csq END) AS pk FROM pin GROUP BY fen), "
        "ray AS (SELECT e.fen, e.from_color, e.to_type AS t1, k.type AS t2, k.color AS c2, e.to_color AS c1 FROM edges e "
        "JOIN pcs k ON k.fen = e.fen AND k.idx = e.second_idx WHERE e.dir IS NOT NULL AND e.to_color IS NOT NULL), "
        "rays_ AS (SELECT fen, " + ", ".join(
            f"{_cnt(f'from_color = {chr(39)}{c}{chr(39)} AND c1 <> from_color AND c2 <> from_color AND (t1 = {chr(39)}k{chr(39)} OR (CASE t1 WHEN {chr(39)}p{chr(39)} THEN 1 WHEN {chr(39)}n{chr(39)} THEN 3 WHEN {chr(39)}b{chr(39)} THEN 3 WHEN {chr(39)}r{chr(39)} THEN 5 WHEN {chr(39)}q{chr(39)} THEN 9 ELSE 0 END) >= (CASE t2 WHEN {chr(39)}p{chr(39)} THEN 1 WHEN {chr(39)}n{chr(39)} THEN 3 WHEN {chr(39)}b{chr(39)} THEN 3 WHEN {chr(39)}r{chr(39)} THEN 5 WHEN {chr(39)}q{chr(39)} THEN 9 ELSE 0 END))')} AS skewers_{c}, "
            f"{_cnt(f'from_color = {chr(39)}{c}{chr(39)} AND c2 <> from_color AND t2 IN ({chr(39)}k{chr(39)}, {chr(39)}q{chr(39)})')} AS xrays_{c}"
            for c in "wb") + " FROM ray GROUP BY fen), "
        "dfd AS (SELECT e.fen, e.from_idx, e.from_color, " + _cnt("(t.color = 'w' AND t.ab > 0) OR (t.color = 'b' AND t.aw > 0)")
        + " AS n_def FROM edges e JOIN tgt t ON t.fen = e.fen AND t.idx = e.to_idx AND t.color = e.from_color "
        "WHERE t.type <> 'k' GROUP BY e.fen, e.from_idx, e.from_color), "
        "ovl AS (SELECT fen, " + _cnt("from_color = 'w' AND n_def >= 2") + " AS overloaded_w, "
        + _cnt("from_color = 'b' AND n_def >= 2") + " AS overloaded_b FROM dfd GROUP BY fen), "
        "esc AS (SELECT f.fen, k.color, " + _cnt("substr(bb.b, l.to_idx, 1) = '.' AND coalesce(CASE WHEN k.color = 'w' "
        "THEN a.ab ELSE a.aw END, 0) = 0") + " AS n_escape FROM pf f JOIN pcs k ON k.fen = f.fen AND k.type = 'k' "
        "AND ((k.color = 'w' AND k.rank = 1) OR (k.color = 'b' AND k.rank = 8)) JOIN leaps l ON l.from_idx = k.idx "
        "AND l.kind = 'k' JOIN bds bb ON bb.fen = f.fen LEFT JOIN att a ON a.fen = f.fen AND a.to_idx = l.to_idx "
        "GROUP BY f.fen, k.color), "
        "bkr AS (SELECT fen, bool_or(color = 'w' AND n_escape = 0) AS back_rank_w, "
        "bool_or(color = 'b' AND n_escape = 0) AS back_rank_b FROM esc GROUP BY fen)")

FEATURES = ("feat AS (SELECT f.fen, f.side, f.n_pieces, f.mat_w, f.mat_b, f.mat_w - f.mat_b AS mat_diff, "
            f"{_material_label()} AS material_label, "
            "CASE WHEN f.n_pieces <= 10 THEN 'endgame' WHEN f.fullmove <= 10 THEN 'opening' ELSE 'middlegame' END "
            f"AS phase, {_endgame_type()} AS endgame_type, "
            "(f.n_bw = 1 AND f.n_bb = 1 AND f.bpar_w <> f.bpar_b) AS opposite_bishops, "
            f"CAST({_islands('w')} AS INT) AS islands_w, CAST({_islands('b')} AS INT) AS islands_b, "
            f"{_iso_w()} AS isolated_w, {_iso_b()} AS isolated_b, "
            f"{_doubled('w')} AS doubled_w, {_doubled('b')} AS doubled_b, "
            f"{_csq_name('pk_.pw_sq')} AS passed_w, {_csq_name('pk_.pb_sq')} AS passed_b, "
            f"{_majority('w')} AS majority_w, {_majority('b')} AS majority_b, "
            f"{_open_files()} AS open_files, CASE WHEN f.side = 'w' THEN {_half_open('w', 'b')} ELSE "
            f"{_half_open('b', 'w')} END AS half_open_stm, "
            "(f.kfw IS NOT NULL AND f.krw < 8 AND coalesce(sh.sh_w, 0) < 2) AS king_exposed_w, "
            "(f.kfb IS NOT NULL AND f.krb > 1 AND coalesce(sh.sh_b, 0) < 2) AS king_exposed_b, "
            "f.undev_w, f.undev_b, (f.n_bw >= 2) AS bishop_pair_w, (f.n_bb >= 2) AS bishop_pair_b, "
            "(CASE WHEN f.side = 'w' THEN f.n_bw >= 2 AND f.n_bb < 2 ELSE f.n_bb >= 2 AND f.n_bw < 2 END) "
            "AS bishop_pair_adv_stm, (f.r7_w > 0) AS rook_7th_w, (f.r7_b > 0) AS rook_7th_b, "
            "substr('abcdefgh', CAST(ro.ow_sq % 8 AS INT) + 1, 1) AS rook_open_w, substr('abcdefgh', CAST(ro.ob_sq % 8 AS INT) + 1, 1) AS rook_open_b, "
            "CASE WHEN f.n_pieces <= 10 OR f.fullmove > 10 THEN '' WHEN (CASE WHEN f.side = 'w' THEN f.undev_w ELSE f.undev_b END) >= 3 "
            "THEN 'several' WHEN (CASE WHEN f.side = 'w' THEN f.undev_w ELSE f.undev_b END) <= 1 THEN 'complete' ELSE 'some' END AS development "
            "FROM pf f LEFT JOIN ropen ro ON ro.fen = f.fen LEFT JOIN isok ik ON ik.fen = f.fen LEFT JOIN pask pk_ ON pk_.fen = f.fen "
            "LEFT JOIN shield sh ON sh.fen = f.fen)")

EDGE_FEATURES = ("efeat AS (SELECT f.fen, " + _cnt("e.from_color = 'w'") + " AS edges_w, "
                 + _cnt("e.from_color = 'b'") + " AS edges_b FROM pf f LEFT JOIN edges e ON e.fen = f.fen "
                 "GROUP BY f.fen), "
                 "efeat2 AS (SELECT f.fen, ef.edges_w, ef.edges_b, coalesce(h.hang_w, 0) AS hanging_w, "
                 "coalesce(h.hang_b, 0) AS hanging_b, CASE WHEN h.hk IS NOT NULL THEN "
                 + _csq_name("(h.hk % 100)") + " END AS top_hanging, coalesce(c.checkers, 0) AS checkers, "
                 "coalesce(c.checkers, 0) >= 1 AS in_check, coalesce(c.checkers, 0) >= 2 AS double_check, "
                 "coalesce(fk.forks_w, 0) AS forks_w, coalesce(fk.forks_b, 0) AS forks_b, "
                 "coalesce(pn.pinned_stm, 0) AS pinned_stm, CASE WHEN pn.pk IS NOT NULL THEN "
                 + _csq_name("(pn.pk % 100)") + " END AS top_pinned, coalesce(r.skewers_w, 0) AS skewers_w, "
                 "coalesce(r.skewers_b, 0) AS skewers_b, coalesce(r.xrays_w, 0) AS xrays_w, "
                 "coalesce(r.xrays_b, 0) AS xrays_b, coalesce(o.overloaded_w, 0) AS overloaded_w, "
                 "coalesce(o.overloaded_b, 0) AS overloaded_b, coalesce(bk.back_rank_w, false) AS back_rank_w, "
                 "coalesce(bk.back_rank_b, false) AS back_rank_b "
                 "FROM pf f JOIN efeat ef ON ef.fen = f.fen LEFT JOIN hangk h ON h.fen = f.fen "
                 "LEFT JOIN chk c ON c.fen = f.fen LEFT JOIN fks fk ON fk.fen = f.fen LEFT JOIN pins pn ON pn.fen = f.fen "
                 "LEFT JOIN rays_ r ON r.fen = f.fen LEFT JOIN ovl o ON o.fen = f.fen LEFT JOIN bkr bk ON bk.fen = f.fen)")

# Choices for the side to move, from its own (o) and the other side's (t) columns.
_PAIRS = ("isolated", "doubled", "islands", "passed", "majority", "rook_open", "rook_7th", "king_exposed", "bishop_pair")
CODES = ("sides AS (SELECT a.fen, a.open_files, a.half_open_stm, e.in_check, e.double_check, e.pinned_stm, x.weak_squares, "
         + ", ".join(f"CASE WHEN a.side = 'w' THEN a.{k}_{p} ELSE a.{k}_{q} END AS {t}_{k}" for k in _PAIRS for t, p, q in (("o", "w", "b"), ("t", "b", "w")))
         + ", " + ", ".join(f"CASE WHEN a.side = 'w' THEN e.{k}_{p} ELSE e.{k}_{q} END AS {t}_{k}" for k in ("hanging", "forks", "skewers", "overloaded", "back_rank")
                            for t, p, q in (("o", "w", "b"), ("t", "b", "w")))
         + ", " + ", ".join(f"CASE WHEN a.side = 'w' THEN x.{k}_{p} ELSE x.{k}_{q} END AS {t}_{k}" for k in ("outpost", "backward")
                            for t, p, q in (("o", "w", "b"), ("t", "b", "w")))
         + " FROM feat a JOIN efeat2 e ON e.fen = a.fen JOIN sfeat x ON x.fen = a.fen), "
         "cue AS (SELECT fen, 1 AS n, 'bishop_pair' AS c FROM sides WHERE o_bishop_pair "
         "UNION ALL SELECT fen, 2, concat('rook_open_', o_rook_open) FROM sides WHERE o_rook_open IS NOT NULL "
         "UNION ALL SELECT fen, 3, concat('weak_', substr(weak_squares, 1, 2)) FROM sides WHERE weak_squares <> '' "
         "UNION ALL SELECT fen, 4, concat('passed_', o_passed) FROM sides WHERE o_passed IS NOT NULL "
         "UNION ALL SELECT fen, 5, concat('outpost_', o_outpost) FROM sides WHERE o_outpost IS NOT NULL "
         "UNION ALL SELECT fen, 6, concat('isolated_', o_isolated) FROM sides WHERE o_isolated IS NOT NULL "
         "UNION ALL SELECT fen, 7, concat('doubled_', o_doubled) FROM sides WHERE o_doubled IS NOT NULL "
         "UNION ALL SELECT fen, 8, concat('backward_', o_backward) FROM sides WHERE o_backward IS NOT NULL "
         "UNION ALL SELECT fen, 9, concat('half_open_', substr(half_open_stm, 1, 1)) FROM sides WHERE half_open_stm <> '' "
         "UNION ALL SELECT fen, 10, concat('majority_', o_majority) FROM sides WHERE o_majority IS NOT NULL "
         "UNION ALL SELECT fen, 11, 'rook_7th' FROM sides WHERE o_rook_7th "
         "UNION ALL SELECT fen, 12, 'exposed_king' FROM sides WHERE o_king_exposed), "
         "cue2 AS (SELECT fen, max(CASE WHEN r = 1 THEN c END) AS c1, max(CASE WHEN r = 2 THEN c END) AS c2 FROM "
         "(SELECT fen, c, row_number() OVER (PARTITION BY fen ORDER BY n) AS r FROM cue) GROUP BY fen), "
         "codes AS (SELECT s.fen, CASE WHEN o_isolated IS NOT NULL THEN 'own_isolated' WHEN o_doubled IS NOT NULL THEN 'own_doubled' "
         "WHEN o_backward IS NOT NULL THEN 'own_backward' WHEN o_islands > t_islands THEN 'more_islands' WHEN o_islands < t_islands "
         "THEN 'fewer_islands' WHEN t_isolated IS NOT NULL OR t_doubled IS NOT NULL OR t_backward IS NOT NULL THEN 'opponent_weakness' "
         "ELSE 'healthy' END AS pawn_structure_code, "
         "CASE WHEN in_check AND o_hanging > 0 THEN 'in_check,hanging' WHEN in_check AND o_king_exposed THEN 'in_check,king_exposed' "
         "WHEN in_check THEN 'in_check' WHEN o_hanging > 0 AND o_king_exposed THEN 'hanging,king_exposed' WHEN o_hanging > 0 THEN 'hanging' "
         "WHEN o_king_exposed THEN 'king_exposed' ELSE 'no_problem' END AS problem_code, "
         "CASE WHEN o_king_exposed THEN 'own_exposed' WHEN t_king_exposed THEN 'opponent_exposed' ELSE 'both_safe' END AS king_safety_code, "
         "CASE WHEN double_check THEN 'double_check' WHEN t_forks > 0 THEN 'fork' WHEN pinned_stm > 0 THEN 'pin' WHEN t_skewers > 0 THEN 'skewer' "
         "WHEN o_overloaded > 0 THEN 'overloaded' WHEN o_back_rank THEN 'back_rank' END AS top_motif, "
         "CASE WHEN c1 IS NULL THEN '' WHEN c2 IS NULL THEN c1 ELSE concat(c1, ',', c2) END AS cues_all "
         "FROM sides s LEFT JOIN cue2 c ON c.fen = s.fen)")

# Static structure: weak squares, outposts, batteries, backward pawns (side-aware).
WEAK_SQUARES = [("d", 4), ("e", 4), ("d", 5), ("e", 5), ("c", 4), ("f", 4), ("c", 5), ("f", 5)]


def _weak_list() -> str:
    parts = []
    for f, r in WEAK_SQUARES:
        i = (8 - r) * 8 + "abcdefgh".index(f) + 1
        # attacker = side to move; white needs rank >= 5, black rank <= 4
        cond = (f"((f.side = 'w' AND {r} >= 5 AND coalesce(a{i}.apb, 0) = 0 AND coalesce(a{i}.aw, 0) > 0) OR "
                f"(f.side = 'b' AND {r} <= 4 AND coalesce(a{i}.apw, 0) = 0 AND coalesce(a{i}.ab, 0) > 0))")
        parts.append(f"CASE WHEN {cond} THEN '{f}{r}' END")
    return "concat_ws(',', " + ", ".join(parts) + ")"


def _weak_joins() -> str:
    js = []
    for f, r in WEAK_SQUARES:
        i = (8 - r) * 8 + "abcdefgh".index(f) + 1
        js.append(f"LEFT JOIN att a{i} ON a{i}.fen = f.fen AND a{i}.to_idx = {i}")
    return " ".join(js)


STATIC2 = (
    "weak AS (SELECT f.fen, " + _weak_list() + " AS weak_squares FROM pf f " + _weak_joins() + "), "
    "opost AS (SELECT t.fen, min(CASE WHEN t.color = 'w' THEN (CASE WHEN t.type = 'n' THEN 0 ELSE 100 END) + t.csq END) "
    "AS ow, min(CASE WHEN t.color = 'b' THEN (CASE WHEN t.type = 'n' THEN 0 ELSE 100 END) + t.csq END) AS ob "
    "FROM tgt t LEFT JOIN att a ON a.fen = t.fen AND a.to_idx = t.idx WHERE t.type IN ('n', 'b') AND "
    "((t.color = 'w' AND t.csq >= 32 AND coalesce(a.apw, 0) > 0 AND coalesce(a.apb, 0) = 0) OR "
    "(t.color = 'b' AND t.csq < 32 AND coalesce(a.apb, 0) > 0 AND coalesce(a.apw, 0) = 0)) GROUP BY t.fen), "
    "bat AS (SELECT a.fen, a.color, "
    "bool_or(a.type = 'r' AND b.type = 'r' AND a.file = b.file) AS rr, "
    "bool_or(a.type = 'q' AND b.type = 'r' AND a.file = b.file) AS qr, "
    "bool_or(a.type = 'q' AND b.type = 'b' AND abs(a.file - b.file) = abs(a.rank - b.rank)) AS qb "
    "FROM pcs a JOIN pcs b ON b.fen = a.fen AND b.color = a.color AND b.idx <> a.idx "
    "WHERE a.type IN ('r', 'q') GROUP BY a.fen, a.color), "
    "bats AS (SELECT fen, bool_or(color = 'w' AND (rr OR qr OR qb)) AS battery_w, "
    "bool_or(color = 'b' AND (rr OR qr OR qb)) AS battery_b, "
    "concat_ws(',', CASE WHEN bool_or(color = 'w' AND rr) THEN 'w_rooks' END, CASE WHEN bool_or(color = 'w' AND qr) "
    "THEN 'w_queen_rook' END, CASE WHEN bool_or(color = 'w' AND qb) THEN 'w_queen_bishop' END, "
    "CASE WHEN bool_or(color = 'b' AND rr) THEN 'b_rooks' END, CASE WHEN bool_or(color = 'b' AND qr) "
    "THEN 'b_queen_rook' END, CASE WHEN bool_or(color = 'b' AND qb) THEN 'b_queen_bishop' END) AS batteries "
    "FROM bat GROUP BY fen), "
    "bwd0 AS (SELECT a.fen, a.color, a.file, a.rank, a.idx FROM pw a WHERE EXISTS (SELECT 1 FROM pw x WHERE "
    "x.fen = a.fen AND x.color = a.color AND abs(x.file - a.file) = 1) AND NOT EXISTS (SELECT 1 FROM pw x WHERE "
    "x.fen = a.fen AND x.color = a.color AND abs(x.file - a.file) = 1 AND ((a.color = 'w' AND x.rank <= a.rank) OR "
    "(a.color = 'b' AND x.rank >= a.rank))) AND ((a.color = 'w' AND a.rank < 8) OR (a.color = 'b' AND a.rank > 1))), "
    "bwd1 AS (SELECT b.*, CASE WHEN b.color = 'w' THEN b.idx - 8 ELSE b.idx + 8 END AS fidx FROM bwd0 b), "
    "bwd AS (SELECT b.fen, min(CASE WHEN b.color = 'w' THEN b.rank * 10 + b.file END) AS kbw, "
    "min(CASE WHEN b.color = 'b' THEN (9 - b.rank) * 10 + b.file END) AS kbb FROM bwd1 b "
    "JOIN bds d ON d.fen = b.fen LEFT JOIN att a ON a.fen = b.fen AND a.to_idx = b.fidx "
    "WHERE substr(d.b, b.fidx, 1) = '.' AND ((b.color = 'w' AND coalesce(a.ab, 0) > 0 AND coalesce(a.aw, 0) = 0) OR "
    "(b.color = 'b' AND coalesce(a.aw, 0) > 0 AND coalesce(a.ab, 0) = 0)) GROUP BY b.fen), "
    "sfeat AS (SELECT f.fen, w.weak_squares, "
    "CASE WHEN o.ow IS NOT NULL THEN " + _csq_name("(o.ow % 100)") + " END AS outpost_w, "
    "CASE WHEN o.ob IS NOT NULL THEN " + _csq_name("(o.ob % 100)") + " END AS outpost_b, "
    "coalesce(bt.battery_w, false) AS battery_w, coalesce(bt.battery_b, false) AS battery_b, "
    "coalesce(bt.batteries, '') AS batteries, "
    "CASE WHEN bw.kbw IS NOT NULL THEN " + _sq("bw.kbw % 10", "CAST(floor(bw.kbw / 10) AS INT)") + " END AS backward_w, "
    "CASE WHEN bw.kbb IS NOT NULL THEN " + _sq("bw.kbb % 10", "9 - CAST(floor(bw.kbb / 10) AS INT)") + " END AS backward_b "
    "FROM pf f JOIN weak w ON w.fen = f.fen LEFT JOIN opost o ON o.fen = f.fen LEFT JOIN bats bt ON bt.fen = f.fen "
    "LEFT JOIN bwd bw ON bw.fen = f.fen)")

BOARD_SQL = ",\n".join([PF, PAWNS, ROOKS, EDGE, FEATURES, EDGE_FEATURES, STATIC2, CODES])


# ---- DuckDB side: pieces, geometry, edges ------------------------------------------------

def _b_sql(fen: str) -> str:
    s = f"replace(split_part({fen}, ' ', 1), '/', '')"
    for n in range(8, 0, -1):
        s = f"replace({s}, '{n}', '{'.' * n}')"
    return s


def _value_sql(t: str) -> str:
    return "CASE " + " ".join(f"WHEN {t} = '{k}' THEN {v}" for k, v in BD.PIECE_VALUES.items()) + " ELSE 0 END"


RAYS_VALUES = "rays AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{k}', '{d}', [{', '.join(map(str, cells))}])" for i, k, d, cells in BD.ray_rows()) + \
    ") t(from_idx, kind, dir, cells))"
LEAPS_VALUES = "leaps AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{k}', {t})" for i, k, t in BD.leap_rows()) + ") t(from_idx, kind, to_idx))"

DUCK_BASE = f"""bds AS (SELECT fen, {_b_sql('fen')} AS b, split_part(fen, ' ', 2) AS side,
  CAST(split_part(fen, ' ', 6) AS INT) AS fullmove FROM (SELECT DISTINCT fen FROM fx_positions)),
pc0 AS (SELECT bds.*, CAST(i AS INT) AS idx, substr(b, CAST(i AS INT), 1) AS pc FROM bds, range(1, 65) r(i)),
pcs AS (SELECT fen, b, side, fullmove, idx, CAST((idx - 1) % 8 AS INT) AS file, CAST(8 - floor((idx - 1) / 8) AS INT) AS rank,
  chr(CAST((idx - 1) % 8 + 97 AS INT)) || CAST(CAST(8 - floor((idx - 1) / 8) AS INT) AS VARCHAR) AS sq,
  CAST((7 - floor((idx - 1) / 8)) * 8 + (idx - 1) % 8 AS INT) AS csq,
  CASE WHEN pc = upper(pc) THEN 'w' ELSE 'b' END AS color, lower(pc) AS type, {_value_sql('lower(pc)')} AS value
  FROM pc0 WHERE pc <> '.'),
{RAYS_VALUES},
{LEAPS_VALUES},
sl0 AS (SELECT p.*, r.kind, r.dir, r.cells FROM pcs p JOIN rays r ON r.from_idx = p.idx AND
  ((p.type = 'b' AND r.kind = 'diag') OR (p.type = 'r' AND r.kind = 'orth') OR p.type = 'q')),
sl1 AS (SELECT *, list_transform(cells, lambda c: substr(b, c, 1) <> '.') AS occ FROM sl0),
sl2 AS (SELECT *, CAST(coalesce(list_position(occ, true), 0) AS INT) AS fst FROM sl1),
sl3 AS (SELECT *, CAST(coalesce(list_position(occ[fst + 1:], true), 0) AS INT) AS snd FROM sl2),
sl4 AS (SELECT fen, b, side, idx AS from_idx, color AS from_color, type AS from_type, dir, fst,
  CASE WHEN fst > 0 AND snd > 0 THEN cells[fst + snd] END AS sec,
  CASE WHEN fst = 0 THEN cells ELSE cells[1:fst] END AS hit FROM sl3),
sl5 AS (SELECT *, unnest(hit) AS to_idx, CAST(unnest(range(1, len(hit) + 1)) AS INT) AS step FROM sl4),
ed0 AS (SELECT fen, b, side, from_idx, from_color, from_type, dir, step, CAST(to_idx AS INT) AS to_idx,
  CAST(CASE WHEN step = fst THEN sec END AS INT) AS second_idx FROM sl5
  UNION ALL SELECT p.fen, p.b, p.side, p.idx, p.color, p.type, NULL, 1, l.to_idx, NULL FROM pcs p
  JOIN leaps l ON l.from_idx = p.idx AND l.kind = CASE WHEN p.type = 'p' THEN p.color || 'p' ELSE p.type END
  WHERE p.type IN ('n', 'k', 'p')),
edges AS (SELECT fen, side, from_idx, from_color, from_type, dir, step, to_idx,
  CASE WHEN substr(b, to_idx, 1) = '.' THEN NULL WHEN substr(b, to_idx, 1) = upper(substr(b, to_idx, 1)) THEN 'w'
  ELSE 'b' END AS to_color, CASE WHEN substr(b, to_idx, 1) = '.' THEN NULL ELSE lower(substr(b, to_idx, 1)) END
  AS to_type, second_idx FROM ed0)"""


def duck_sql(select: str) -> str:
    return with_fx(f"WITH {DUCK_BASE},\n{BOARD_SQL}\n{select}", "fx_positions")


def board_query(key: str, cols: str):
    select = f"SELECT p.pos_id, {cols} FROM fx_positions p JOIN feat a ON a.fen = p.fen JOIN efeat2 e ON e.fen = p.fen " \
             "JOIN codes c ON c.fen = p.fen JOIN sfeat x ON x.fen = p.fen"
    names = [c.strip().split(".")[1] for c in cols.split(",")]

    def fn(spark, sf):
        """In-row features of each distinct board, joined to its positions."""
        pos = fx_positions(spark, sf).select("pos_id", "fen")
        found = BF.features(BD.boards(pos)).withColumnRenamed("cues", "cues_all").select("fen", *names)
        return pos.join(found, "fen").select("pos_id", *names)
    fn.__name__ = f"q_{key}"
    register(key, duck_sql(select))(fn)


board_query("material_balance", "a.mat_w, a.mat_b, a.mat_diff, a.material_label")
board_query("position_phase", "a.n_pieces, a.phase")
board_query("endgame_type", "a.endgame_type")
board_query("opposite_bishops", "a.opposite_bishops")
board_query("pawn_islands", "a.islands_w, a.islands_b")
board_query("isolated_pawns", "a.isolated_w, a.isolated_b")
board_query("doubled_pawns", "a.doubled_w, a.doubled_b")
board_query("passed_pawns", "a.passed_w, a.passed_b")
board_query("pawn_majority", "a.majority_w, a.majority_b")
board_query("open_files", "a.open_files, a.half_open_stm")
board_query("king_exposed", "a.king_exposed_w, a.king_exposed_b")
board_query("undeveloped_minors", "a.undev_w, a.undev_b, a.development")
board_query("piece_cues", "a.bishop_pair_w, a.bishop_pair_b, a.bishop_pair_adv_stm, a.rook_7th_w, a.rook_7th_b, a.rook_open_w, a.rook_open_b")
board_query("attack_edges", "e.edges_w, e.edges_b")
board_query("hanging_pieces", "e.hanging_w, e.hanging_b, e.top_hanging")
board_query("check_status", "e.checkers, e.in_check, e.double_check")
board_query("fork_targets", "e.forks_w, e.forks_b")
board_query("pins", "e.pinned_stm, e.top_pinned")
board_query("ray_motifs", "e.skewers_w, e.skewers_b, e.xrays_w, e.xrays_b")
board_query("overloaded", "e.overloaded_w, e.overloaded_b")
board_query("back_rank", "e.back_rank_w, e.back_rank_b")
board_query("pawn_structure_code", "c.pawn_structure_code")
board_query("problem_code", "c.problem_code")
board_query("king_safety_code", "c.king_safety_code")
board_query("motif_rank", "c.top_motif")
board_query("positional_cues", "c.cues_all")
board_query("weak_squares", "x.weak_squares")
board_query("outposts", "x.outpost_w, x.outpost_b")
board_query("batteries", "x.battery_w, x.battery_b, x.batteries")
board_query("backward_pawns", "x.backward_w, x.backward_b")
