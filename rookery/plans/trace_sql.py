"""DuckDB statement of the trace assembly, separate from the Spark one.

Relations: ``tin`` (a position a row), ``tc`` (a pool candidate a row) and
``tpv`` (a ply of the best line a row). Constants and wording come from the
operators; the rules are written here as windows and joins.
"""

from __future__ import annotations

from rookery.operators import assembly as A
from rookery.operators.phrases import NOTES, POOLS

SEP = "chr(10) || chr(10)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def num(x: float) -> str:
    return f"{x}::DOUBLE"


def pick(pool: str, u: str) -> str:
    return f"[{', '.join(map(q, POOLS[pool]))}][CAST(floor({u} * {len(POOLS[pool])}) AS INT) + 1]"


def say(pool: str, u: str, **values: str) -> str:
    out = pick(pool, u)
    for name, value in values.items():
        out = f"replace({out}, '{{{name}}}', {value})"
    return out


def factor(column: str, factors: dict[str, float]) -> str:
    return "(CASE " + column + " " + " ".join(f"WHEN {q(k)} THEN {num(v)}" for k, v in factors.items()) + f" ELSE {num(1.0)} END)"


def gate(name: str) -> str:
    p = num(A.SECTION_PROBS[name])
    if name in A.SOURCE_MULT:
        p += " * " + factor("source", A.SOURCE_MULT[name])
    if name not in A.UNGATED:
        p += " * " + factor("style", A.STYLE_MULT)
    return f"u_{name} < least({num(1.0)}, {p})"


def tokens(x: str) -> str:
    return f"greatest(1, length({x}) - length(regexp_replace({x}, '[ \\n\\t]', '', 'g')) + 1, floor(length({x}) / 4))"


def _flag(name: str, have: str) -> str:
    p, best, _, styles = A.EXTRAS[name]
    return (f"CASE WHEN ({have}) AND u_cand_{name} < least({num(1.0)}, {num(p)} * {factor('style', styles)} * "
            f"(CASE WHEN uci = best_uci THEN {num(best)} ELSE {num(1.0)} END)) THEN 1 ELSE 0 END AS f_{name}")


def _capped(name: str) -> str:
    return (f"f_{name} = 1 AND sum(f_{name}) OVER (PARTITION BY pos_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
            f"<= {A.EXTRAS[name][2]} AS inc_{name}")


CAND_SQL = f"""tord AS (SELECT tc.*, tin.style, tin.best_uci, tin.best_wp, tin.top_motif,
  row_number() OVER (PARTITION BY tc.pos_id ORDER BY tc.u_ord, tc.uci) AS ord FROM tc JOIN tin ON tin.pos_id = tc.pos_id),
tflag AS (SELECT *, {_flag('pv', "pv <> ''")}, {_flag('motif', 'true')}, {_flag('trap', 'trap_kind IS NOT NULL')} FROM tord),
tcap AS (SELECT *, {_capped('pv')}, {_capped('motif')}, {_capped('trap')} FROM tflag),
tpara AS (SELECT pos_id, ord, uci, win_prob, uci || ': ' ||
  CASE WHEN mate_in > 0 THEN {pick('quality_mate', 'u_quality')} WHEN mate_in IS NOT NULL THEN {pick('quality_allows_mate', 'u_quality')}
       WHEN best_wp - win_prob <= 0.02::DOUBLE THEN {pick('quality_best', 'u_quality')}
       WHEN best_wp - win_prob <= 0.06::DOUBLE THEN {pick('quality_close', 'u_quality')}
       WHEN best_wp - win_prob <= 0.12::DOUBLE THEN {pick('quality_inferior', 'u_quality')} ELSE {pick('quality_bad', 'u_quality')} END || '.' ||
  CASE WHEN inc_pv THEN ' Line: ' || pv || '.' ELSE '' END ||
  CASE WHEN inc_motif THEN CASE WHEN top_motif IS NULL THEN ' It is rated ' || category || '.'
    ELSE ' Motif: ' || replace(top_motif, '_', ' ') || '.' END ELSE '' END ||
  CASE WHEN inc_trap THEN CASE WHEN trap_kind = 'trap' THEN ' It tempts, yet deeper search refutes it ('
    ELSE ' It looks odd, yet deeper search supports it (' END || confidence || ').' ELSE '' END AS para FROM tcap),
tparas AS (SELECT pos_id, count(*) AS n_cands, list(para ORDER BY ord) AS paras, list(uci ORDER BY ord) AS ucis,
  list(uci ORDER BY win_prob, ord)[1] AS worst_uci, list(uci ORDER BY win_prob DESC, ord)[1] AS top1,
  list(uci ORDER BY win_prob DESC, ord)[2] AS top2 FROM tpara GROUP BY pos_id),
tfail AS (SELECT pos_id, array_to_string(list(uci ORDER BY ord)[1:2], ',') AS failed_attempts FROM tord WHERE uci <> best_uci GROUP BY pos_id),
tline AS (SELECT pos_id, string_agg(uci || CASE WHEN forcing THEN ' (forcing)' ELSE '' END, '; ' ORDER BY n) AS line_text
  FROM tpv WHERE n <= {A.EXPLAIN_MAX_PLIES} GROUP BY pos_id)"""


def _theme(kind: str) -> str:
    return "(" + " OR ".join(f"contains(lower(themes), {q(m)})" for m in A.THEME_MARKERS[kind]) + ")"


def _size(prefix: str, code: str) -> str:
    return "(CASE " + code + " " + " ".join(f"WHEN {q(k[len(prefix):])} THEN {len(v)}" for k, v in POOLS.items() if k.startswith(prefix)) + " END)"


def _note(kind: str, code: str) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in NOTES[kind].items())
    return f"{{'u': u_note_{kind}, 't': CASE {code} {cases} END}}"


def _move(pool: str) -> str:
    return f"replace({pick(pool, 'u_concl_phrase')}, '{{move}}', best_uci)"


_PV = f"{num(A.PV_PROB)} * {factor('style', A.PV_STYLE)}"
_BALANCE = "(CASE WHEN mat_diff = 0 THEN 'even' WHEN mat_diff > 0 THEN 'white' ELSE 'black' END)"
_TEXTS = {
    "orientation": f"concat_ws(' ', CASE orientation_code WHEN 'opening' THEN {say('opens_opening', 'u_opens_phrase', name='opening_short')} "
                   f"WHEN 'endgame' THEN {say('opens_endgame', 'u_opens_phrase')} WHEN 'opening_phase' THEN {say('opens_phase', 'u_opens_phrase')} END, "
                   f"CASE source WHEN 'puzzle' THEN {pick('orient_puzzle', 'u_orient_phrase')} ELSE {pick('orient_game', 'u_orient_phrase')} END, "
                   f"{say('side_to_move', 'u_side_phrase', mover='mover')})",
    "opening_plan": say("plans_opening", "u_plans_phrase", family="family"),
    "fen_walkthrough": say("walkthrough", "u_walk_phrase", mover="mover", move="CAST(fullmove AS VARCHAR)"),
    "context_hint": "CASE context_code " + " ".join(f"WHEN '{k}' THEN {pick(f'context_{k}', 'u_ctx_phrase')}" for k in
                                                    ("mate", "endgame", "loose", "tactical", "generic")) + " END",
    "assessment": f"CASE WHEN tb_result IS NOT NULL THEN {say('tablebase', 'u_tb_phrase', result='tb_result')} WHEN assessment = 'balanced' THEN "
                  f"{pick('assess_balanced', 'u_assess_phrase')} WHEN assessment = 'better' THEN {pick('assess_better', 'u_assess_phrase')} "
                  f"WHEN assessment = 'worse' THEN {pick('assess_worse', 'u_assess_phrase')} ELSE {pick('assess_slight', 'u_assess_phrase')} END",
    "decision_profile": f"CASE WHEN forced_mate THEN {pick('profile_mate', 'u_profile_phrase')} WHEN only_move THEN {pick('profile_only', 'u_profile_phrase')} "
                        f"WHEN many_options THEN {pick('profile_many', 'u_profile_phrase')} ELSE {pick('profile_few', 'u_profile_phrase')} END",
    "static_eval": say("snapshot", "u_snap_phrase", notes="array_to_string(list_transform(list_sort(list_filter([" + ", ".join(
        (_note("material", _BALANCE), _note("structure", "pawn_structure_code"), _note("king", "king_safety_code"),
         _note("development", "development"))) + f"], lambda x: x.t IS NOT NULL))[1:{A.MAX_STATIC_NOTES}], lambda x: x.t), ' ')"),
    "endgame_technique": say("technique", "u_tech_phrase", type="endgame_type"),
    "threat_scan": f"CASE WHEN in_check THEN {pick('threat_check', 'u_threat_phrase')} WHEN hang_own > 0 THEN {pick('threat_loose', 'u_threat_phrase')} "
                   f"ELSE {pick('threat_none', 'u_threat_phrase')} END",
    "plan": say("plan", "u_plan_phrase", plan="replace(plan_option, '_', ' ')"),
    "opponent": pick("opponent", "u_opp_phrase"),
    "candidates": say("candidates", "u_cands_phrase", moves="coalesce(array_to_string(ucis, ', '), '')"),
    "avoid_blunder": say("avoid", "u_avoid_phrase", move="avoid_uci"),
    "exploration": f"array_to_string(paras, {SEP})",
    "reconsideration": pick("reconsider", "u_recon_phrase"),
    "dead_end": say("dead_end", "u_dead_phrase", move="worst_uci"),
    "comparison": say("compare", "u_cmp_phrase", first="top1", second="top2"),
    "conclusion": f"CASE conclusion_pool WHEN 'firm' THEN {_move('conclusion_firm')} WHEN 'soft' THEN {_move('conclusion_soft')} "
                  f"ELSE {_move('conclusion_default')} END || CASE WHEN pv_gate AND coalesce(line_text, '') <> '' THEN {say('main_line', 'u_line_phrase', line='line_text')} ELSE '' END",
}
_EXTRA = {"opening_plan": " AND opening_name IS NOT NULL", "endgame_technique": " AND phase = 'endgame'",
          "dead_end": " AND coalesce(n_cands, 0) >= 2", "comparison": " AND coalesce(n_cands, 0) >= 2"}


def _section(k: str) -> str:
    text = f"coalesce({_TEXTS[k]}, '')"
    return (f"CASE WHEN g_{k} THEN {text} ELSE '' END" if k in A.SECTION_PROBS else text) + f" AS s_{k}"


POS_SQL = f"""tcodes AS (SELECT tin.*, p.n_cands, p.paras, p.ucis, p.worst_uci, p.top1, p.top2, f.failed_attempts, l.line_text,
  CASE WHEN side = 'w' THEN 'White' ELSE 'Black' END AS mover,
  CASE WHEN forced_mate OR only_move THEN 'firm' WHEN many_options THEN 'soft' ELSE 'default' END AS conclusion_pool,
  CASE WHEN p.n_cands >= 3 THEN 'three_way' WHEN p.n_cands = 2 THEN 'two_way' ELSE 'quick' END AS decision_frame,
  CASE WHEN opening_name IS NOT NULL THEN 'opening' WHEN phase = 'endgame' THEN 'endgame' WHEN phase = 'opening'
    THEN 'opening_phase' ELSE 'middlegame' END AS orientation_code,
  CASE WHEN {_theme('mate')} OR (best_mate IS NOT NULL AND best_mate <> 0) THEN 'mate' WHEN {_theme('endgame')} OR phase = 'endgame'
    THEN 'endgame' WHEN {_theme('loose')} THEN 'loose' WHEN {_theme('tactical')} THEN 'tactical' ELSE 'generic' END AS context_code,
  list_filter([CASE WHEN (side = 'w' AND castling SIMILAR TO '.*[KQ].*') OR (side = 'b' AND castling SIMILAR TO '.*[kq].*') THEN 'castle' END,
    CASE WHEN passed_own THEN 'push_passed_pawn' END, CASE WHEN open_file THEN 'rook_to_open_file' END,
    CASE WHEN enemy_king_exposed THEN 'attack_king' END, 'improve_pieces'], lambda x: x IS NOT NULL) AS options,
  u_pv_gate < CASE WHEN forced_mate OR only_move THEN greatest({_PV}, {num(A.PV_FORCED_MIN)}) ELSE {_PV} END AS pv_gate
  FROM tin LEFT JOIN tparas p ON p.pos_id = tin.pos_id LEFT JOIN tfail f ON f.pos_id = tin.pos_id LEFT JOIN tline l ON l.pos_id = tin.pos_id),
tplan AS (SELECT *, options[CAST(floor(u_plan_pick * len(options)) AS INT) + 1] AS plan_option,
  CASE WHEN u_guess < {num(A.INITIAL_GUESS_BEST_PROB)} THEN best_uci ELSE ucis[CAST(floor(u_guess_pick * n_cands) AS INT) + 1] END
  AS initial_guess FROM tcodes),
tgates AS (SELECT *, {', '.join(f'{gate(k)}{_EXTRA.get(k, "")} AS g_{k}' for k in A.SECTION_PROBS)},
  CAST(floor(u_ctx_phrase * {_size('context_', 'context_code')}) AS INT) AS ctx_phrase_idx,
  CAST(floor(u_concl_phrase * {_size('conclusion_', 'conclusion_pool')}) AS INT) AS concl_phrase_idx FROM tplan),
tsec AS (SELECT *, {', '.join(_section(k) for k in A.SECTION_ORDER)} FROM tgates)"""


def _join(parts: list[str]) -> str:
    return f"concat_ws({SEP}, {', '.join(f'nullif({p}, {chr(39)}{chr(39)})' for p in parts)})"


ASSEMBLE_SQL = f"tsections AS (SELECT *, {_join([f's_{k}' for k in A.SECTION_ORDER])} AS assembled FROM tsec)"


#: Traces without a budget.
WHOLE_SQL = f"ttrim AS (SELECT *, assembled AS trimmed FROM (SELECT *, {_join([f's_{k}' for k in A.SECTION_ORDER])} AS assembled FROM tsec))"


def budget_sql(budget: int) -> str:
    """Tries every number of paragraphs, then every number of dropped sections."""
    text = _join([f"array_to_string(paras[1:j], {SEP})" if k == "exploration" else f"s_{k}" for k in A.SECTION_ORDER])
    drops = " UNION ALL ".join(
        f"SELECT pos_id, {d} AS d, {_join([f's_{k}' for k in A.SECTION_ORDER if k != 'exploration' and k not in A.DROP_ORDER[:d]])} AS t FROM tsec"
        for d in range(len(A.DROP_ORDER) + 1))
    return (f"tpop AS (SELECT pos_id, j, n, {text} AS t FROM (SELECT *, coalesce(len(paras), 0) AS n, unnest(range(0, coalesce(len(paras), 0) + 1)) AS j FROM tsec)), "
            f"tfit AS (SELECT pos_id, max(j) AS j, max(n) AS n, arg_max(t, j) AS t FROM tpop WHERE {tokens('t')} <= {budget} GROUP BY pos_id), "
            f"tdrop AS (SELECT pos_id, arg_min(t, d) AS t FROM ({drops}) WHERE {tokens('t')} <= {budget} GROUP BY pos_id), "
            "ttrim AS (SELECT s.*, CASE WHEN f.j = f.n THEN 'full' WHEN f.j IS NOT NULL THEN 'popped' WHEN d.t IS NOT NULL THEN 'dropped' "
            "ELSE 'conclusion' END AS stage, coalesce(f.t, d.t, s.s_conclusion) AS trimmed FROM tsec s "
            "LEFT JOIN tfit f ON f.pos_id = s.pos_id LEFT JOIN tdrop d ON d.pos_id = s.pos_id)")
