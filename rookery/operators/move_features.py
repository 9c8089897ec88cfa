"""Move features from the boards before the move, after it and after the reply
(SURVEY 2.8.1: 173-174, 2.10: 148-151).

Each distinct board's pieces and attacks are made once, inside its row
(:mod:`board_features`), and joined to the moves by position; the rules are
expressions over those arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.operators import board_features as BF

BOARD_COLUMNS = ["b", "side", "pieces", "edges", "in_check", "double_check", "hanging_w", "hanging_b", "open_files", "half_open_stm",
                 "forks_w", "forks_b", "skewers_w", "skewers_b", "pinned_stm", "xrays_w", "xrays_b", "overloaded_w", "overloaded_b",
                 "back_rank_w", "back_rank_b", "weak", "threats_w", "threats_b"]
# --- fixed values -----------------------------------------------------------
#: Order in which a move's motifs are named; those that need the solver or the wording are left out.
MOTIF_ORDER = ["underpromotion", "en_passant", "double_check", "fork", "pin", "skewer", "discovered_attack", "clearance", "deflection",
               "interference", "xray", "desperado", "sacrifice", "decoy", "overload", "back_rank", "zwischenzug", "weak_square", "quiet",
               "battery", "outpost", "tempo", "prophylactic"]
# --- end of fixed values -----------------------------------------------------


def _square(uci: str, at: int) -> str:
    """Board index of the square named at ``at`` in a coordinate move."""
    return f"int((8 - int(substr({uci}, {at + 1}, 1))) * 8 + ascii(substr({uci}, {at}, 1)) - 96)"


def move_features(moves: DataFrame, boards: DataFrame) -> DataFrame:
    """``moves``: ``muci, ruci, bfen, afen, rfen`` (reply columns null at the
    end of a line); ``boards``: ``fen, b, side, fullmove``. The reply's rules
    look at the mover's side."""
    found = BF.features(boards).select("fen", *BOARD_COLUMNS)

    def side(prefix: str, key: str) -> DataFrame:
        return found.select(F.col("fen").alias(key), *[F.col(c).alias(f"{prefix}_{c}") for c in BOARD_COLUMNS])

    m = (moves.join(side("b", "bfen"), "bfen").join(side("a", "afen"), "afen").join(side("r", "rfen"), "rfen", "left"))
    m = m.withColumns({
        "fi": F.expr(_square("muci", 1)), "ti": F.expr(_square("muci", 3)),
        "rti": F.expr(f"if(ruci is null, null, {_square('ruci', 3)})"), "mover": F.col("b_side")})
    m = m.withColumns({
        "pc": F.expr("lower(substr(b_b, fi, 1))"), "taken": F.expr("substr(b_b, ti, 1)"),
        "moved": F.expr("lower(substr(a_b, ti, 1))"), "lost": F.expr("if(rti is null, '.', lower(substr(a_b, rti, 1)))"),
        "hits": F.expr("filter(a_edges, e -> e.fi = ti and e.tc <> mover)"),
        "foes": F.expr("size(filter(a_edges, e -> e.to = ti and e.fc <> mover))"),
        "friends": F.expr("size(filter(a_edges, e -> e.to = ti and e.fc = mover))")})
    m = m.withColumns({
        "en_passant": F.expr("pc = 'p' and substr(muci, 1, 1) <> substr(muci, 3, 1) and taken = '.'"),
        "promotion": F.expr("length(muci) = 5"), "underpromotion": F.expr("length(muci) = 5 and substr(muci, 5, 1) in ('n', 'b', 'r')"),
        "castling": F.expr("pc = 'k' and abs(fi % 8 - ti % 8) = 2 and abs(fi - ti) = 2"),
        "gives_check": F.col("a_in_check"),
        "discovered_check": F.expr("exists(a_edges, e -> e.fc = mover and e.fi <> ti and e.tc is not null and e.tt = 'k' and e.tc <> mover)"),
        "hanging_after": F.expr("foes > 0 and friends = 0"),
        "discovered_attacks": F.expr("bigint(size(filter(a_edges, e -> e.fc = mover and e.fi <> ti and e.tc is not null and e.tc <> mover "
                                     "and not exists(b_edges, y -> y.fi = e.fi and y.to = e.to))))"),
        "new_targets": F.expr("bigint(size(hits))"),
        "best_target": F.expr(f"array_max(transform(filter(hits, e -> e.tt <> 'k'), e -> {BF._value('e.tt')}))")})
    own = "if(mover = 'w', {0}_hanging_w, {0}_hanging_b)"
    foe = "if(mover = 'w', {0}_hanging_b, {0}_hanging_w)"
    m = m.withColumns({
        "capture": F.expr("taken <> '.' or en_passant"),
        "threat_reduced": F.expr(f"{own.format('b')} > {own.format('a')}"),
        "threat_created": F.expr(f"{foe.format('a')} > {foe.format('b')}")})
    m = m.withColumn("quiet", F.expr("not (capture or gives_check or promotion or castling)"))
    file, square = "substr(muci, 3, 1)", "substr(muci, 3, 2)"
    centre = ", ".join(f"'{s}'" for s in BF.WEAK_SQUARES)
    pawn = "exists(a_edges, e -> e.to = ti and e.ft = 'p' and e.fc {0} mover)"
    post = (f"moved = 'n' and ({square} in ({centre}) or (if(mover = 'w', ti <= 32, ti > 32) and {pawn.format('=')} "
            f"and not {pawn.format('<>')}))")
    pressed = ", ".join(f"if(exists(a_edges, e -> e.fi = ti and e.to = {BF._idx(s)}), 'presses_{s}', null)" for s in BF.WEAK_SQUARES)
    targets = (f"array_compact(array(case when best_target >= 9 then 'targets_queen' when best_target >= 5 then 'targets_rook' "
               f"when best_target >= 3 then 'targets_minor' end, case when moved <> 'r' then null when instr(b_open_files, {file}) > 0 "
               f"then 'rook_open_file' when instr(b_half_open_stm, {file}) > 0 then 'rook_half_open_file' end, "
               f"if({post}, 'knight_post', null), try_element_at(array_compact(array({pressed})), 1)))")
    reply = ("case when ruci is null then null when lost <> '.' then 'loses_' || lost when r_in_check then 'allows_check' "
             f"when {own.format('r')} > 0 then 'leaves_hanging' when if(mover = 'w', r_forks_b, r_forks_w) > 0 then 'runs_into_fork' "
             "when r_pinned_stm > 0 then 'runs_into_pin' when if(mover = 'w', r_skewers_b, r_skewers_w) > 0 then 'runs_into_skewer' "
             "else 'generic' end")
    m = m.withColumns({"move_target": F.expr(f"if(quiet, array_join({targets}, ','), '')"), "blunder_outcome": F.expr(reply)})
    return with_motifs(m)


def with_motifs(m: DataFrame) -> DataFrame:
    """Motifs of a move from the board before it (``b_``) and after it (``a_``)."""
    foe = "if(mover = 'w', {0}_b, {0}_w)"
    own = "if(mover = 'w', {0}_w, {0}_b)"
    held = "exists(a_edges, y -> y.to = {x} and y.fc {who} mover)"
    lost = f"{held.format(x='e.to', who='=')} and not {held.format(x='e.to', who='<>')}"
    m = m.withColumn("geo", BF.geometry())
    m = m.withColumns({
        "clearance": F.expr("a_in_check and not exists(a_edges, e -> e.fi = ti and e.tc is not null and e.tt = 'k' and e.tc <> mover)"),
        "discovered_attack": F.expr("exists(b_edges, e -> e.fc = mover and e.ray and e.to = fi and e.sc is not null and e.sc <> mover)"),
        "cap_at": F.expr("if(en_passant, ti + if(mover = 'w', 8, -8), ti)"),
        "loose_before": F.expr("exists(b_edges, e -> e.to = fi and e.fc <> mover) and not exists(b_edges, e -> e.to = fi and e.fc = mover)"),
        # a slider's line to a piece that it alone held is cut by the moved piece
        "cut": F.expr("if(capture or promotion, null, array_max(transform(filter(b_edges, e -> e.fc <> mover and e.tc <> mover and e.tt <> 'k' and e.ray and "
                      f"{lost} and exists(concat(geo[e.fi - 1].orth, geo[e.fi - 1].diag), c -> array_position(c, ti) > 0 and "
                      f"array_position(c, e.to) > array_position(c, ti))), e -> named_struct('t', {BF._csq('e.to')}, 'd', {BF._csq('e.fi')}, 'tt', e.tt, 'dt', e.ft))))"),
    })
    m = m.withColumns({
        "cap_type": F.expr("if(capture, lower(substr(b_b, cap_at, 1)), null)"),
        "interference": F.expr(f"if(cut is null, null, cut.tt || {BF._name('cut.t')} || '/' || cut.dt || {BF._name('cut.d')})"),
        # what the captured piece held, and nobody holds any more
        "freed": F.expr("if(not capture, null, array_max(transform(filter(b_edges, e -> e.fi = cap_at and e.fc <> mover and e.tc <> mover and e.tt <> 'k' and "
                        f"{lost}), e -> named_struct('v', {BF._value('e.tt')}, 's', -{BF._csq('e.to')}, 'tt', e.tt))))")})
    given_up = f"(capture or gives_check) and hanging_after and {BF._value('pc')} >= 3"
    m = m.withColumns({
        "deflection": F.expr(f"if(freed is null, null, freed.tt || {BF._name('-freed.s')})"),
        "desperado": F.expr(f"coalesce({given_up} and loose_before and capture and {BF._value('cap_type')} >= greatest(3, {BF._value('pc')} - 1), false)"),
        "decoy": F.expr("gives_check and hanging_after"),
        "zwischenzug": F.expr(f"(capture or gives_check) and {own.format('b_hanging')} > 0")})
    at_home = "if(mover = 'w', fi > 48, fi <= 16)"
    met = f"array_min(transform(filter(hits, e -> e.tt in ('n', 'b', 'r', 'q')), e -> named_struct('s', {BF._csq('e.to')}, 't', e.tt))).t"
    there = "exists(a_pieces, p -> p.color = mover and p.idx <> ti and p.type = '{t}' and {on})"
    file = "p.file = (ti - 1) % 8"
    slant = "abs(p.file - (ti - 1) % 8) = abs(p.rank - (8 - int((ti - 1) div 8)))"
    battery = (f"case when moved = 'r' and {there.format(t='r', on=file)} then 'rooks' "
               f"when moved in ('q', 'r') and {there.format(t='q', on=file)} or moved = 'q' and {there.format(t='r', on=file)} then 'queen_rook' "
               f"when moved in ('q', 'b') and {there.format(t='q', on=slant)} or moved = 'q' and {there.format(t='b', on=slant)} then 'queen_bishop' end")
    rank = "(8 - int((ti - 1) div 8))"
    outpost = (f"moved = 'n' and if(mover = 'w', {rank} >= 4, {rank} <= 5) and exists(a_edges, e -> e.to = ti and e.ft = 'p' and e.fc = mover) and not "
               f"exists(a_pieces, p -> p.type = 'p' and p.color <> mover and abs(p.file - (ti - 1) % 8) = 1 and if(mover = 'w', p.rank > {rank}, p.rank < {rank}))")
    m = m.withColumns({
        "sacrifice": F.expr(f"{given_up} and not desperado"),
        "tempo": F.expr(f"case when not ({at_home}) then null when gives_check then 'check' when {met} in ('q', 'r') then 'heavy' when {met} is not null then 'minor' end"),
        "threats_before": F.expr(foe.format("b_threats")), "threats_after": F.expr(foe.format("a_threats")),
        "battery": F.expr(battery), "outpost": F.expr(outpost)})
    m = m.withColumn("prophylactic", F.expr("case when threats_before - threats_after >= 2 then 'several' when threats_before - threats_after = 1 then 'one' end"))
    found = {"underpromotion": "underpromotion", "en_passant": "en_passant", "double_check": "a_double_check",
             "fork": "size(filter(hits, e -> e.tt in ('n', 'b', 'r', 'q'))) >= 2", "pin": "a_pinned_stm > 0", "skewer": f"{own.format('a_skewers')} > 0",
             "discovered_attack": "discovered_attack", "clearance": "clearance and not discovered_attack", "deflection": "deflection is not null",
             "interference": "interference is not null", "xray": f"{own.format('a_xrays')} > 0", "desperado": "desperado", "sacrifice": "sacrifice",
             "decoy": "decoy", "overload": f"{foe.format('a_overloaded')} > 0", "back_rank": foe.format("a_back_rank"), "zwischenzug": "zwischenzug",
             "weak_square": "array_contains(b_weak, substr(muci, 3, 2))", "quiet": "quiet", "battery": "battery is not null", "outpost": "outpost",
             "tempo": "tempo is not null", "prophylactic": "prophylactic is not null"}
    m = m.withColumn("motifs", F.expr(f"array_compact(array({', '.join(f'if({found[k]}, {chr(39)}{k}{chr(39)}, null)' for k in MOTIF_ORDER)}))"))
    return m.withColumns({f"motifs_{n}": F.array_join(F.slice("motifs", 1, n), ",") for n in (1, 2, 3)})
