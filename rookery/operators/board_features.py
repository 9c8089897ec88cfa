"""Board features inside the row.

A board is one 64-character string, so its pieces, attacks and features are
array expressions over that row: no explode, no join and no shuffle per board.
Stages are projections; a query that selects a few features makes Spark drop
the others' columns. The attack geometry is one constant.

``features`` adds them to any frame with ``b`` (squares a8 to h1), ``side`` and
``fullmove``; callers deduplicate boards first where positions repeat.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.operators import board as BD

# --- fixed values -----------------------------------------------------------
# Squares checked for weakness, in order of preference.
WEAK_SQUARES = ["d4", "e4", "d5", "e5", "c4", "f4", "c5", "f5"]
MOTIF_ORDER = ["double_check", "fork", "pin", "skewer", "overloaded", "back_rank"]
MAX_POSITIONAL_CUES = 2
MAX_MOTIFS = 1
# --- end of fixed values -----------------------------------------------------

GEOMETRY_TYPE = ("array<struct<orth:array<array<int>>,diag:array<array<int>>,n:array<int>,k:array<int>,"
                 "wp:array<int>,bp:array<int>>>")


def geometry() -> Column:
    squares = [{"orth": [], "diag": [], "n": [], "k": [], "wp": [], "bp": []} for _ in range(64)]
    for i, kind, _, cells in BD.ray_rows():
        squares[i - 1][kind].append(cells)
    for i, kind, to in BD.leap_rows():
        squares[i - 1][kind].append(to)
    return F.from_json(F.lit(json.dumps(squares)), GEOMETRY_TYPE)


def _at(x: str) -> str:
    """What stands on a square: an entry of ``at_man``, as a substring is searched from the
    board's start each time."""
    return f"get(at_man, {x} - 1)"


def _color(x: str) -> str:
    return f"get(at_color, {x} - 1)"


def _type(x: str) -> str:
    return f"get(at_type, {x} - 1)"


def _value(t: str) -> str:
    return f"(case {t} when 'p' then 1 when 'n' then 3 when 'b' then 3 when 'r' then 5 when 'q' then 9 else 0 end)"


def _name(csq: str) -> str:
    """Square name of a 0-based square counted from a1."""
    return f"(substr('abcdefgh', int({csq}) % 8 + 1, 1) || string(int(int({csq}) div 8) + 1))"


def _csq(idx: str) -> str:
    return f"int((7 - ({idx} - 1) div 8) * 8 + ({idx} - 1) % 8)"


def _n(array: str, cond: str) -> str:
    return f"bigint(size(filter({array}, {cond})))"


def _idx(square: str) -> int:
    return BD.fen_index("abcdefgh".index(square[0]), int(square[1]))


def with_pieces(df: DataFrame) -> DataFrame:
    """``pieces``: the pieces, in board order. ``at_man``, ``at_color`` and ``at_type``
    have the character, colour and type of each square, null in the last two if empty."""
    df = df.withColumn("at_man", F.split("b", ""))
    df = df.withColumns({"at_color": F.expr("transform(at_man, s -> if(s = '.', null, if(s = upper(s), 'w', 'b')))"),
                         "at_type": F.expr("transform(at_man, s -> if(s = '.', null, lower(s)))")})
    return df.withColumn("pieces", F.expr(
        f"transform(filter(sequence(1, 64), i -> {_at('i')} <> '.'), i -> named_struct('idx', i, 'file', int((i - 1) % 8), "
        f"'rank', int(8 - (i - 1) div 8), 'csq', {_csq('i')}, 'color', {_color('i')}, 'type', {_type('i')}))"))


def with_edges(df: DataFrame) -> DataFrame:
    """``edges``: an entry for each square that a piece attacks; sliders stop at
    the first piece, and that entry names the next piece behind it. ``reach``: the
    attacked squares of each piece."""
    df = df.withColumn("geo", geometry())
    df = df.withColumn("R0", F.expr(
        "flatten(transform(pieces, p -> transform(case p.type when 'b' then geo[p.idx - 1].diag when 'r' then geo[p.idx - 1].orth "
        "when 'q' then concat(geo[p.idx - 1].orth, geo[p.idx - 1].diag) else array() end, c -> named_struct('p', p, 'c', c, "
        f"'hit', int(array_position(transform(c, x -> {_at('x')} <> '.'), true))))))"))
    df = df.withColumn("R1", F.expr(
        "transform(R0, r -> named_struct('p', r.p, 'hit', r.hit, 'reach', if(r.hit = 0, r.c, slice(r.c, 1, r.hit)), "
        f"'behind', if(r.hit = 0, null, try_element_at(filter(slice(r.c, r.hit + 1, 8), x -> {_at('x')} <> '.'), 1))))"))
    edge = (f"named_struct('fi', {{p}}.idx, 'fc', {{p}}.color, 'ft', {{p}}.type, 'ray', {{ray}}, 'to', {{x}}, 'tc', {_color('{x}')}, "
            f"'tt', {_type('{x}')}, 'sc', {{sc}}, 'st', {{st}})")
    last = "r.hit > 0 and j + 1 = r.hit and r.behind is not null"
    slides = edge.format(p="r.p", ray="true", x="x", sc=f"if({last}, {_color('r.behind')}, null)", st=f"if({last}, {_type('r.behind')}, null)")
    leaps = edge.format(p="p", ray="false", x="x", sc="cast(null as string)", st="cast(null as string)")
    df = df.withColumn("edges", F.expr(
        f"concat(flatten(transform(R1, r -> transform(r.reach, (x, j) -> {slides}))), flatten(transform(pieces, p -> transform("
        "case p.type when 'n' then geo[p.idx - 1].n when 'k' then geo[p.idx - 1].k when 'p' then if(p.color = 'w', geo[p.idx - 1].wp, "
        f"geo[p.idx - 1].bp) else array() end, x -> {leaps}))))"))
    # the same squares a piece, without what stands there: enough for most features, and far fewer values
    stop = lambda kind: (f"flatten(transform(geo[p.idx - 1].{kind}, c -> slice(c, 1, int(array_position("  # noqa: E731
                         f"concat(transform(c, x -> {_color('x')} is not null), array(true)), true)))))")
    df = df.withColumn("reach", F.expr(
        f"transform(pieces, p -> named_struct('color', p.color, 'type', p.type, 'cells', case p.type when 'b' then {stop('diag')} "
        f"when 'r' then {stop('orth')} when 'q' then concat({stop('orth')}, {stop('diag')}) when 'n' then geo[p.idx - 1].n "
        "when 'k' then geo[p.idx - 1].k when 'p' then if(p.color = 'w', geo[p.idx - 1].wp, geo[p.idx - 1].bp) "
        "else cast(array() as array<int>) end))"))
    # attacked squares by colour, and by pawns; lookups in them are plain array searches
    df = df.withColumns({f"A_{c}": F.expr(f"flatten(transform(filter(reach, r -> r.color = '{c}'), r -> r.cells))") for c in "wb"} | {
        f"Q_{c}": F.expr(f"flatten(transform(filter(reach, r -> r.color = '{c}' and r.type = 'p'), r -> r.cells))") for c in "wb"})
    own, foe = "if(p.color = 'w', A_w, A_b)", "if(p.color = 'w', A_b, A_w)"
    return df.withColumn("targets", F.expr(
        "transform(pieces, p -> named_struct('idx', p.idx, 'csq', p.csq, 'color', p.color, 'type', p.type, "
        f"'own', array_contains({own}, p.idx), 'foe', array_contains({foe}, p.idx), "
        "'own_p', array_contains(if(p.color = 'w', Q_w, Q_b), p.idx), 'foe_p', array_contains(if(p.color = 'w', Q_b, Q_w), p.idx)))"))


def _stm(w: str, b: str) -> Column:
    return F.expr(f"if(side = 'w', {w}, {b})")


def with_static(df: DataFrame) -> DataFrame:
    """Features that need the pieces only."""
    # pawns by colour, so that no pawn is held against all pieces
    df = df.withColumns({f"P_{c}": F.expr(f"filter(pieces, p -> p.type = 'p' and p.color = '{c}')") for c in "wb"})
    cols: dict[str, str] = {"n_pieces": "bigint(size(pieces))"}
    for c in "wb":
        cols[f"F{c}"] = f"transform(sequence(0, 7), f -> size(filter(P_{c}, p -> p.file = f)))"
        cols[f"K{c}"] = f"try_element_at(filter(pieces, p -> p.type = 'k' and p.color = '{c}'), 1)"
        cols[f"mat_{c}"] = f"aggregate(pieces, bigint(0), (a, p) -> a + if(p.color = '{c}', {_value('p.type')}, 0))"
        for t in "nbrq":
            cols[f"n_{t}{c}"] = f"size(filter(pieces, p -> p.type = '{t}' and p.color = '{c}'))"
        homes = BD.MINOR_HOMES[c]
        cols[f"undev_{c}"] = _n("pieces", f"p -> p.type in ('n', 'b') and p.color = '{c}' and p.idx in ({', '.join(str(_idx(h)) for h in homes)})")
        cols[f"rook_7th_{c}"] = f"exists(pieces, p -> p.type = 'r' and p.color = '{c}' and p.rank = {7 if c == 'w' else 2})"
    df = df.withColumns({k: F.expr(v) for k, v in cols.items()})

    cols = {"mat_diff": "mat_w - mat_b",
            "material_label": "case when mat_w = mat_b then 'even' else if(mat_w > mat_b, 'white', 'black') || "
                              "case abs(mat_w - mat_b) when 1 then '_pawn' when 2 then '_small' else '_material' end end",
            "phase": "case when n_pieces <= 10 then 'endgame' when fullmove <= 10 then 'opening' else 'middlegame' end",
            "open_files": "array_join(filter(transform(sequence(0, 7), f -> if(Fw[f] + Fb[f] = 0, substr('abcdefgh', f + 1, 1), '')), x -> x <> ''), '')",
            "opposite_bishops": "n_bw = 1 and n_bb = 1 and size(array_distinct(transform(filter(pieces, p -> p.type = 'b'), "
                                "p -> (p.file + p.rank) % 2))) = 2"}
    minors = "n_nw + n_nb + n_bw + n_bb"
    cols["endgame_type"] = (
        f"case when n_qw + n_qb > 0 then if(n_rw + n_rb = 0, 'queen endgame', 'endgame') "
        f"when n_rw + n_rb > 0 then if({minors} = 0, 'rook endgame', 'rook + minor endgame') "
        f"else if({minors} = 0, 'pawn endgame', 'minor-piece endgame') end")
    for c, o in ("wb", "bw"):
        up = ">" if c == "w" else "<"
        cols[f"islands_{c}"] = f"size(filter(sequence(0, 7), f -> F{c}[f] > 0 and (f = 0 or F{c}[f - 1] = 0)))"
        alone = f"filter(P_{c}, p -> not exists(P_{c}, x -> abs(x.file - p.file) = 1))"
        if c == "w":  # the most advanced, then the leftmost
            cols["I_w"] = f"array_max(transform({alone}, p -> named_struct('r', p.rank, 'f', -p.file)))"
        else:
            cols["I_b"] = f"array_min(transform({alone}, p -> named_struct('r', p.rank, 'f', p.file)))"
        cols[f"doubled_{c}"] = f"try_element_at(transform(filter(sequence(0, 7), f -> F{c}[f] >= 2), f -> substr('abcdefgh', f + 1, 1)), 1)"
        cols[f"S_{c}"] = (f"array_min(transform(filter(P_{c}, p -> not exists(P_{o}, x -> abs(x.file - p.file) <= 1 "
                          f"and x.rank {up} p.rank)), p -> p.csq))")
        q, k = f"(F{c}[0] + F{c}[1] + F{c}[2] + F{c}[3])", f"(F{c}[4] + F{c}[5] + F{c}[6] + F{c}[7])"
        cols[f"majority_{c}"] = f"case when {q} - {k} >= 2 then 'queenside' when {k} - {q} >= 2 then 'kingside' end"
        cols[f"half_{c}"] = (f"array_join(filter(transform(sequence(0, 7), f -> if(F{c}[f] = 0 and F{o}[f] > 0, "
                             "substr('abcdefgh', f + 1, 1), '')), x -> x <> ''), '')")
        home_end, step = (8, 1) if c == "w" else (1, -1)
        cols[f"king_exposed_{c}"] = (
            f"K{c} is not null and K{c}.rank <> {home_end} and size(filter(P_{c}, p -> p.rank = K{c}.rank + ({step}) "
            f"and abs(p.file - K{c}.file) <= 1)) < 2")
        cols[f"bishop_pair_{c}"] = f"n_b{c} >= 2"
        cols[f"L_{c}"] = (f"array_min(transform(filter(pieces, p -> p.type = 'r' and p.color = '{c}' and Fw[p.file] + Fb[p.file] = 0), "
                          "p -> p.csq))")
    df = df.withColumns({k: F.expr(v) for k, v in cols.items()})
    return df.withColumns({
        "isolated_w": F.expr("if(I_w is null, null, substr('abcdefgh', 1 - I_w.f, 1) || string(I_w.r))"),
        "isolated_b": F.expr("if(I_b is null, null, substr('abcdefgh', 1 + I_b.f, 1) || string(I_b.r))"),
        "passed_w": F.expr(f"if(S_w is null, null, {_name('S_w')})"), "passed_b": F.expr(f"if(S_b is null, null, {_name('S_b')})"),
        "rook_open_w": F.expr("if(L_w is null, null, substr('abcdefgh', L_w % 8 + 1, 1))"),
        "rook_open_b": F.expr("if(L_b is null, null, substr('abcdefgh', L_b % 8 + 1, 1))"),
        "half_open_stm": _stm("half_w", "half_b"),
        "bishop_pair_adv_stm": _stm("n_bw >= 2 and n_bb < 2", "n_bb >= 2 and n_bw < 2"),
        "development": F.expr("case when phase <> 'opening' then '' when if(side = 'w', undev_w, undev_b) >= 3 then 'several' "
                              "when if(side = 'w', undev_w, undev_b) <= 1 then 'complete' else 'some' end")})


def _threats(c: str, o: str) -> dict[str, str]:
    """``loose_to_<c>``: the other side's pieces, its king too, that ``c`` attacks
    and nobody defends. ``may_check_<c>``: whether a pseudo-move of ``c`` (no
    castling, no en passant) gives check, found from the other king: by the squares
    from which each kind of piece would attack it, or by a piece that stands between
    a slider and the king and can leave the line."""
    forward, last, home = (-8, "between 1 and 8", "between 49 and 56") if c == "w" else (8, "between 57 and 64", "between 9 and 16")
    king = f"K{o}.idx"
    line = lambda kind: (f"flatten(transform(geo[{king} - 1].{kind}, c -> if(exists(c, x -> {_at('x')} <> '.'), "  # noqa: E731
                         f"slice(c, 1, int(array_position(transform(c, x -> {_at('x')} <> '.'), true))), c)))")
    to = lambda squares, x: f"array_contains({squares}, {x})"
    orth, diag, leap, pawn = f"V_{o}.orth", f"V_{o}.diag", f"V_{o}.n", f"V_{o}.p"
    at = {"n": to(leap, "e.to"), "b": to(diag, "e.to"), "r": to(orth, "e.to"), "q": f"({to(orth, 'e.to')} or {to(diag, 'e.to')})"}
    promoted = lambda x: f"({x} {last} and ({to(orth, x)} or {to(diag, x)} or {to(leap, x)}))"
    free = f"(e.tc is null or (e.tc = '{o}' and e.tt <> 'k'))"
    direct = (f"exists(edges, e -> e.fc = '{c}' and case e.ft " + " ".join(f"when '{t}' then {free} and {x}" for t, x in at.items())
              + f" when 'p' then e.tc = '{o}' and e.tt <> 'k' and ({to(pawn, 'e.to')} or {promoted('e.to')}) else false end)")
    step, two = f"p.idx + ({forward})", f"p.idx + ({2 * forward})"
    push = (f"exists(pieces, p -> p.type = 'p' and p.color = '{c}' and {step} between 1 and 64 and {_at(step)} = '.' and ({to(pawn, step)} or {promoted(step)} "
            f"or (p.idx {home} and {_at(two)} = '.' and {to(pawn, two)})))")
    off = "not array_contains(filter(concat(geo[e.fi - 1].orth, geo[e.fi - 1].diag), c -> array_contains(c, e.to))[0], {x})"
    front = f"e.to + ({forward})"
    leaves = (f"(exists(edges, y -> y.fi = e.to and if(y.ft = 'p', y.tc = '{o}', y.tc is null or y.tc = '{o}') and coalesce(y.tt <> 'k', true) and {off.format(x='y.to')}) "
              f"or (e.tt = 'p' and {front} between 1 and 64 and {_at(front)} = '.' and {off.format(x=front)}))")
    discovered = f"exists(edges, e -> e.fc = '{c}' and e.ray and e.tc = '{c}' and e.sc = '{o}' and e.st = 'k' and {leaves})"
    seen = (f"if(K{o} is null, null, named_struct('orth', {line('orth')}, 'diag', {line('diag')}, 'n', geo[{king} - 1].n, "
            f"'p', geo[{king} - 1].{'bp' if c == 'w' else 'wp'}))")
    return {f"loose_to_{c}": f"bigint(size(filter(targets, t -> t.color = '{o}' and t.foe and not t.own)))",
            f"V_{o}": seen, f"may_check_{c}": f"K{o} is not null and ({direct} or {push} or {discovered})"}


def with_attacks(df: DataFrame) -> DataFrame:
    """Features that need the attacks (``edges``, ``targets``)."""
    cols: dict[str, str] = {
        "pinned": "filter(edges, e -> e.ray and e.tc is not null and e.tc <> e.fc and e.st = 'k' and e.sc = e.tc)",
        "loose": "filter(targets, t -> t.type <> 'k' and t.foe and not t.own)",
        "checkers": "bigint(coalesce(try_element_at(transform(filter(pieces, p -> p.type = 'k' and p.color = side), "
                    "p -> size(filter(if(side = 'w', A_b, A_w), x -> x = p.idx))), 1), 0))"}
    for c, o in ("wb", "bw"):
        cols[f"edges_{c}"] = _n("edges", f"e -> e.fc = '{c}'")
        cols[f"forks_{c}"] = _n("reach", f"r -> r.color = '{c}' and size(filter(r.cells, x -> {_color('x')} = '{o}' and {_type('x')} in ('n', 'b', 'r', 'q'))) >= 2")
        cols[f"skewers_{c}"] = _n("edges", f"e -> e.fc = '{c}' and e.ray and e.tc = '{o}' and e.sc = '{o}' and (e.tt = 'k' or {_value('e.tt')} >= {_value('e.st')})")
        cols[f"xrays_{c}"] = _n("edges", f"e -> e.fc = '{c}' and e.ray and e.tc is not null and e.sc = '{o}' and e.st in ('k', 'q')")
        cols[f"overloaded_{c}"] = _n("reach", f"r -> r.color = '{c}' and size(filter(r.cells, x -> {_color('x')} = '{c}' and {_type('x')} <> 'k' "
                                          f"and array_contains(A_{o}, x))) >= 2")
        home = 1 if c == "w" else 8
        cols[f"back_rank_{c}"] = (f"exists(pieces, p -> p.type = 'k' and p.color = '{c}' and p.rank = {home} and not exists(geo[p.idx - 1].k, "
                                  f"x -> {_at('x')} = '.' and not array_contains(A_{o}, x)))")
        half = "t.csq >= 32" if c == "w" else "t.csq < 32"
        cols[f"O_{c}"] = (f"array_min(transform(filter(targets, t -> t.color = '{c}' and t.type in ('n', 'b') and {half} and t.own_p and not t.foe_p), "
                          "t -> if(t.type = 'n', 0, 100) + t.csq))")
        pair = (f"exists(pieces, p -> p.color = '{c}' and p.type = '{{a}}' and exists(pieces, x -> x.color = '{c}' and x.type = '{{b}}' "
                "and x.idx <> p.idx and {on}))")
        cols[f"B_{c}"] = (f"array_compact(array(if({pair.format(a='r', b='r', on='x.file = p.file')}, '{c}_rooks', null), "
                          f"if({pair.format(a='q', b='r', on='x.file = p.file')}, '{c}_queen_rook', null), "
                          f"if({pair.format(a='q', b='b', on='abs(x.file - p.file) = abs(x.rank - p.rank)')}, '{c}_queen_bishop', null)))")
        back, step, sign = ("<=", -8, 1) if c == "w" else (">=", 8, -1)
        mate = "abs(x.file - p.file) = 1"
        front = f"p.idx + ({step})"
        cols[f"W_{c}"] = (f"array_min(transform(filter(P_{c}, p -> exists(P_{c}, x -> {mate}) "
                          f"and not exists(P_{c}, x -> {mate} and x.rank {back} p.rank) and {front} between 1 and 64 and {_at(front)} = '.' "
                          f"and array_contains(A_{o}, {front}) and not array_contains(A_{c}, {front})), "
                          f"p -> named_struct('r', p.rank * ({sign}), 'f', p.file)))")
        cols |= _threats(c, o)
    weak = []
    for s in WEAK_SQUARES:
        mover, other = ("w", "b") if int(s[1]) >= 5 else ("b", "w")
        weak.append(f"if(side = '{mover}' and array_contains(A_{mover}, {_idx(s)}) and not array_contains(Q_{other}, {_idx(s)}), '{s}', null)")
    cols["weak"] = f"array_compact(array({', '.join(weak)}))"
    df = df.withColumns({k: F.expr(v) for k, v in cols.items() if k.startswith("V_")})
    df = df.withColumns({k: F.expr(v) for k, v in cols.items() if not k.startswith("V_")})
    top_hang = "array_max(transform(loose, t -> named_struct('v', {v}, 'own', if(t.color = side, 1, 0), 'csq', t.csq))).csq"
    top_pin = "array_max(transform(filter(pinned, e -> e.tc = side), e -> named_struct('v', {v}, 'csq', {s}))).csq"
    for c in "wb":
        df = df.withColumn(f"threats_{c}", F.expr(f"loose_to_{c} + if(may_check_{c}, 1, 0)"))
    return df.withColumns({
        "hanging_w": F.expr(_n("loose", "t -> t.color = 'w'")), "hanging_b": F.expr(_n("loose", "t -> t.color = 'b'")),
        "top_hanging": F.expr(f"if(size(loose) = 0, null, {_name(top_hang.format(v=_value('t.type')))})"),
        "in_check": F.expr("checkers >= 1"), "double_check": F.expr("checkers >= 2"),
        "pinned_stm": F.expr(_n("pinned", "e -> e.tc = side")),
        "top_pinned": F.expr(f"if(exists(pinned, e -> e.tc = side), {_name(top_pin.format(v=_value('e.tt'), s=_csq('e.to')))}, null)"),
        "weak_squares": F.expr("array_join(weak, ',')"),
        "outpost_w": F.expr(f"if(O_w is null, null, {_name('O_w % 100')})"), "outpost_b": F.expr(f"if(O_b is null, null, {_name('O_b % 100')})"),
        "battery_w": F.expr("size(B_w) > 0"), "battery_b": F.expr("size(B_b) > 0"),
        "batteries": F.expr("array_join(concat(B_w, B_b), ',')"),
        "backward_w": F.expr("if(W_w is null, null, substr('abcdefgh', W_w.f + 1, 1) || string(W_w.r))"),
        "backward_b": F.expr("if(W_b is null, null, substr('abcdefgh', W_b.f + 1, 1) || string(-W_b.r))")})


def with_codes(df: DataFrame, max_cues: int = MAX_POSITIONAL_CUES, max_motifs: int = MAX_MOTIFS) -> DataFrame:
    """Choices that the wording rests on, for the side to move."""
    own = {k: f"if(side = 'w', {k}_w, {k}_b)" for k in ("isolated", "doubled", "backward", "islands", "passed", "outpost", "majority",
                                                       "rook_open", "rook_7th", "king_exposed", "hanging", "bishop_pair", "overloaded", "back_rank")}
    foe = {k: f"if(side = 'w', {k}_b, {k}_w)" for k in ("isolated", "doubled", "backward", "islands", "king_exposed", "forks", "skewers")}
    weakness = lambda s: f"coalesce({s['isolated']}, {s['doubled']}, {s['backward']}) is not null"
    structure = (f"case when {own['isolated']} is not null then 'own_isolated' when {own['doubled']} is not null then 'own_doubled' "
                 f"when {own['backward']} is not null then 'own_backward' when {own['islands']} > {foe['islands']} then 'more_islands' "
                 f"when {own['islands']} < {foe['islands']} then 'fewer_islands' when {weakness(foe)} then 'opponent_weakness' else 'healthy' end")
    problems = (f"slice(array_compact(array(if(in_check, 'in_check', null), if({own['hanging']} > 0, 'hanging', null), "
                f"if({own['king_exposed']}, 'king_exposed', null))), 1, 2)")
    king = (f"case when {own['king_exposed']} then 'own_exposed' when {foe['king_exposed']} then 'opponent_exposed' else 'both_safe' end")
    cond = {"double_check": "double_check", "fork": f"{foe['forks']} > 0", "pin": "pinned_stm > 0", "skewer": f"{foe['skewers']} > 0",
            "overloaded": f"{own['overloaded']} > 0", "back_rank": own["back_rank"]}
    motifs = f"slice(array_compact(array({', '.join(f'if({cond[m]}, {chr(39)}{m}{chr(39)}, null)' for m in MOTIF_ORDER)})), 1, {max_motifs})"
    cues = [f"if({own['bishop_pair']}, 'bishop_pair', null)"]
    cues += [f"'{p}' || {own[k]}" for p, k in (("rook_open_", "rook_open"),)]
    cues += ["'weak_' || try_element_at(weak, 1)"]
    cues += [f"'{p}' || {own[k]}" for p, k in (("passed_", "passed"), ("outpost_", "outpost"), ("isolated_", "isolated"),
                                               ("doubled_", "doubled"), ("backward_", "backward"))]
    cues += ["'half_open_' || nullif(substr(half_open_stm, 1, 1), '')", f"'majority_' || {own['majority']}",
             f"if({own['rook_7th']}, 'rook_7th', null)", f"if({own['king_exposed']}, 'exposed_king', null)"]
    return df.withColumns({
        "pawn_structure_code": F.expr(structure),
        "problem_code": F.expr(f"if(size({problems}) = 0, 'no_problem', array_join({problems}, ','))"),
        "king_safety_code": F.expr(king),
        "top_motif": F.expr(f"nullif(array_join({motifs}, ','), '')"),
        "cues": F.expr(f"array_join(slice(array_compact(array({', '.join(cues)})), 1, {max_cues}), ',')")})


def features(boards: DataFrame) -> DataFrame:
    """All board features of frames with ``b``, ``side`` and ``fullmove``."""
    return with_codes(with_attacks(with_static(with_edges(with_pieces(boards)))))
