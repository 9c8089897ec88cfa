"""Board replay as a higher-order fold.

A board is a 64-character string in FEN order (a8..h8, a7..h7, ..., a1..h1;
'.' for an empty square), so square ``(file f in 0..7, rank r in 1..8)``
sits at 1-based index ``(8 - r) * 8 + f + 1``.

``replay`` folds coordinate moves over ``(board, side, castling, en passant,
halfmove, fullmove)`` with ``aggregate`` -- one JVM-side expression, no
Python per row. Each step rebuilds the 64 squares with one CASE (moved piece,
promotion, en-passant victim, castling rook), so expression size stays linear.

The fold is rendered as SQL text for two dialects from one template: Spark
(used through ``F.expr``) and DuckDB (the oracle), so both engines run the
same rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


class Dialect:
    def __init__(self, name: str):
        self.name = name

    def struct(self, **kv) -> str:
        if self.name == "spark":
            return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in kv.items()) + ")"
        return "struct_pack(" + ", ".join(f"{k} := {v}" for k, v in kv.items()) + ")"

    def fold(self, arr: str, init: str, acc: str, x: str, body: str) -> str:
        if self.name == "spark":
            return f"aggregate({arr}, {init}, ({acc}, {x}) -> {body})"
        return f"list_reduce({arr}, lambda {acc}, {x}: {body}, {init})"

    def transform(self, arr: str, x: str, body: str) -> str:
        if self.name == "spark":
            return f"transform({arr}, {x} -> {body})"
        return f"list_transform({arr}, lambda {x}: {body})"

    def squares(self) -> str:
        return "sequence(1, 64)" if self.name == "spark" else "range(1, 65)"

    def join(self, arr: str, sep: str = "") -> str:
        if self.name == "spark":
            return f"array_join({arr}, '{sep}')"
        return f"array_to_string({arr}, '{sep}')"

    def replace_all(self, s: str, pat: str, rep: str) -> str:
        if self.name == "spark":
            return f"regexp_replace({s}, '{pat}', '{rep}')"
        return f"regexp_replace({s}, '{pat}', '{rep}', 'g')"

    def array(self, *items: str) -> str:
        if self.name == "spark":
            return "array(" + ", ".join(items) + ")"
        return "[" + ", ".join(items) + "]"

    def concat_arrays(self, a: str, b: str) -> str:
        return f"concat({a}, {b})" if self.name == "spark" else f"list_concat({a}, {b})"

    def empty_strings(self) -> str:
        return "CAST(array() AS ARRAY<STRING>)" if self.name == "spark" else "[]::VARCHAR[]"

    def set_char(self, s: str, pos: str, c: str) -> str:
        """Replace the character at 1-based ``pos``."""
        if self.name == "spark":
            return f"overlay({s}, {c}, {pos}, 1)"
        return f"concat(substr({s}, 1, {pos} - 1), {c}, substr({s}, {pos} + 1))"

    def last(self, arr: str) -> str:
        return f"element_at({arr}, -1)" if self.name == "spark" else f"list_extract({arr}, -1)"

    def int_(self, x: str) -> str:
        return f"CAST({x} AS INT)"


SPARK = Dialect("spark")
DUCK = Dialect("duck")


def expand_placement(d: Dialect, placement: str) -> str:
    """FEN piece placement -> 64-char board."""
    s = f"replace({placement}, '/', '')"
    for n in range(8, 0, -1):
        s = f"replace({s}, '{n}', '{'.' * n}')"
    return s


def compress_board(d: Dialect, board: str) -> str:
    """64-char board -> FEN piece placement: ranks joined by '/', then runs of
    '.' (which never cross a '/') become digits, longest first."""
    s = "concat_ws('/', " + ", ".join(f"substr({board}, {r * 8 + 1}, 8)" for r in range(8)) + ")"
    for n in range(8, 0, -1):  # plain replacement does the same as the pattern and costs less
        s = f"replace({s}, '{'.' * n}', '{n}')" if d.name == "spark" else d.replace_all(s, "[.]{" + str(n) + "}", str(n))
    return s


def _move_struct(d: Dialect, m: str) -> str:
    ff = f"(ascii(substr({m}, 1, 1)) - 97)"
    tf = f"(ascii(substr({m}, 3, 1)) - 97)"
    fr = d.int_(f"substr({m}, 2, 1)")
    tr = d.int_(f"substr({m}, 4, 1)")
    return d.struct(
        fi=f"((8 - {fr}) * 8 + {ff} + 1)", ti=f"((8 - {tr}) * 8 + {tf} + 1)",
        ff=ff, tf=tf, fr=fr, tr=tr, pr=f"substr({m}, 5, 1)")


def _step(d: Dialect, a: str, m: str) -> str:
    """New state after move struct ``m`` on state ``a``."""
    piece = f"substr({a}.b, {m}.fi, 1)"
    target = f"substr({a}.b, {m}.ti, 1)"
    pawn = f"(lower({piece}) = 'p')"
    epcap = f"({pawn} AND {m}.ff <> {m}.tf AND {target} = '.')"
    castle = f"(lower({piece}) = 'k' AND abs({m}.tf - {m}.ff) = 2)"
    placed = (f"(CASE WHEN {m}.pr <> '' THEN (CASE WHEN {piece} = 'P' THEN upper({m}.pr) ELSE lower({m}.pr) END)"
              f" ELSE {piece} END)")
    ep_sq = f"((8 - {m}.fr) * 8 + {m}.tf + 1)"
    sq = f"CASE WHEN i = {m}.fi THEN '.' WHEN i = {m}.ti THEN {placed} " \
         f"WHEN {epcap} AND i = {ep_sq} THEN '.' " \
         f"WHEN {castle} AND {m}.tf = 6 AND i = {m}.ti + 1 THEN '.' " \
         f"WHEN {castle} AND {m}.tf = 6 AND i = {m}.ti - 1 THEN substr({a}.b, {m}.ti + 1, 1) " \
         f"WHEN {castle} AND {m}.tf = 2 AND i = {m}.ti - 2 THEN '.' " \
         f"WHEN {castle} AND {m}.tf = 2 AND i = {m}.ti + 1 THEN substr({a}.b, {m}.ti - 2, 1) " \
         f"ELSE substr({a}.b, i, 1) END"
    if d.name == "spark":
        # a few O(1) edits per move instead of rebuilding all 64 squares
        b1 = d.set_char(d.set_char(f"{a}.b", f"{m}.fi", "'.'"), f"{m}.ti", placed)
        b2 = f"(CASE WHEN {epcap} THEN {d.set_char(b1, ep_sq, chr(39) + '.' + chr(39))} ELSE {b1} END)"
        king_side = d.set_char(d.set_char(b2, f"{m}.ti + 1", "'.'"), f"{m}.ti - 1", f"substr({a}.b, {m}.ti + 1, 1)")
        queen_side = d.set_char(d.set_char(b2, f"{m}.ti - 2", "'.'"), f"{m}.ti + 1", f"substr({a}.b, {m}.ti - 2, 1)")
        board = (f"(CASE WHEN {castle} AND {m}.tf = 6 THEN {king_side} WHEN {castle} AND {m}.tf = 2 "
                 f"THEN {queen_side} ELSE {b2} END)")
    else:
        board = d.join(d.transform(d.squares(), "i", sq))
    # castling rights lost: king moves, or a move from/to a rook corner
    corners = (f"(CASE WHEN {piece} = 'K' THEN 'KQ' ELSE '' END) || (CASE WHEN {piece} = 'k' THEN 'kq' ELSE '' END)"
               f" || (CASE WHEN {m}.fi = 64 OR {m}.ti = 64 THEN 'K' ELSE '' END)"
               f" || (CASE WHEN {m}.fi = 57 OR {m}.ti = 57 THEN 'Q' ELSE '' END)"
               f" || (CASE WHEN {m}.fi = 8 OR {m}.ti = 8 THEN 'k' ELSE '' END)"
               f" || (CASE WHEN {m}.fi = 1 OR {m}.ti = 1 THEN 'q' ELSE '' END)")
    rights = f"translate({a}.c, {corners} || '-', '')"
    ep = (f"(CASE WHEN {pawn} AND abs({m}.tr - {m}.fr) = 2 THEN "
          f"chr({m}.tf + 97) || CAST(CAST(({m}.fr + {m}.tr) / 2 AS INT) AS STRING) ELSE '-' END)")
    half = f"(CASE WHEN {pawn} OR {target} <> '.' THEN 0 ELSE {a}.h + 1 END)"
    full = f"(CASE WHEN {a}.s = 'b' THEN {a}.n + 1 ELSE {a}.n END)"
    side = f"(CASE WHEN {a}.s = 'w' THEN 'b' ELSE 'w' END)"
    return d.struct(b=board, s=side, c=rights, e=ep, h=half, n=full)


def _init(d: Dialect, fen: str) -> str:
    return d.struct(
        b=expand_placement(d, f"split_part({fen}, ' ', 1)"),
        s=f"split_part({fen}, ' ', 2)",
        c=f"replace(split_part({fen}, ' ', 3), '-', '')",
        e=f"split_part({fen}, ' ', 4)",
        h=d.int_(f"split_part({fen}, ' ', 5)"),
        n=d.int_(f"split_part({fen}, ' ', 6)"))


def _fen_of(d: Dialect, a: str) -> str:
    rights = f"(CASE WHEN {a}.c = '' THEN '-' ELSE {a}.c END)"
    return (f"concat_ws(' ', {compress_board(d, a + '.b')}, {a}.s, {rights}, {a}.e, "
            f"CAST({a}.h AS STRING), CAST({a}.n AS STRING))")


def replay_sql(d: Dialect, fen: str, moves: str) -> str:
    """Final FEN after applying coordinate ``moves`` (array) to ``fen``."""
    ms = d.transform(moves, "mv", _move_struct(d, "mv"))
    folded = d.fold(ms, _init(d, fen), "acc", "m", _step(d, "acc", "m"))
    return _fen_of(d, f"({folded})")


def replay_states_sql(d: Dialect, fen: str, moves: str) -> str:
    """Array of FENs: element k + 1 (1-based) is the position after k moves,
    element 1 the start. The accumulator is the list of states; each step
    reads the last one, so every move is computed once."""
    ms = d.transform(moves, "mv", _move_struct(d, "mv"))
    last = f"({d.last('acc')})"
    body = d.concat_arrays("acc", d.array(_step(d, last, "m")))
    states = d.fold(ms, d.array(_init(d, fen)), "acc", "m", body)
    return d.transform(states, "st", _fen_of(d, "st"))


def replay(fen: str, moves: str) -> Column:
    """Spark column: final FEN (``fen`` and ``moves`` are column names)."""
    return F.expr(replay_sql(SPARK, f"`{fen}`", f"`{moves}`"))


def replay_states(fen: str, moves: str) -> Column:
    return F.expr(replay_states_sql(SPARK, f"`{fen}`", f"`{moves}`"))


def fen_key_sql(d: Dialect, fen: str) -> str:
    """First four FEN fields (placement, side, castling, en passant)."""
    return f"concat_ws(' ', split_part({fen}, ' ', 1), split_part({fen}, ' ', 2), " \
           f"split_part({fen}, ' ', 3), split_part({fen}, ' ', 4))"


def fen_key(fen) -> Column:
    c = F.col(fen) if isinstance(fen, str) else fen
    return F.substring_index(c, " ", 4)


def board64(fen) -> Column:
    c = F.col(fen) if isinstance(fen, str) else fen
    s = F.replace(F.split_part(c, F.lit(" "), F.lit(1)), F.lit("/"), F.lit(""))
    for n in range(8, 0, -1):
        s = F.replace(s, F.lit(str(n)), F.lit("." * n))
    return s
