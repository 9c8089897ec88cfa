"""Board and move features against a plain Python statement of the rules, on
the fixture boards and on random ones, and against hand-made rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rookery.operators import board as BD
from rookery.operators import board_features as BF
from rookery.sources.fixtures import FENS

VALUE = {"p": 1, "n": 3, "b": 3, "r": 5, "q": 9, "k": 0}
STRAIGHT, SLANTED = [(0, 1), (0, -1), (1, 0), (-1, 0)], [(1, 1), (1, -1), (-1, 1), (-1, -1)]
JUMPS = [(a, b) for a in (-2, -1, 1, 2) for b in (-2, -1, 1, 2) if abs(a) != abs(b)]


def read(fen):
    board = {}
    for r, row in enumerate(fen.split()[0].split("/")):
        f = 0
        for ch in row:
            if ch.isdigit():
                f += int(ch)
            else:
                board[f, 8 - r] = ch
                f += 1
    return board


def color(ch):
    return "w" if ch.isupper() else "b"


def name(sq):
    return "abcdefgh"[sq[0]] + str(sq[1])


def attacks(board, sq):
    """(target, piece behind the first piece on the line or None) for a piece."""
    kind, c = board[sq].lower(), color(board[sq])
    steps = {"n": JUMPS, "k": STRAIGHT + SLANTED, "p": [(-1, 1), (1, 1)] if c == "w" else [(-1, -1), (1, -1)]}.get(kind)
    if steps:
        return [((sq[0] + a, sq[1] + b), None) for a, b in steps if 0 <= sq[0] + a < 8 and 1 <= sq[1] + b <= 8]
    out = []
    for a, b in {"r": STRAIGHT, "b": SLANTED, "q": STRAIGHT + SLANTED}[kind]:
        line = [(sq[0] + a * i, sq[1] + b * i) for i in range(1, 8)]
        line = [x for x in line if 0 <= x[0] < 8 and 1 <= x[1] <= 8]
        met = [x for x in line if x in board]
        for x in line:
            out.append((x, met[1] if met and x == met[0] and len(met) > 1 else None))
            if x in board:
                break
    return out


def expected(fen):
    board, side, move = read(fen), fen.split()[1], int(fen.split()[5])
    hits = [(s, t, behind) for s in board for t, behind in attacks(board, s)]
    by = lambda t, c: sum(1 for s, x, _ in hits if x == t and color(board[s]) == c)
    other = {"w": "b", "b": "w"}
    order = lambda s: (s[1] - 1) * 8 + s[0]
    e = {"n_pieces": len(board), "phase": "endgame" if len(board) <= 10 else "opening" if move <= 10 else "middlegame"}
    pawns = {c: [s for s, p in board.items() if p.lower() == "p" and color(p) == c] for c in "wb"}
    files = {c: [sum(1 for s in pawns[c] if s[0] == f) for f in range(8)] for c in "wb"}
    loose = {s for s, p in board.items() if p.lower() != "k" and by(s, other[color(p)]) and not by(s, color(p))}
    king = next((s for s, p in board.items() if p.lower() == "k" and color(p) == side), None)
    e["checkers"] = by(king, other[side]) if king else 0
    e["open_files"] = "".join("abcdefgh"[f] for f in range(8) if files["w"][f] + files["b"][f] == 0)
    for c in "wb":
        o, up = other[c], 1 if c == "w" else -1
        e[f"mat_{c}"] = sum(VALUE[p.lower()] for p in board.values() if color(p) == c)
        e[f"islands_{c}"] = sum(1 for f in range(8) if files[c][f] and (f == 0 or not files[c][f - 1]))
        alone = [s for s in pawns[c] if not any(abs(x[0] - s[0]) == 1 for x in pawns[c])]
        e[f"isolated_{c}"] = name(min(alone, key=lambda s: (-up * s[1], s[0]))) if alone else None
        e[f"doubled_{c}"] = next(("abcdefgh"[f] for f in range(8) if files[c][f] > 1), None)
        free = [s for s in pawns[c] if not any(abs(x[0] - s[0]) <= 1 and up * (x[1] - s[1]) > 0 for x in pawns[o])]
        e[f"passed_{c}"] = name(min(free, key=order)) if free else None
        back = [s for s in pawns[c] if any(abs(x[0] - s[0]) == 1 for x in pawns[c])
                and not any(abs(x[0] - s[0]) == 1 and up * (x[1] - s[1]) <= 0 for x in pawns[c])
                and 1 <= s[1] + up <= 8 and (s[0], s[1] + up) not in board and by((s[0], s[1] + up), o) and not by((s[0], s[1] + up), c)]
        e[f"backward_{c}"] = name(min(back, key=lambda s: (up * s[1], s[0]))) if back else None
        e[f"hanging_{c}"] = sum(1 for s in loose if color(board[s]) == c)
        e[f"forks_{c}"] = sum(1 for s in board if color(board[s]) == c and sum(
            1 for t, _ in attacks(board, s) if t in board and color(board[t]) == o and board[t].lower() in "nbrq") >= 2)
        lines = [(s, t, x) for s, t, x in hits if color(board[s]) == c and x and color(board[x]) == o]
        e[f"skewers_{c}"] = sum(1 for s, t, x in lines if color(board[t]) == o and (
            board[t].lower() == "k" or VALUE[board[t].lower()] >= VALUE[board[x].lower()]))
        e[f"xrays_{c}"] = sum(1 for s, t, x in lines if board[x].lower() in "kq")
        e[f"overloaded_{c}"] = sum(1 for s in board if color(board[s]) == c and sum(
            1 for t, _ in attacks(board, s) if t in board and color(board[t]) == c and board[t].lower() != "k" and by(t, o)) >= 2)
        home = [s for s, p in board.items() if p.lower() == "k" and color(p) == c and s[1] == (1 if c == "w" else 8)]
        e[f"back_rank_{c}"] = any(not any(t not in board and not by(t, o) for t, _ in attacks(board, s)) for s in home)
    e["pinned_stm"] = sum(1 for s, t, x in hits if x and t in board and color(board[t]) == side and color(board[s]) != side
                          and board[x].lower() == "k" and color(board[x]) == side)
    return e


def random_fen(rng):
    squares = rng.sample([(f, r) for f in range(8) for r in range(1, 9)], rng.randrange(2, 26))
    board = dict(zip(squares, ["K", "k"] + [rng.choice("PPPPNBRQppppnbrq") for _ in squares[2:]]))
    rows = []
    for r in range(8, 0, -1):
        row, gap = "", 0
        for f in range(8):
            if (f, r) in board:
                row, gap = row + (str(gap) if gap else "") + board[f, r], 0
            else:
                gap += 1
        rows.append(row + (str(gap) if gap else ""))
    return f"{'/'.join(rows)} {rng.choice('wb')} - - 0 {rng.randrange(1, 40)}"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(17)
    fens = [f for _, f in FENS] + [random_fen(rng) for _ in range(150)]
    df = spark.createDataFrame([(f,) for f in fens], "fen string")
    return {r.fen: r for r in BF.features(BD.boards(df)).drop("pieces", "edges", "targets", "geo", "R0", "R1").collect()}


def test_features(rows):
    for fen, row in rows.items():
        want = expected(fen)
        assert {k: row[k] for k in want} == want, fen


START = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1"
GOLDEN = [
    (START, {"pawn_structure_code": "healthy", "problem_code": "no_problem", "king_safety_code": "both_safe", "top_motif": "back_rank",
             "cues": "bishop_pair", "development": "several", "material_label": "even", "opposite_bishops": False}),
    # a rook on the open d-file and on the seventh, the black king shut in on its back rank
    ("6k1/3R1ppp/8/8/8/8/5PPP/6K1 w - - 0 30", {"rook_open_w": "d", "rook_7th_w": True, "cues": "rook_open_d,weak_d5", "endgame_type": "rook endgame",
                                                "pawn_structure_code": "healthy", "majority_w": "kingside", "development": ""}),
    # the knight checks the king and attacks the rook in the corner
    ("r3k3/2N5/8/8/8/8/8/4K3 b - - 0 40", {"in_check": True, "forks_w": 0, "problem_code": "in_check,hanging", "top_hanging": "a8"}),
    # a bishop on b4 pins the knight on d2 to the king on e1
    ("4k3/8/8/8/1b6/8/3N4/4K3 w - - 0 45", {"pinned_stm": 1, "top_pinned": "d2", "top_motif": "pin"}),
    # white rooks doubled on the d-file
    ("3qk3/8/8/8/8/8/3R4/3RK3 w - - 0 33", {"battery_w": True, "batteries": "w_rooks", "hanging_b": 0, "endgame_type": "endgame"}),
    # a knight on d5, held by the pawn on e4, out of reach of black pawns
    ("4k3/pp3ppp/8/3N4/4P3/8/PP3PPP/4K3 w - - 0 20", {"outpost_w": "d5", "outpost_b": None, "passed_w": None}),
    # doubled and isolated pawns on the c-file
    ("4k3/5ppp/8/8/2P5/2P5/5PPP/4K3 w - - 0 20", {"isolated_w": "c4", "doubled_w": "c", "pawn_structure_code": "own_isolated", "islands_w": 2}),
]


@pytest.mark.parametrize("fen,want", GOLDEN)
def test_golden(spark, fen, want):
    row = BF.features(BD.boards(spark.createDataFrame([(fen,)], "fen string"))).select(*want).first()
    assert row.asDict() == want


def test_cues_and_motifs_can_be_widened(spark):
    fen = "6k1/3R1ppp/8/8/8/8/5PPP/6K1 w - - 0 30"
    df = BD.boards(spark.createDataFrame([(fen,)], "fen string"))
    wide = BF.with_codes(BF.with_attacks(BF.with_static(BF.with_edges(BF.with_pieces(df)))), max_cues=12).select(F.col("cues")).first()
    assert wide.cues.startswith("rook_open_d,") and "rook_7th" in wide.cues
