"""Move motifs against a plain Python statement of the rules, on random boards and
moves, and against hand-made moves."""

from __future__ import annotations

import random

from rookery.operators import board as BD
from rookery.operators.move_features import MOTIF_ORDER, move_features
from test_board_features import VALUE, attacks, color, expected, name, random_fen, read

OTHER = {"w": "b", "b": "w"}
order = lambda s: (s[1] - 1) * 8 + s[0]


def write(board, side):
    rows = []
    for r in range(8, 0, -1):
        row, gap = "", 0
        for f in range(8):
            if (f, r) in board:
                row, gap = row + (str(gap) if gap else "") + board[f, r], 0
            else:
                gap += 1
        rows.append(row + (str(gap) if gap else ""))
    return f"{'/'.join(rows)} {side} - - 0 20"


def pseudo(board, c):
    """Moves of ``c`` without castling and en passant."""
    for s in [s for s in board if color(board[s]) == c]:
        pawn = board[s].lower() == "p"
        for t, _ in attacks(board, s):
            if t in board and (color(board[t]) == c or board[t].lower() == "k") or pawn and t not in board:
                continue
            yield s, t
        if pawn:
            up = 1 if c == "w" else -1
            one, two = (s[0], s[1] + up), (s[0], s[1] + 2 * up)
            if 1 <= one[1] <= 8 and one not in board:
                yield s, one
                if s[1] == (2 if c == "w" else 7) and two not in board:
                    yield s, two


def hit_by(board, c):
    return {t for s in board if color(board[s]) == c for t, _ in attacks(board, s)}


def may_check(board, c):
    """A move gives check if the piece attacks the king from its new square (lines
    as they stand before the move), or if it lets a slider behind it through."""
    king = next((s for s, p in board.items() if p.lower() == "k" and color(p) != c), None)
    if king is None:
        return False
    for s, t in pseudo(board, c):
        kind = board[s].lower()
        kinds = ["q", "n"] if kind == "p" and t[1] in (1, 8) else [kind]
        for k in kinds:
            there = dict(board)
            there[t] = k.upper() if c == "w" else k
            if k != "k" and king in [x for x, _ in attacks(there, t)]:
                return True
        for x in [x for x in board if color(board[x]) == c and board[x].lower() in "rbq" and x != s]:
            for at, behind in attacks(board, x):
                if at == s and behind == king:
                    step = ((s[0] > x[0]) - (s[0] < x[0]), (s[1] > x[1]) - (s[1] < x[1]))
                    line = {(x[0] + step[0] * i, x[1] + step[1] * i) for i in range(1, 8)}
                    if t not in line:
                        return True
    return False


def threats(board, c):
    mine, theirs = hit_by(board, c), hit_by(board, OTHER[c])
    return int(may_check(board, c)) + sum(1 for s, p in board.items() if color(p) != c and s in mine and s not in theirs)


def play(board, s, t, promote="", passant=False):
    after = dict(board)
    p = after.pop(s)
    if passant:
        del after[t[0], s[1]]
    after[t] = (promote.upper() if p.isupper() else promote) if promote else p
    return after


def motifs(board, after, s, t, promote, passant):
    c = color(board[s])
    o = OTHER[c]
    kind, moved = board[s].lower(), after[t].lower()
    cap_at = (t[0], s[1]) if passant else t
    capture = cap_at in board and color(board[cap_at]) == o
    own_a, foe_a, own_b, foe_b = hit_by(after, c), hit_by(after, o), hit_by(board, c), hit_by(board, o)
    king = next((x for x, p in after.items() if p == ("k" if c == "w" else "K")), None)
    checkers = [x for x in after if color(after[x]) == c and king in [y for y, _ in attacks(after, x)]] if king else []
    check = bool(checkers)
    now_loose = lambda x: x in own_a and x not in foe_a
    hits = [x for x, _ in attacks(after, t) if x in after and color(after[x]) == o]
    before, later = expected(write(board, c)), expected(write(after, o))
    e = {"clearance": check and t not in checkers,
         "discovered_attack": any(x == s and behind and color(board[behind]) == o for y in board if color(board[y]) == c and board[y].lower() in "rbq"
                                  for x, behind in attacks(board, y))}
    cut = []
    if not capture and not promote:
        for y in board:
            if color(board[y]) == o and board[y].lower() in "rbq":
                for x, _ in attacks(board, y):
                    if x in board and color(board[x]) == o and board[x].lower() != "k" and now_loose(x):
                        step = ((x[0] > y[0]) - (x[0] < y[0]), (x[1] > y[1]) - (x[1] < y[1]))
                        at = (y[0] + step[0], y[1] + step[1])
                        while at != x:
                            if at == t:
                                cut.append((order(x), order(y), f"{board[x].lower()}{name(x)}/{board[y].lower()}{name(y)}"))
                            at = (at[0] + step[0], at[1] + step[1])
    e["interference"] = max(cut)[2] if cut else None
    freed = [x for x, _ in attacks(board, cap_at) if x in board and color(board[x]) == o and board[x].lower() != "k" and now_loose(x)] if capture else []
    best = min(freed, key=lambda x: (-VALUE[board[x].lower()], order(x)), default=None)
    e["deflection"] = f"{board[best].lower()}{name(best)}" if best else None
    hanging = t in foe_a and t not in own_a
    gift = (capture or check) and hanging and VALUE[kind] >= 3
    e["desperado"] = gift and s in foe_b and s not in own_b and capture and VALUE[board[cap_at].lower()] >= max(3, VALUE[kind] - 1)
    e["sacrifice"], e["decoy"] = gift and not e["desperado"], check and hanging
    e["zwischenzug"] = (capture or check) and before[f"hanging_{c}"] > 0
    met = min((x for x in hits if after[x].lower() in "nbrq"), key=order, default=None)
    home = s[1] <= 2 if c == "w" else s[1] >= 7
    e["tempo"] = None if not home else "check" if check else None if met is None else "heavy" if after[met].lower() in "qr" else "minor"
    e["threats_before"], e["threats_after"] = threats(board, o), threats(after, o)
    less = e["threats_before"] - e["threats_after"]
    e["prophylactic"] = "several" if less >= 2 else "one" if less == 1 else None
    rest = [(x, p.lower()) for x, p in after.items() if color(p) == c and x != t]
    column = lambda k: any(p == k and x[0] == t[0] for x, p in rest)
    slant = lambda k: any(p == k and abs(x[0] - t[0]) == abs(x[1] - t[1]) for x, p in rest)
    e["battery"] = ("rooks" if moved == "r" and column("r") else "queen_rook" if moved in "qr" and column("q") or moved == "q" and column("r")
                    else "queen_bishop" if moved in "qb" and slant("q") or moved == "q" and slant("b") else None)
    pawns = [x for x, p in after.items() if p.lower() == "p"]
    e["outpost"] = (moved == "n" and (t[1] >= 4 if c == "w" else t[1] <= 5) and any(color(after[x]) == c and t in [y for y, _ in attacks(after, x)] for x in pawns)
                    and not any(color(after[x]) == o and abs(x[0] - t[0]) == 1 and (x[1] > t[1] if c == "w" else x[1] < t[1]) for x in pawns))
    weak = name(t) in ("d5", "e5", "c5", "f5") if c == "w" else name(t) in ("d4", "e4", "c4", "f4")
    weak = weak and t in own_b and not any(board[x].lower() == "p" and color(board[x]) == o and t in [y for y, _ in attacks(board, x)] for x in board)
    castling = kind == "k" and abs(s[0] - t[0]) == 2 and s[1] == t[1]
    found = {"underpromotion": promote in ("n", "b", "r"), "en_passant": passant, "double_check": len(checkers) > 1,
             "fork": sum(1 for x in hits if after[x].lower() in "nbrq") > 1, "pin": later["pinned_stm"] > 0, "skewer": later[f"skewers_{c}"] > 0,
             "discovered_attack": e["discovered_attack"], "clearance": e["clearance"] and not e["discovered_attack"], "deflection": best is not None,
             "interference": bool(cut), "xray": later[f"xrays_{c}"] > 0, "desperado": e["desperado"], "sacrifice": e["sacrifice"], "decoy": e["decoy"],
             "overload": later[f"overloaded_{o}"] > 0, "back_rank": later[f"back_rank_{o}"], "zwischenzug": e["zwischenzug"], "weak_square": weak,
             "quiet": not (capture or check or promote or castling), "battery": e["battery"] is not None, "outpost": e["outpost"],
             "tempo": e["tempo"] is not None, "prophylactic": e["prophylactic"] is not None}
    e["motifs"] = [k for k in MOTIF_ORDER if found[k]]
    return e


def rows_of(spark, moves):
    """``moves``: (fen before, move, fen after)."""
    df = spark.createDataFrame([(i, a, u, b) for i, (a, u, b) in enumerate(moves)], "i int, bfen string, muci string, afen string")
    df = df.selectExpr("i", "bfen", "muci", "afen", "cast(null as string) ruci", "cast(null as string) rfen")
    fens = df.selectExpr("bfen as fen").unionByName(df.selectExpr("afen as fen")).distinct()
    return {r.i: r for r in move_features(df, BD.boards(fens)).collect()}


def random_moves(n):
    rng = random.Random(29)
    out = []
    while len(out) < n:
        fen = random_fen(rng)
        side = fen.split()[1]
        board = read(fen)
        options = [(s, t, False) for s, t in pseudo(board, side)]
        for s in [s for s in board if board[s].lower() == "p" and color(board[s]) == side]:
            for t, _ in attacks(board, s):
                beside = (t[0], s[1])
                if t not in board and t[1] not in (1, 8) and beside in board and board[beside].lower() == "p" and color(board[beside]) != side:
                    options += [(s, t, True)] * 8
        if not options:
            continue
        for s, t, passant in rng.sample(options, min(3, len(options))):
            promote = rng.choice("qqnrb") if board[s].lower() == "p" and t[1] in (1, 8) else ""
            after = play(board, s, t, promote, passant)
            out.append((board, after, s, t, promote, passant, side))
    return out


def test_random_moves(spark):
    cases = random_moves(600)
    rows = rows_of(spark, [(write(b, side), name(s) + name(t) + promote, write(a, OTHER[side])) for b, a, s, t, promote, _, side in cases])
    seen = set()
    for i, (b, a, s, t, promote, passant, side) in enumerate(cases):
        want = motifs(b, a, s, t, promote, passant)
        assert {k: rows[i][k] for k in want} == want, (write(b, side), name(s) + name(t) + promote)
        seen |= set(want["motifs"]) | {k for k in ("interference", "deflection") if want[k]}
    assert {"interference", "deflection", "sacrifice", "decoy", "zwischenzug", "tempo", "prophylactic", "xray", "clearance", "en_passant"} - seen <= {"clearance"}


GOLDEN = [
    # the knight steps between the rook on d8 and the knight that it holds on d4, which the rook on a4 attacks
    ("3rk3/8/8/8/R2n4/1N6/8/4K3 w - - 0 20", "b3d2", None, {"interference": None}),
    ("3rk3/8/8/2N5/R2n4/8/8/4K3 w - - 0 20", "c5d7", None, {"interference": "nd4/rd8", "motifs_1": "interference"}),
    ("3rk3/8/8/2N5/R2n4/8/8/4K3 w - - 0 20", "c5e6", None, {"interference": None, "motifs_1": "fork"}),
    # a capture is no interference, though it stands on the line
    ("3rk3/3p4/8/2N5/R2n4/8/8/4K3 w - - 0 20", "c5d7", None, {"interference": None}),
    # the bishop takes the knight that alone held the rook on d5
    ("4k3/8/5n2/3r4/8/8/8/B2QK3 w - - 0 20", "a1f6", None, {"deflection": "rd5", "desperado": False}),
    # en passant takes the pawn on d5, which held the rook on e4
    ("4k3/8/8/3pP3/4r3/8/8/4RK2 w - d6 0 20", "e5d6", "4k3/8/3P4/8/4r3/8/8/4RK2 b - - 0 20", {"deflection": "re4", "motifs_1": "en_passant"}),
    # a bishop gives itself for a knight; where the pawn on f7 attacks it, it was lost anyway
    ("3rk3/3n4/4B3/5p2/8/8/8/4K3 w - - 0 20", "e6d7", None, {"desperado": False, "sacrifice": True, "decoy": True}),
    ("3rk3/3n1p2/4B3/8/8/8/8/4K3 w - - 0 20", "e6d7", None, {"desperado": True, "sacrifice": False, "zwischenzug": True}),
    # castling gives check with the rook: not the moved king
    ("5k2/8/8/8/8/8/8/4K2R w K - 0 20", "e1g1", "5k2/8/8/8/8/8/8/5RK1 b - - 0 20", {"clearance": True, "discovered_attack": False}),
]


def test_golden_moves(spark):
    at = lambda x: ("abcdefgh".index(x[0]), int(x[1]))
    moves = [(fen, move, after or write(play(read(fen), at(move[:2]), at(move[2:4]), move[4:]), OTHER[fen.split()[1]]))
             for fen, move, after, _ in GOLDEN]
    rows = rows_of(spark, moves)
    for i, (fen, move, _, want) in enumerate(GOLDEN):
        assert {k: rows[i][k] for k in want} == want, (fen, move)
