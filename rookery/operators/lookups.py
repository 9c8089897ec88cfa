"""Position keys, opening book and endgame-table lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.functions.board import board64, fen_key, replay_states
from rookery.functions.text import UCI_MOVE, tokens, valid_prefix


def piece_count(fen) -> Column:
    c = F.col(fen) if isinstance(fen, str) else fen
    return F.length(F.regexp_replace(F.split_part(c, F.lit(" "), F.lit(1)), "[^a-zA-Z]", ""))


def estimate_ply(fen, default: int = 30) -> Column:
    """``2*(fullmove-1) + (side == 'b')`` clamped to [1, 200]; default when
    the FEN has fewer than six fields or a non-integer move number."""
    c = F.col(fen) if isinstance(fen, str) else fen
    full = F.split_part(c, F.lit(" "), F.lit(6))
    ok = (F.size(F.split(c, " ")) >= 6) & full.rlike(r"^[+-]?\d+$")
    ply = 2 * (F.when(ok, full.cast("bigint")) - 1) + F.when(F.split_part(c, F.lit(" "), F.lit(2)) == "b", 1) \
        .otherwise(0)
    return F.when(ok, F.greatest(F.lit(1), F.least(F.lit(200), ply)).cast("int")).otherwise(F.lit(default))


def square_name(idx: Column) -> Column:
    """1-based board index -> algebraic square."""
    f = (idx - 1) % 8
    r = 8 - F.floor((idx - 1) / 8).cast("int")
    return F.concat(F.char((f + 97).cast("int")), r.cast("string"))


def fen_fields(df: DataFrame, fen: str = "fen") -> DataFrame:
    c = F.col(fen)
    b = board64(c)
    part = lambda n: F.split_part(c, F.lit(" "), F.lit(n))
    rights = part(3)
    return df.select(
        "*",
        F.when(part(2) == "w", F.lit("white")).otherwise(F.lit("black")).alias("side"),
        part(6).cast("int").alias("fullmove"),
        part(5).cast("int").alias("halfmove"),
        rights.alias("castling"),
        F.instr(rights, "K").__gt__(0).alias("white_kingside"),
        F.instr(rights, "Q").__gt__(0).alias("white_queenside"),
        F.instr(rights, "k").__gt__(0).alias("black_kingside"),
        F.instr(rights, "q").__gt__(0).alias("black_queenside"),
        part(4).alias("en_passant"),
        F.when(F.instr(b, "K") > 0, square_name(F.instr(b, "K"))).alias("white_king"),
        F.when(F.instr(b, "k") > 0, square_name(F.instr(b, "k"))).alias("black_king"),
        (F.length(b) - F.length(F.replace(b, F.lit("Q"), F.lit("")))).alias("white_queens"),
        (F.length(b) - F.length(F.replace(b, F.lit("q"), F.lit("")))).alias("black_queens"),
    )


def fen_pieces(boards: DataFrame, fen: str = "fen") -> DataFrame:
    """One row per piece: square, file (0-7), rank (1-8), colour, type."""
    e = boards.select("*", F.posexplode(F.split(board64(fen), "")).alias("i0", "pc"))
    e = e.filter(F.col("pc") != ".")
    idx = F.col("i0") + 1
    return e.select(
        *[c for c in boards.columns],
        square_name(idx).alias("sq"),
        ((idx - 1) % 8).cast("int").alias("file"),
        (8 - F.floor((idx - 1) / 8)).cast("int").alias("rank"),
        F.when(F.col("pc") == F.upper("pc"), F.lit("w")).otherwise(F.lit("b")).alias("color"),
        F.lower("pc").alias("type"),
    )


def prefix_positions(lines: DataFrame, start_fen: str, moves: str = "moves",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Every prefix position of each line: ``(…, n_moves, fen)`` where
    ``n_moves`` = plies applied (0 = start). Replay stops at the first
    malformed move."""
    l = lines.withColumn("_mv", valid_prefix(tokens(F.coalesce(F.col(moves), F.lit(""))), UCI_MOVE))
    l = l.withColumn("_start", F.lit(start_fen))
    s = l.select(*keep, "_mv", replay_states("_start", "_mv").alias("_st"))
    return s.select(*keep, F.size("_mv").alias("line_len"),
                    F.posexplode("_st").alias("n_moves", "fen"))


def opening_index(book: DataFrame, start_fen: str) -> DataFrame:
    """Longest-prefix / last-wins index from ``book(eco, name, moves, load_ord)``.

    Identical lines are collapsed first (latest row wins), so each distinct
    line is replayed once; the per-key winner is a ``max_by`` aggregate,
    which combines map-side even when one position (the first moves of a
    popular opening) is shared by most lines."""
    last = book.groupBy("moves").agg(
        F.max_by(F.struct("eco", "name"), "load_ord").alias("_w"), F.max("load_ord").alias("load_ord"))
    lines = last.select(F.col("_w.eco").alias("eco"), F.col("_w.name").alias("name"), "moves", "load_ord")
    pp = prefix_positions(lines, start_fen, "moves", keep=("eco", "name", "moves", "load_ord"))
    pp = pp.filter(F.col("n_moves") >= 1).withColumn("key", fen_key("fen"))
    win = pp.groupBy("key").agg(F.max_by(
        F.struct("eco", "name", F.col("moves").alias("main_line"), F.col("n_moves").alias("move_count")),
        F.struct("n_moves", "load_ord")).alias("w"))
    return win.select("key", "w.eco", "w.name", "w.main_line", "w.move_count")
