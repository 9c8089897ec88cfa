"""Deterministic chess-shaped views of the driver's tables.

Each ``fx_*`` builder is a lazy DataFrame over the parquet tables, so its
size grows with the scale factor. The DuckDB oracle gets the same views as
SQL text (``FX_SQL``), built from the same constants.

Key identities shared by all views:
  * a position is an order: ``pos_id = game_id = o_orderkey = l_orderkey``;
  * candidates of a position are its lineitems (up to ~13, uci unique);
  * every game replays one of 16 coordinate lines (``line_id = key % 16``);
  * a position stands on one of 20 boards (``fen_id = key % 20``) or, every
    eighth one, on a board made from it by keyed draws.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rookery.sources.tables import table


def plan_memo(fn):
    """Reuse the lazy DataFrame built for the same (session, folder).

    Only the logical plan object is shared -- nothing is cached or
    persisted, so every action still reads and computes in full; the saving
    is the driver-side construction and analysis of identical sub-plans that
    many queries start from."""
    import functools
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(spark, *args):
        key = (id(spark), spark.sparkContext.applicationId, *args)
        if key not in cache:
            cache[key] = fn(spark, *args)
        return cache[key]
    wrapper.cache = cache
    return wrapper

START_FEN = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1"

# --- fixed values -----------------------------------------------------------
# Lines 0-11: the twelve opening-book lines with their final positions
# (en-passant square written after every double pawn step). Lines 12-15 are
# test lines: castling both sides, en passant, promotion with capture, and an
# invalid token. The SAN movetext carries clock blocks, !? marks and a result
# so the movetext cleaner is exercised.
# (line_id, name, coordinate moves, SAN movetext, final FEN)
LINES = [
    (0, "Starting Position", "", "", START_FEN),
    (1, "Italian Game", "e2e4 e7e5 g1f3 b8c6 f1c4",
     "1. e4 { [%clk 0:05:00] } e5 { [%clk 0:05:00] } 2. Nf3 Nc6 3. Bc4 1-0",
     "r1bqkbnr/pppp1ppp/2n5/4p3/2B1P3/5N2/PPPP1PPP/RNBQK2R b KQkq - 3 3"),
    (2, "Sicilian Defense", "e2e4 c7c5", "1. e4 c5 0-1",
     "rnbqkbnr/pp1ppppp/8/2p5/4P3/8/PPPP1PPP/RNBQKBNR w KQkq c6 0 2"),
    (3, "Sicilian Najdorf", "e2e4 c7c5 g1f3 d7d6 d2d4 c5d4 f3d4 g8f6 b1c3 a7a6",
     "1. e4 c5 2. Nf3 d6 3. d4 cxd4 4. Nxd4 Nf6 5. Nc3 a6 1/2-1/2",
     "rnbqkb1r/1p2pppp/p2p1n2/8/3NP3/2N5/PPP2PPP/R1BQKB1R w KQkq - 0 6"),
    (4, "Queen's Gambit", "d2d4 d7d5 c2c4", "1. d4 d5 2. c4 *",
     "rnbqkbnr/ppp1pppp/8/3p4/2PP4/8/PP2PPPP/RNBQKBNR b KQkq c3 0 2"),
    (5, "King's Indian Defense", "d2d4 g8f6 c2c4 g7g6 b1c3 f8g7 e2e4 d7d6",
     "1. d4 Nf6 2. c4 g6 3. Nc3 Bg7! 4. e4 d6 1-0",
     "rnbqk2r/ppp1ppbp/3p1np1/8/2PPP3/2N5/PP3PPP/R1BQKBNR w KQkq - 0 5"),
    (6, "French Defense", "e2e4 e7e6 d2d4 d7d5 e4e5", "1. e4 e6 2. d4 d5 3. e5 0-1",
     "rnbqkbnr/ppp2ppp/4p3/3pP3/3P4/8/PPP2PPP/RNBQKBNR b KQkq - 0 3"),
    (7, "Caro-Kann Defense", "e2e4 c7c6 d2d4 d7d5 e4e5", "1. e4 c6 2. d4 d5 3. e5 1-0",
     "rnbqkbnr/pp2pppp/2p5/3pP3/3P4/8/PPP2PPP/RNBQKBNR b KQkq - 0 3"),
    (8, "Ruy Lopez", "e2e4 e7e5 g1f3 b8c6 f1b5", "1. e4 e5 2. Nf3 Nc6 3. Bb5 1/2-1/2",
     "r1bqkbnr/pppp1ppp/2n5/1B2p3/4P3/5N2/PPPP1PPP/RNBQK2R b KQkq - 3 3"),
    (9, "London System", "d2d4 d7d5 c1f4 g8f6 g1f3", "1. d4 d5 2. Bf4 Nf6 3. Nf3 0-1",
     "rnbqkb1r/ppp1pppp/5n2/3p4/3P1B2/5N2/PPP1PPPP/RN1QKB1R b KQkq - 3 3"),
    (10, "Scandinavian Defense", "e2e4 d7d5 e4d5", "1. e4 d5 2. exd5 1-0",
     "rnbqkbnr/ppp1pppp/8/3P4/8/8/PPPP1PPP/RNBQKBNR b KQkq - 0 2"),
    (11, "English Opening", "c2c4", "1. c4 *",
     "rnbqkbnr/pppppppp/8/8/2P5/8/PP1PPPPP/RNBQKBNR b KQkq c3 0 1"),
    (12, "Ruy Lopez Closed",
     "e2e4 e7e5 g1f3 b8c6 f1b5 a7a6 b5a4 g8f6 e1g1 f8e7 f1e1 b7b5 a4b3 d7d6 c2c3 e8g8",
     "1. e4 e5 2. Nf3 { [%clk 0:03:00] } Nc6 3. Bb5 a6 4. Ba4 Nf6 5. O-O Be7 "
     "6. Re1 b5 7. Bb3 d6 8. c3 O-O 1-0",
     None),
    (13, "Owen Defense", "e2e4 a7a6 e4e5 d7d5 e5d6 c7d6 g1f3 g8f6",
     "1. e4 a6 2. e5 d5 3. exd6!? cxd6?! 4. Nf3!! Nf6?? 0-1", None),
    (14, "Ward Gambit", "a2a4 b7b5 a4b5 a7a6 b5a6 c8b7 a6b7 h7h6 b7a8q",
     "1. a4 b5 2. axb5 a6 3. bxa6 Bb7 4. axb7 h6 5. bxa8=Q 1-0", None),
    (15, "Broken Line", "e2e4 e7e5 zzzz g1f3 b8c6 f1c4 f8c5 c2c3",
     "1. e4 e5 2. zzzz Nf3 3... Nc6 4. Bc4 Bc5 5. c3 *", None),
]

# Boards 0-11 are the final positions above; 12-19 exercise board analytics.
EXTRA_FENS = [
    (12, "8/5pk1/6p1/8/3B4/6P1/5PK1/3b4 w - - 0 40"),
    (13, "8/8/4k3/8/2P5/4K3/8/8 w - - 0 50"),
    (14, "6k1/5ppp/8/8/8/8/5PPP/3R2K1 w - - 0 30"),
    (15, "r3k2r/pp3ppp/2n2n2/2bqp3/8/2NP1N2/PPP1BPPP/R1BQ1RK1 w kq - 4 10"),
    (16, "4k3/8/8/8/1b6/8/3N4/4K3 w - - 0 45"),
    (17, "3qk3/8/8/8/8/8/3R4/3RK3 w - - 0 33"),
    (18, "6k1/4P3/8/8/8/8/8/6K1 w - - 0 60"),
    (19, "r1b1kbnr/pppp1ppp/2n5/4p3/2B1P2q/5N2/PPPP1PPP/RNBQK2R w KQkq - 4 4"),
]
# --- end of fixed values -----------------------------------------------------

FENS = [(i, fen) for i, _, _, _, fen in LINES if fen is not None] + EXTRA_FENS
UNSCORED_MOVES = ["h8h7", "h8g8", "h7h6"]


def _sql_str(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def _lines_df(spark: SparkSession) -> DataFrame:
    rows = [(i, n, u, s, f) for i, n, u, s, f in LINES]
    return spark.createDataFrame(
        rows, "line_id INT, name STRING, uci STRING, san STRING, fen STRING")


@plan_memo
def fx_lines(spark: SparkSession) -> DataFrame:
    """The 16-row line dimension (broadcast; size fixed by construction)."""
    return F.broadcast(_lines_df(spark))


@plan_memo
def fx_fens(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(FENS, "fen_id INT, fen STRING"))


@plan_memo
def fx_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("game_id"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (k % 5 == 0), F.lit("Time forfeit"))
        .when(k % 37 == 0, F.lit(None).cast("string")).otherwise(F.lit("Normal")).alias("termination"),
        F.when(k % 50 == 0, F.lit("*")).when(F.col("o_orderstatus") == "F", F.lit("1-0"))
        .when(F.col("o_orderstatus") == "O", F.lit("0-1")).otherwise(F.lit("1/2-1/2")).alias("result"),
        F.when(k % 41 == 0, F.lit(None).cast("string")).when(k % 43 == 0, F.lit("?"))
        .otherwise((700 + F.floor("o_totalprice").cast("bigint") % 1900).cast("string")).alias("white_elo"),
        (700 + (F.col("o_custkey") * 37) % 1900).cast("string").alias("black_elo"),
        (k % 16).cast("int").alias("line_id"),
        (k % 20).cast("int").alias("fen_id"),
    )


@plan_memo
def fx_game_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games with their movetext: ``movetext`` is missing for key%7 in {0,1}
    (NULL / empty), ``moves`` carries the fallback except for key%11=0."""
    g = fx_games(spark, sf_dir)
    lines = fx_lines(spark).select("line_id", F.col("san").alias("_san"))
    k = F.col("game_id")
    return g.join(lines, "line_id", "left").select(
        "game_id", "termination", "result", "white_elo", "black_elo", "line_id", "fen_id",
        F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 7 == 1, F.lit(""))
        .otherwise(F.col("_san")).alias("movetext"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("_san")).alias("moves"),
    )


@plan_memo
def fx_puzzles(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "value", "event_type", "ts")
    return e.select(
        F.col("event_id").alias("puzzle_id"),
        (600 + F.floor(F.col("value") * 10).cast("bigint") % 2400).cast("int").alias("rating"),
        F.when(F.col("event_type") == "view", "endgame long")
        .when(F.col("event_type") == "click", "fork middlegame")
        .when(F.col("event_type") == "purchase", "mateIn2 short")
        .when(F.col("event_type") == "signup", "opening")
        .otherwise("hangingPiece trappedPiece").alias("themes"),
        (F.col("event_id") % 16).cast("int").alias("line_id"),
        "ts",
    )


@plan_memo
def fx_puzzle_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Puzzles start from the initial board and play their line; the opening
    tag is the line name with spaces as underscores (NULL for test lines)."""
    p = fx_puzzles(spark, sf_dir)
    lines = fx_lines(spark).select("line_id", F.col("uci").alias("_uci"), F.col("name").alias("_name"))
    return p.join(lines, "line_id", "left").select(
        "puzzle_id", "rating", "themes",
        F.when(F.col("line_id") < 14, F.regexp_replace("_name", " ", "_")).alias("opening_tags"),
        F.lit(START_FEN).alias("fen"), F.col("_uci").alias("moves"), "line_id", "ts",
    )


@plan_memo
def _candidate_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the key is named pos_id before the window so the window's hash
    # partitioning is reused by every later per-position step
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("pos_id"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate", "l_returnflag")
    w = Window.partitionBy("pos_id").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    fp = F.floor("l_extendedprice").cast("bigint")
    r = li.select(
        "pos_id", "l_partkey", "l_suppkey", "l_returnflag",
        F.row_number().over(w).alias("slot"),
        (fp % 601 - 300).alias("cp0"),
        F.when((F.col("l_quantity") >= 45) & (fp % 10 == 0), 1 + fp % 3)
        .when(fp % 97 == 0, -1 - fp % 4).cast("int").alias("mate_in"),
    )
    slot, pk = F.col("slot"), F.col("l_partkey")
    uci = F.concat(
        F.char((97 + (slot - 1) % 8).cast("int")),
        (1 + F.floor((slot - 1) / 8).cast("bigint")).cast("string"),
        F.char((97 + pk % 8).cast("int")),
        (1 + F.floor(pk / 8).cast("bigint") % 8).cast("string"),
    )
    return r.select(
        "pos_id", "slot", uci.alias("uci"),
        F.when(F.col("mate_in") > 0, 30000).when(F.col("mate_in") < 0, -30000)
        .otherwise(F.col("cp0")).cast("int").alias("cp"),
        "mate_in",
        (F.col("cp0") + (pk * 13 + F.col("l_suppkey") * 7) % 401 - 200).cast("int").alias("shallow_cp"),
        (F.col("cp0") + pk % 81 - 40).cast("int").alias("confirm_cp"),
        (F.col("l_returnflag") == "R").alias("forcing"),
    )


@plan_memo
def fx_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidate_base(spark, sf_dir).drop("forcing")


@plan_memo
def fx_scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates, each also a ply of its position's line (``slot``, ``forcing``)."""
    return _candidate_base(spark, sf_dir)


@plan_memo
def fx_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Principal-variation plies: one per lineitem, ``ply = slot``."""
    return _candidate_base(spark, sf_dir).select(
        "pos_id", F.col("slot").alias("ply"), "uci", "forcing")


@plan_memo
def fx_valid_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legal moves per position: every scored candidate plus three unscored."""
    c = fx_candidates(spark, sf_dir).select("pos_id", "uci")
    extra = (c.select("pos_id").distinct()
             .select("pos_id", F.explode(F.array(*[F.lit(m) for m in UNSCORED_MOVES])).alias("uci")))
    return c.unionByName(extra)


@plan_memo
def fx_valid_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legal moves as one ordered array per position (scored by slot, then unscored)."""
    c = fx_candidates(spark, sf_dir)
    ordered = F.array_sort(F.collect_list(F.struct("slot", "uci")))
    return c.groupBy("pos_id").agg(F.concat(
        F.transform(ordered, lambda x: x["uci"]),
        F.array(*[F.lit(m) for m in UNSCORED_MOVES])).alias("valid_moves"))


BOARD_EDITS = 6


@plan_memo
def fx_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One position per game, on the board of ``fen_id``. In every eighth up to
    six men are put on other squares by keyed draws (kings stay, pawns keep off
    the end ranks), so different boards grow with the data."""
    from rookery.functions.board import SPARK, compress_board, expand_placement
    from rookery.functions.draws import hash_uniform
    g = fx_games(spark, sf_dir).select(F.col("game_id").alias("pos_id"), "fen_id")
    p = g.join(fx_fens(spark), "fen_id")
    edited = F.col("pos_id") % 8 == 1
    draws = F.array(*[hash_uniform(42, F.col("pos_id"), F.lit(f"board{j}")) for j in range(BOARD_EDITS)])
    p = p.withColumn("draws", F.when(edited, draws).otherwise(F.array().cast("array<double>")))
    board = F.expr(_edited_sql(SPARK, expand_placement(SPARK, "split_part(fen, ' ', 1)")))
    p = p.withColumn("b", F.when(edited, board))  # the others keep their text
    field = lambda i: F.split_part("fen", F.lit(" "), F.lit(i))
    moved = F.concat_ws(" ", F.expr(compress_board(SPARK, "b")), field(2), F.lit("-"), F.lit("-"), F.lit("0"), field(6))
    # never null, and known not to be: else a join by board repeats the edits to look for nulls
    return p.select("pos_id", "fen_id", F.coalesce(F.when(edited, moved).otherwise(F.col("fen")), F.lit("")).alias("fen"))


def _edited_sql(d, board: str) -> str:
    """Fold the draws over a board: each puts one man on another, empty square."""
    man, square = "substr(b, e.f, 1)", "substr(b, e.t, 1)"
    moves = d.transform("draws", "u", d.struct(f="CAST(floor(u * 64) AS INT) + 1", t="CAST(floor(u * 4096) AS INT) % 64 + 1"))
    edited = d.set_char(d.set_char("b", "e.f", "'.'"), "e.t", man)
    return d.fold(moves, board, "b", "e", f"CASE WHEN {man} NOT IN ('.', 'k', 'K') AND {square} = '.' AND "
                                          f"(lower({man}) <> 'p' OR (e.t >= 9 AND e.t <= 56)) THEN {edited} ELSE b END")


@plan_memo
def fx_rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight completions per prompt, built from whole document texts.

    ``form`` picks one of six completion shapes (five malformed ones)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    p = d.select(
        F.floor(F.col("doc_id") / 8).cast("bigint").alias("prompt_id"),
        (F.col("doc_id") % 8).alias("sample_id"),
        (F.col("doc_id") % 11).alias("form"),
        (1 + F.col("doc_id") % 5).alias("slot"),
        F.col("text").alias("body"),
    )
    c = fx_candidates(spark, sf_dir).select(F.col("pos_id").alias("prompt_id"), "slot", "uci")
    j = p.join(c, ["prompt_id", "slot"], "left")
    mv = F.coalesce(F.col("uci"), F.lit("a1a1"))
    body = F.col("body")
    completion = (
        F.when(F.col("form") == 0, F.concat(F.lit("<think>"), body, F.lit("</think>")))
        .when(F.col("form") == 1, F.concat(F.lit("<THINK>"), body, F.lit("</THINK><UCI_MOVE>"),
                                           F.upper(mv), F.lit("</UCI_MOVE>")))
        .when(F.col("form") == 2, F.concat(F.lit("<think>"), body, F.lit("</think> <uci_move> "),
                                           mv, F.lit(" </uci_move>")))
        .when(F.col("form") == 3, F.concat(F.lit("<think>"), body, F.lit("</think><uci_move>"), mv,
                                           F.lit("</uci_move><uci_move>h8h7</uci_move>")))
        .when(F.col("form") == 4, F.concat(F.lit("<think>"), body, F.lit("<uci_move>"), mv))
        .otherwise(F.concat(F.lit("<think>"), body, F.lit("</think><uci_move>"), mv, F.lit("</uci_move>")))
    )
    return j.select("prompt_id", "sample_id", mv.alias("uci"), completion.alias("completion"))


@plan_memo
def fx_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as ordered message arrays (one row per conversation)."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    msgs = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return c.groupBy("conv_id").agg(
        F.transform(msgs, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
        .alias("messages"))


# ---------------------------------------------------------------------------
# The same views as DuckDB SQL (CTE bodies), built from the constants above.
# ---------------------------------------------------------------------------

def _values(rows, cols) -> str:
    body = ",\n ".join("(" + ", ".join(
        str(v) if isinstance(v, int) else _sql_str(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(cols)})"


FX_SQL: dict[str, str] = {}
FX_DEPS: dict[str, list[str]] = {}

FX_SQL["fx_lines"] = _values(LINES, ["line_id", "name", "uci", "san", "fen"])
FX_SQL["fx_fens"] = _values(FENS, ["fen_id", "fen"])
FX_SQL["fx_games"] = """
SELECT o_orderkey AS game_id,
 CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 5 = 0 THEN 'Time forfeit'
      WHEN o_orderkey % 37 = 0 THEN NULL ELSE 'Normal' END AS termination,
 CASE WHEN o_orderkey % 50 = 0 THEN '*' WHEN o_orderstatus = 'F' THEN '1-0'
      WHEN o_orderstatus = 'O' THEN '0-1' ELSE '1/2-1/2' END AS result,
 CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN '?'
      ELSE CAST(700 + CAST(floor(o_totalprice) AS BIGINT) % 1900 AS VARCHAR) END AS white_elo,
 CAST(700 + (o_custkey * 37) % 1900 AS VARCHAR) AS black_elo,
 CAST(o_orderkey % 16 AS INT) AS line_id, CAST(o_orderkey % 20 AS INT) AS fen_id
FROM orders"""
FX_SQL["fx_game_records"] = """
SELECT g.game_id, g.termination, g.result, g.white_elo, g.black_elo, g.line_id, g.fen_id,
 CASE WHEN g.game_id % 7 = 0 THEN NULL WHEN g.game_id % 7 = 1 THEN '' ELSE l.san END AS movetext,
 CASE WHEN g.game_id % 11 = 0 THEN NULL ELSE l.san END AS moves
FROM fx_games g LEFT JOIN fx_lines l ON l.line_id = g.line_id"""
FX_DEPS["fx_game_records"] = ["fx_games", "fx_lines"]
FX_SQL["fx_puzzles"] = """
SELECT event_id AS puzzle_id,
 CAST(600 + CAST(floor(value * 10) AS BIGINT) % 2400 AS INT) AS rating,
 CASE event_type WHEN 'view' THEN 'endgame long' WHEN 'click' THEN 'fork middlegame'
   WHEN 'purchase' THEN 'mateIn2 short' WHEN 'signup' THEN 'opening'
   ELSE 'hangingPiece trappedPiece' END AS themes,
 CAST(event_id % 16 AS INT) AS line_id, ts
FROM events"""
FX_SQL["fx_puzzle_records"] = f"""
SELECT p.puzzle_id, p.rating, p.themes,
 CASE WHEN p.line_id < 14 THEN replace(l.name, ' ', '_') END AS opening_tags,
 '{START_FEN}' AS fen, l.uci AS moves, p.line_id, p.ts
FROM fx_puzzles p LEFT JOIN fx_lines l ON l.line_id = p.line_id"""
FX_DEPS["fx_puzzle_records"] = ["fx_puzzles", "fx_lines"]
FX_SQL["fx_cand_base"] = """
SELECT pos_id, slot,
 concat(chr(CAST(97 + (slot - 1) % 8 AS INT)),
        CAST(1 + CAST(floor((slot - 1) / 8) AS BIGINT) AS VARCHAR),
        chr(CAST(97 + l_partkey % 8 AS INT)),
        CAST(1 + CAST(floor(l_partkey / 8) AS BIGINT) % 8 AS VARCHAR)) AS uci,
 CAST(CASE WHEN mate_in > 0 THEN 30000 WHEN mate_in < 0 THEN -30000 ELSE cp0 END AS INT) AS cp,
 mate_in,
 CAST(cp0 + (l_partkey * 13 + l_suppkey * 7) % 401 - 200 AS INT) AS shallow_cp,
 CAST(cp0 + l_partkey % 81 - 40 AS INT) AS confirm_cp,
 l_returnflag = 'R' AS forcing
FROM (SELECT l_orderkey AS pos_id, l_partkey, l_suppkey, l_returnflag,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
     l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS INT) AS slot,
  CAST(floor(l_extendedprice) AS BIGINT) % 601 - 300 AS cp0,
  CAST(CASE WHEN l_quantity >= 45 AND CAST(floor(l_extendedprice) AS BIGINT) % 10 = 0
            THEN 1 + CAST(floor(l_extendedprice) AS BIGINT) % 3
            WHEN CAST(floor(l_extendedprice) AS BIGINT) % 97 = 0
            THEN -1 - CAST(floor(l_extendedprice) AS BIGINT) % 4 END AS INT) AS mate_in
  FROM lineitem) r"""
FX_SQL["fx_candidates"] = (
    "SELECT pos_id, slot, uci, cp, mate_in, shallow_cp, confirm_cp FROM fx_cand_base")
FX_DEPS["fx_candidates"] = ["fx_cand_base"]
FX_SQL["fx_pv"] = "SELECT pos_id, slot AS ply, uci, forcing FROM fx_cand_base"
FX_DEPS["fx_pv"] = ["fx_cand_base"]
FX_SQL["fx_valid_moves"] = (
    "SELECT pos_id, uci FROM fx_candidates UNION ALL "
    "SELECT pos_id, m.uci FROM (SELECT DISTINCT pos_id FROM fx_candidates) d, "
    "(VALUES " + ", ".join(f"('{m}')" for m in UNSCORED_MOVES) + ") m(uci)")
FX_DEPS["fx_valid_moves"] = ["fx_candidates"]
FX_SQL["fx_valid_list"] = (
    "SELECT pos_id, list(uci ORDER BY slot) || [" + ", ".join(f"'{m}'" for m in UNSCORED_MOVES)
    + "] AS valid_moves FROM fx_candidates GROUP BY pos_id")
FX_DEPS["fx_valid_list"] = ["fx_candidates"]


def _positions_sql() -> str:
    from rookery.functions.board import DUCK, compress_board, expand_placement
    from rookery.functions.draws import sql_uniform
    draws = ", ".join(sql_uniform(42, "g.game_id", f"'board{j}'") for j in range(BOARD_EDITS))
    base = ("SELECT g.game_id AS pos_id, g.fen_id, f.fen, " + expand_placement(DUCK, "split_part(f.fen, ' ', 1)") + f" AS b0, [{draws}] AS draws "
            "FROM fx_games g JOIN fx_fens f ON f.fen_id = g.fen_id")
    return (f"SELECT pos_id, fen_id, CASE WHEN pos_id % 8 <> 1 THEN fen ELSE {compress_board(DUCK, 'b')} || ' ' || split_part(fen, ' ', 2) "
            f"|| ' - - 0 ' || split_part(fen, ' ', 6) END AS fen FROM (SELECT *, {_edited_sql(DUCK, 'b0')} AS b FROM ({base}))")


FX_SQL["fx_positions"] = _positions_sql()
FX_DEPS["fx_positions"] = ["fx_games", "fx_fens"]
FX_SQL["fx_rollouts"] = """
SELECT p.prompt_id, p.sample_id, coalesce(c.uci, 'a1a1') AS uci,
 CASE p.form
  WHEN 0 THEN concat('<think>', p.body, '</think>')
  WHEN 1 THEN concat('<THINK>', p.body, '</THINK><UCI_MOVE>', upper(coalesce(c.uci,'a1a1')), '</UCI_MOVE>')
  WHEN 2 THEN concat('<think>', p.body, '</think> <uci_move> ', coalesce(c.uci,'a1a1'), ' </uci_move>')
  WHEN 3 THEN concat('<think>', p.body, '</think><uci_move>', coalesce(c.uci,'a1a1'), '</uci_move><uci_move>h8h7</uci_move>')
  WHEN 4 THEN concat('<think>', p.body, '<uci_move>', coalesce(c.uci,'a1a1'))
  ELSE concat('<think>', p.body, '</think><uci_move>', coalesce(c.uci,'a1a1'), '</uci_move>') END AS completion
FROM (SELECT CAST(floor(doc_id / 8) AS BIGINT) AS prompt_id, doc_id % 8 AS sample_id,
        doc_id % 11 AS form, 1 + doc_id % 5 AS slot, text AS body
      FROM documents) p
LEFT JOIN fx_candidates c ON c.pos_id = p.prompt_id AND c.slot = p.slot"""
FX_DEPS["fx_rollouts"] = ["fx_candidates"]
FX_SQL["fx_chat"] = """
SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS messages
FROM conversations GROUP BY conv_id"""


def with_fx(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs it needs (dependencies resolved)."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in FX_DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({FX_SQL[n]})" for n in order)
    sql = sql.strip()
    if sql[:4].upper() == "WITH":
        return f"WITH {ctes},\n{sql[4:].lstrip()}"
    return f"WITH {ctes}\n{sql}"
