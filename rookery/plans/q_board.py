"""Replay, FEN decoding, opening book and table lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.functions.board import DUCK, SPARK, board64, fen_key, replay, replay_sql, replay_states_sql
from rookery.functions.text import UCI_MOVE, parse_movetext, tokens, valid_prefix
from rookery.operators import lookups as L
from rookery.plans import sqlfrag as S
from rookery.plans.registry import register
from rookery.sources.fixtures import plan_memo
from rookery.sources import sinks
from rookery.sources.fixtures import (START_FEN, fx_game_records, fx_games, fx_lines, fx_positions,
                                      with_fx)

SF = S.q(START_FEN)


def sql_valid_prefix(toks: str) -> str:
    fi = S.first_invalid_index(toks, UCI_MOVE)
    return f"(CASE WHEN {fi} IS NULL THEN {toks} ELSE {toks}[1:{fi}] END)"


@plan_memo
def game_lines(spark, sf):
    """Games with their coordinate line (the line's moves)."""
    g = fx_games(spark, sf).select("game_id", "line_id")
    return g.join(fx_lines(spark).select("line_id", "name", F.col("uci").alias("line_uci")), "line_id")


GAME_LINES_SQL = ("gl AS (SELECT g.game_id, g.line_id, l.name, l.uci AS line_uci FROM fx_games g "
                  "JOIN fx_lines l ON l.line_id = g.line_id)")


@register("uci_replay", with_fx(
    f"WITH {GAME_LINES_SQL}, gm AS (SELECT game_id, line_id, "
    f"{sql_valid_prefix(S.tokens('line_uci'))} AS mv FROM gl) "
    f"SELECT game_id, line_id, CAST(len(mv) AS INT) AS n_applied, {replay_sql(DUCK, SF, 'mv')} AS final_fen FROM gm",
    "fx_games", "fx_lines"))
def q_uci_replay(spark, sf):
    g = game_lines(spark, sf).withColumn("mv", valid_prefix(tokens("line_uci"), UCI_MOVE))
    g = g.withColumn("start", F.lit(START_FEN))
    return g.select("game_id", "line_id", F.size("mv").alias("n_applied"), replay("start", "mv").alias("final_fen"))


@register("estimate_ply", with_fx(
    "SELECT pos_id, CASE WHEN len(string_split(fen, ' ')) >= 6 AND regexp_matches(split_part(fen, ' ', 6), "
    "'^[+-]?\\d+$') THEN CAST(greatest(1, least(200, 2 * (CAST(split_part(fen, ' ', 6) AS BIGINT) - 1) + "
    "CASE WHEN split_part(fen, ' ', 2) = 'b' THEN 1 ELSE 0 END)) AS INT) ELSE 30 END AS ply FROM fx_positions",
    "fx_positions"))
def q_estimate_ply(spark, sf):
    return fx_positions(spark, sf).select("pos_id", L.estimate_ply("fen").alias("ply"))


FEN_KEY_SQL = "concat_ws(' ', split_part(fen, ' ', 1), split_part(fen, ' ', 2), split_part(fen, ' ', 3), " \
              "split_part(fen, ' ', 4))"


@register("fen_key", with_fx(f"SELECT pos_id, {FEN_KEY_SQL} AS fen_key FROM fx_positions", "fx_positions"))
def q_fen_key(spark, sf):
    return fx_positions(spark, sf).select("pos_id", fen_key("fen").alias("fen_key"))


def _board_sql(fen: str) -> str:
    s = f"replace(split_part({fen}, ' ', 1), '/', '')"
    for n in range(8, 0, -1):
        s = f"replace({s}, '{n}', '{'.' * n}')"
    return s


def _sq_sql(idx: str) -> str:
    return f"(chr(CAST(({idx} - 1) % 8 + 97 AS INT)) || CAST(8 - CAST(floor(({idx} - 1) / 8) AS INT) AS VARCHAR))"


B = _board_sql("fen")


@register("fen_fields", with_fx(
    "SELECT pos_id, CASE WHEN split_part(fen, ' ', 2) = 'w' THEN 'white' ELSE 'black' END AS side, "
    "CAST(split_part(fen, ' ', 6) AS INT) AS fullmove, CAST(split_part(fen, ' ', 5) AS INT) AS halfmove, "
    "split_part(fen, ' ', 3) AS castling, strpos(split_part(fen, ' ', 3), 'K') > 0 AS white_kingside, "
    "strpos(split_part(fen, ' ', 3), 'Q') > 0 AS white_queenside, strpos(split_part(fen, ' ', 3), 'k') > 0 "
    "AS black_kingside, strpos(split_part(fen, ' ', 3), 'q') > 0 AS black_queenside, "
    "split_part(fen, ' ', 4) AS en_passant, "
    f"CASE WHEN strpos({B}, 'K') > 0 THEN {_sq_sql(f'strpos({B}, chr(75))')} END AS white_king, "
    f"CASE WHEN strpos({B}, 'k') > 0 THEN {_sq_sql(f'strpos({B}, chr(107))')} END AS black_king, "
    f"CAST(length({B}) - length(replace({B}, 'Q', '')) AS INT) AS white_queens, "
    f"CAST(length({B}) - length(replace({B}, 'q', '')) AS INT) AS black_queens FROM fx_positions",
    "fx_positions"))
def q_fen_fields(spark, sf):
    f = L.fen_fields(fx_positions(spark, sf))
    return f.select("pos_id", "side", "fullmove", "halfmove", "castling", "white_kingside", "white_queenside",
                    "black_kingside", "black_queenside", "en_passant", "white_king", "black_king",
                    "white_queens", "black_queens")


PIECES_SQL = f"""bd AS (SELECT DISTINCT fen FROM fx_positions),
bx AS (SELECT fen, CAST(i AS INT) AS idx, substr({B}, CAST(i AS INT), 1) AS pc FROM bd, range(1, 65) r(i)),
pieces AS (SELECT fen, {_sq_sql('idx')} AS sq, CAST((idx - 1) % 8 AS INT) AS file,
  CAST(8 - floor((idx - 1) / 8) AS INT) AS rank, CASE WHEN pc = upper(pc) THEN 'w' ELSE 'b' END AS color,
  lower(pc) AS type FROM bx WHERE pc <> '.')"""


def board_pieces(spark, sf):
    """Pieces of each distinct board (positions deduped before the explode)."""
    boards = fx_positions(spark, sf).select("fen").distinct()
    return L.fen_pieces(boards)


@register("fen_pieces", with_fx(
    f"WITH {PIECES_SQL} SELECT p.pos_id, x.sq, x.file, x.rank, x.color, x.type FROM fx_positions p "
    "JOIN pieces x ON x.fen = p.fen", "fx_positions"))
def q_fen_pieces(spark, sf):
    pos = fx_positions(spark, sf).select("pos_id", "fen")
    return pos.join(board_pieces(spark, sf), "fen").select("pos_id", "sq", "file", "rank", "color", "type")


@register("distinct_positions", with_fx(
    f"WITH {PIECES_SQL}, pc AS (SELECT fen, CAST(count(*) AS INT) AS n_pieces FROM pieces GROUP BY fen) "
    "SELECT p.pos_id, pc.n_pieces FROM fx_positions p JOIN pc ON pc.fen = p.fen", "fx_positions"))
def q_distinct_positions(spark, sf):
    """Expensive per-board work runs once per distinct FEN, then joins back."""
    pc = board_pieces(spark, sf).groupBy("fen").agg(F.count(F.lit(1)).cast("int").alias("n_pieces"))
    return fx_positions(spark, sf).select("pos_id", "fen").join(pc, "fen").select("pos_id", "n_pieces")


# ---- opening book -------------------------------------------------------------

@plan_memo
def opening_book(spark, sf):
    """Book rows derived from the games (one per game; load order = game id)."""
    g = game_lines(spark, sf).filter(F.col("line_uci") != "")
    return g.select(F.concat(F.lit("A"), F.lpad(F.col("line_id").cast("string"), 2, "0")).alias("eco"),
                    "name", F.col("line_uci").alias("moves"), F.col("game_id").alias("load_ord"))


BOOK_SQL = f"""{GAME_LINES_SQL},
bk AS (SELECT 'A' || lpad(CAST(line_id AS VARCHAR), 2, '0') AS eco, name, line_uci AS moves, game_id AS load_ord
  FROM gl WHERE line_uci <> ''),
bl AS (SELECT moves, arg_max(eco, load_ord) AS eco, arg_max(name, load_ord) AS name, max(load_ord) AS load_ord
  FROM bk GROUP BY moves),
bs AS (SELECT *, {replay_states_sql(DUCK, SF, sql_valid_prefix(S.tokens('moves')))} AS sts FROM bl),
bx AS (SELECT eco, name, moves, load_ord, unnest(sts) AS fen, CAST(unnest(range(len(sts))) AS INT) AS n_moves FROM bs),
bk2 AS (SELECT {FEN_KEY_SQL} AS key, eco, name, moves, load_ord, n_moves FROM bx WHERE n_moves >= 1),
oidx AS (SELECT key, eco, name, moves AS main_line, n_moves AS move_count FROM
  (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n_moves DESC, load_ord DESC) AS rn FROM bk2) WHERE rn = 1)"""


@register("opening_index", with_fx(
    f"WITH {BOOK_SQL} SELECT key, eco, name, main_line, move_count FROM oidx", "fx_games", "fx_lines"))
def q_opening_index(spark, sf):
    return L.opening_index(opening_book(spark, sf), START_FEN)


@register("opening_lookup", with_fx(
    f"WITH {BOOK_SQL}, "
    f"gd AS (SELECT DISTINCT line_uci FROM gl), "
    f"gs AS (SELECT line_uci, {replay_states_sql(DUCK, SF, sql_valid_prefix(S.tokens('line_uci')))} AS sts FROM gd), "
    f"gx AS (SELECT line_uci, unnest(sts) AS fen, CAST(unnest(range(len(sts))) AS INT) AS ply, len(sts) AS n FROM gs), "
    f"gp AS (SELECT line_uci, ply, {FEN_KEY_SQL} AS key FROM gx WHERE ply < n - 1) "
    "SELECT gl.game_id, gp.ply, o.eco, o.name, o.move_count FROM gl JOIN gp ON gp.line_uci = gl.line_uci "
    "LEFT JOIN oidx o ON o.key = gp.key", "fx_games", "fx_lines"))
def q_opening_lookup(spark, sf):
    """Position keys of every ply, left-joined to the opening index. The join
    side is data-derived, so AQE picks broadcast only from measured size."""
    idx = L.opening_index(opening_book(spark, sf), START_FEN)
    g = game_lines(spark, sf)
    lines = g.select("line_uci").distinct()
    pp = L.prefix_positions(lines, START_FEN, "line_uci", keep=("line_uci",))
    pp = pp.filter(F.col("n_moves") < F.col("line_len")).select(
        "line_uci", F.col("n_moves").alias("ply"), fen_key("fen").alias("key"))
    j = g.select("game_id", "line_uci").join(pp, "line_uci").join(idx, "key", "left")
    return j.select("game_id", "ply", "eco", "name", "move_count")


@register("openings_load", with_fx(
    f"WITH {GAME_LINES_SQL}, r AS (SELECT g.game_id, 'A' || lpad(CAST(g.line_id AS VARCHAR), 2, '0') AS eco, "
    "g.name, CASE WHEN g.game_id % 3 = 0 THEN 'uci' WHEN g.game_id % 3 = 1 THEN 'pgn' ELSE 'moves' END AS fmt, "
    "CASE WHEN g.game_id % 3 = 0 THEN g.line_uci ELSE l.san END AS txt "
    "FROM gl g JOIN fx_lines l ON l.line_id = g.line_id) "
    f"SELECT game_id AS load_ord, eco, name, fmt, array_to_string(CASE WHEN fmt = 'uci' THEN {S.tokens('txt')} "
    f"ELSE {S.parse_movetext('txt')} END, ' ') AS moves FROM r WHERE txt <> ''", "fx_games", "fx_lines"))
def q_openings_load(spark, sf):
    """Writes a header-addressed TSV book (uci / pgn / moves columns) from the
    games, reads it back and resolves the move column: uci, else pgn, else moves."""
    g = game_lines(spark, sf).join(fx_lines(spark).select("line_id", "san"), "line_id")
    k = F.col("game_id") % 3
    book = g.select(
        F.concat(F.lit("A"), F.lpad(F.col("line_id").cast("string"), 2, "0")).alias("eco"), "name",
        F.when(k == 0, F.col("line_uci")).alias("uci"),
        F.when(k == 1, F.col("san")).alias("pgn"),
        F.when(k == 2, F.col("san")).alias("moves"),
        F.col("game_id").alias("load_ord"))
    path = sinks.scratch_path(spark, "openings")
    sinks.write_tsv(book, path)
    r = sinks.read_tsv(spark, path, schema=book.schema)
    fmt = (F.when(F.coalesce(F.col("uci"), F.lit("")) != "", F.lit("uci"))
           .when(F.coalesce(F.col("pgn"), F.lit("")) != "", F.lit("pgn"))
           .when(F.coalesce(F.col("moves"), F.lit("")) != "", F.lit("moves")))
    txt = F.coalesce(F.nullif(F.col("uci"), F.lit("")), F.nullif(F.col("pgn"), F.lit("")),
                     F.nullif(F.col("moves"), F.lit("")))
    r = r.select("load_ord", "eco", "name", fmt.alias("fmt"), txt.alias("txt")).filter(F.col("fmt").isNotNull())
    mv = F.when(F.col("fmt") == "uci", tokens("txt")).otherwise(parse_movetext("txt"))
    return r.select("load_ord", "eco", "name", "fmt", F.array_join(mv, " ").alias("moves"))


# ---- endgame table --------------------------------------------------------------

TB_SQL = f"""pk AS (SELECT pos_id, {FEN_KEY_SQL} AS key,
  CAST(length(regexp_replace(split_part(fen, ' ', 1), '[^a-zA-Z]', '', 'g')) AS INT) AS n_pieces FROM fx_positions),
tb AS (SELECT DISTINCT key, CAST(n_pieces % 3 AS INT) - 1 AS wdl, n_pieces * 2 AS dtz FROM pk
  WHERE n_pieces <= 7 AND length(key) % 2 = 0)"""


def tablebase(spark, sf, positions=None):
    """WDL table over the small-material boards (derived, keyed by FEN key), of
    ``positions`` if they are there already."""
    p = (fx_positions(spark, sf) if positions is None else positions).select(fen_key("fen").alias("key"), L.piece_count("fen").alias("n_pieces"))
    p = p.filter((F.col("n_pieces") <= 7) & (F.length("key") % 2 == 0)).distinct()
    return p.select("key", ((F.col("n_pieces") % 3) - 1).cast("int").alias("wdl"),
                    (F.col("n_pieces") * 2).alias("dtz"))


@register("endgame_table_lookup", with_fx(
    f"WITH {TB_SQL} SELECT pk.pos_id, pk.n_pieces, CASE WHEN tb.wdl > 0 THEN 'winning' WHEN tb.wdl < 0 THEN 'losing' "
    "WHEN tb.wdl = 0 THEN 'drawing' END AS tb_result, tb.dtz FROM pk LEFT JOIN tb ON tb.key = pk.key "
    "AND pk.n_pieces <= 7", "fx_positions"))
def q_endgame_table_lookup(spark, sf):
    p = fx_positions(spark, sf).select("pos_id", fen_key("fen").alias("key"), L.piece_count("fen").alias("n_pieces"))
    tb = tablebase(spark, sf)
    j = p.join(tb, (p.key == tb.key) & (p.n_pieces <= 7), "left")
    res = F.when(F.col("wdl") > 0, "winning").when(F.col("wdl") < 0, "losing").when(F.col("wdl") == 0, "drawing")
    return j.select("pos_id", "n_pieces", res.alias("tb_result"), "dtz")
