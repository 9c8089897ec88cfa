"""Board analytics as relational jobs.

Boards are deduplicated by FEN first (positions repeat heavily), exploded to
one row per piece, and joined to a static geometry table (rays for sliders,
leaps for knights/kings/pawns; ~1.8k rows generated from movement rules,
broadcast). A slider's attacked squares are found inside the row by scanning
its ray against the 64-character board string, so no occupancy join or
shuffle is needed to build the attack edges; only the final per-board
aggregates group by FEN.

Feature rules are plain SQL aggregate expressions shared by Spark
(``F.expr``) and the DuckDB oracle, so both engines evaluate one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.functions.board import board64

# --- fixed values -----------------------------------------------------------
PIECE_VALUES = {"p": 1, "n": 3, "b": 3, "r": 5, "q": 9, "k": 0}
ORTHO = [(0, 1), (0, -1), (1, 0), (-1, 0)]
DIAG = [(1, 1), (1, -1), (-1, 1), (-1, -1)]
KNIGHT = [(1, 2), (2, 1), (2, -1), (1, -2), (-1, -2), (-2, -1), (-2, 1), (-1, 2)]
KING = ORTHO + DIAG
MINOR_HOMES = {"w": ["b1", "g1", "c1", "f1"], "b": ["b8", "g8", "c8", "f8"]}
# --- end of fixed values -----------------------------------------------------


def fen_index(f: int, r: int) -> int:
    """file 0-7, rank 1-8 -> 1-based index in FEN order."""
    return (8 - r) * 8 + f + 1


def ray_rows():
    rows = []
    for i in range(1, 65):
        f, r = (i - 1) % 8, 8 - (i - 1) // 8
        for kind, dirs in (("orth", ORTHO), ("diag", DIAG)):
            for d, (df, dr) in enumerate(dirs):
                cells = []
                for s in range(1, 8):
                    ff, rr = f + df * s, r + dr * s
                    if 0 <= ff < 8 and 1 <= rr <= 8:
                        cells.append(fen_index(ff, rr))
                if cells:
                    rows.append((i, kind, f"{kind}{d}", cells))
    return rows


def leap_rows():
    rows = []
    for i in range(1, 65):
        f, r = (i - 1) % 8, 8 - (i - 1) // 8
        for kind, deltas in (("n", KNIGHT), ("k", KING), ("wp", [(-1, 1), (1, 1)]), ("bp", [(-1, -1), (1, -1)])):
            for df, dr in deltas:
                ff, rr = f + df, r + dr
                if 0 <= ff < 8 and 1 <= rr <= 8:
                    rows.append((i, kind, fen_index(ff, rr)))
    return rows


def rays(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(ray_rows(), "from_idx INT, kind STRING, dir STRING, cells ARRAY<INT>"))


def leaps(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(leap_rows(), "from_idx INT, kind STRING, to_idx INT"))


def boards(positions: DataFrame) -> DataFrame:
    """Distinct boards with the 64-char board string and side to move.

    A board is few bytes and much work, so they are dealt over as many tasks as a
    shuffle has: by their bytes AQE would put all boards into one or two tasks."""
    n = int(positions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b = positions.select("fen").distinct().repartition(n)
    return b.select("fen", board64("fen").alias("b"), F.split_part("fen", F.lit(" "), F.lit(2)).alias("side"),
                    F.split_part("fen", F.lit(" "), F.lit(6)).cast("int").alias("fullmove"))


def pieces(bd: DataFrame) -> DataFrame:
    e = bd.select("fen", "b", "side", "fullmove", F.posexplode(F.split("b", "")).alias("i0", "pc"))
    e = e.filter(F.col("pc") != ".")
    idx = (F.col("i0") + 1).cast("int")
    file = ((idx - 1) % 8).cast("int")
    rank = (8 - F.floor((idx - 1) / 8)).cast("int")
    value = F.lit(0)
    for t, v in PIECE_VALUES.items():
        value = F.when(F.lower("pc") == t, F.lit(v)).otherwise(value)
    return e.select(
        "fen", "b", "side", "fullmove", idx.alias("idx"), file.alias("file"), rank.alias("rank"),
        F.concat(F.char((file + 97).cast("int")), rank.cast("string")).alias("sq"),
        ((rank - 1) * 8 + file).cast("int").alias("csq"),
        F.when(F.col("pc") == F.upper("pc"), F.lit("w")).otherwise(F.lit("b")).alias("color"),
        F.lower("pc").alias("type"), value.alias("value"))


def attack_edges(spark: SparkSession, pcs: DataFrame) -> DataFrame:
    """Piece -> attacked square (own or enemy occupant included, sliders stop
    at the first blocker). ``second`` is the next occupied square behind the
    first blocker on the same ray (for pins, skewers and x-rays)."""
    sl = pcs.filter(F.col("type").isin("b", "r", "q"))
    sl = sl.withColumn("_kinds", F.when(F.col("type") == "b", F.array(F.lit("diag")))
                       .when(F.col("type") == "r", F.array(F.lit("orth")))
                       .otherwise(F.array(F.lit("orth"), F.lit("diag"))))
    sl = sl.join(rays(spark), (F.col("idx") == F.col("from_idx")) & F.array_contains("_kinds", F.col("kind")))
    occ = F.transform("cells", lambda c: F.substring(F.col("b"), c, 1) != ".")
    first = F.array_position(occ, True).cast("int")
    sl = sl.withColumn("_first", first)
    rest = F.slice(occ, F.col("_first") + 1, 8)
    second_rel = F.array_position(rest, True).cast("int")
    sl = sl.withColumn("second_idx", F.when((F.col("_first") > 0) & (second_rel > 0),
                                            F.element_at("cells", F.col("_first") + second_rel)))
    hit = F.when(F.col("_first") == 0, F.col("cells")).otherwise(F.slice("cells", 1, F.col("_first")))
    sl = sl.select("fen", "b", "side", F.col("idx").alias("from_idx"), F.col("color").alias("from_color"),
                   F.col("type").alias("from_type"), "dir", "second_idx", "_first",
                   F.posexplode(hit).alias("s0", "to_idx"))
    sl = sl.withColumn("step", (F.col("s0") + 1).cast("int"))
    # the square behind is only meaningful on the first blocker's edge
    sl = sl.withColumn("second_idx", F.when(F.col("step") == F.col("_first"), F.col("second_idx"))) \
        .drop("s0", "_first")
    lp = pcs.filter(F.col("type").isin("n", "k", "p"))
    lp = lp.withColumn("_kind", F.when(F.col("type") == "p", F.concat(F.col("color"), F.lit("p")))
                       .otherwise(F.col("type")))
    lp = lp.join(leaps(spark), (F.col("idx") == F.col("from_idx")) & (F.col("_kind") == F.col("kind")))
    lp = lp.select("fen", "b", "side", "from_idx", F.col("color").alias("from_color"),
                   F.col("type").alias("from_type"), F.lit(None).cast("string").alias("dir"),
                   F.lit(None).cast("int").alias("second_idx"), "to_idx", F.lit(1).alias("step"))
    e = sl.unionByName(lp)
    occ_pc = F.substring(F.col("b"), F.col("to_idx"), 1)
    return e.select(
        "fen", "side", "from_idx", "from_color", "from_type", "dir", "step", "to_idx",
        F.when(occ_pc == ".", F.lit(None)).when(occ_pc == F.upper(occ_pc), F.lit("w")).otherwise(F.lit("b"))
        .alias("to_color"),
        F.when(occ_pc == ".", F.lit(None)).otherwise(F.lower(occ_pc)).alias("to_type"),
        "second_idx")
