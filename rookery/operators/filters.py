"""Source predicates.

Each filter is a plain Column predicate so a chain of them becomes one
conjunction that Catalyst can reorder and push into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.functions.casts import rating_or_default

DECISIVE_RESULTS = ("1-0", "0-1", "1/2-1/2")
TIME_FORFEIT = "Time forfeit"
# Structural FEN check: 8 ranks, side, castling, en passant, clocks.
FEN_PATTERN = (r"^([pnbrqkPNBRQK1-8]{1,8}/){7}[pnbrqkPNBRQK1-8]{1,8} [wb] "
               r"(-|K?Q?k?q?) (-|[a-h][36]) \d+ \d+$")


@dataclass(frozen=True)
class GameFilterParams:
    min_elo: int = 1200
    default_elo: int = 1500
    min_puzzle_rating: int = 1000
    max_puzzle_rating: int = 2500


def not_time_forfeit() -> Column:
    """NULL termination is kept (``NOT (t <=> 'Time forfeit')``)."""
    return ~F.col("termination").eqNullSafe(F.lit(TIME_FORFEIT))


def decisive_result() -> Column:
    return F.coalesce(F.col("result").isin(*DECISIVE_RESULTS), F.lit(False))


def avg_elo(default: int = 1500) -> Column:
    return (rating_or_default("white_elo", default) + rating_or_default("black_elo", default)) / F.lit(2.0)


def puzzle_rating_ok(p: GameFilterParams = GameFilterParams()) -> Column:
    r = rating_or_default("rating", 1500)
    return r.between(p.min_puzzle_rating, p.max_puzzle_rating)


def valid_fen(col: str = "fen") -> Column:
    c = F.col(col)
    return c.isNotNull() & (c != "") & c.rlike(FEN_PATTERN)


def filter_valid_records(df: DataFrame, fen: str = "fen", moves: str = "moves") -> DataFrame:
    """Drop rows with an empty key field or a malformed FEN."""
    m = F.col(moves)
    return df.filter(valid_fen(fen) & m.isNotNull() & (F.trim(m) != ""))


def resolve_chosen_move(best, first_eval, valid) -> Column:
    """best -> first evaluated -> '' when not legal -> first legal move."""
    b = F.col(best) if isinstance(best, str) else best
    fe = F.col(first_eval) if isinstance(first_eval, str) else first_eval
    v = F.col(valid) if isinstance(valid, str) else valid
    pick = F.coalesce(F.nullif(b, F.lit("")), F.nullif(fe, F.lit("")), F.lit(""))
    pick = F.when((pick != "") & F.coalesce(F.array_contains(v, pick), F.lit(False)), pick).otherwise(F.lit(""))
    return F.when(pick == "", F.coalesce(F.try_element_at(v, F.lit(1)), F.lit(""))).otherwise(pick)
