"""Sequence explode: games and puzzles to positions.

Explodes are narrow (``posexplode`` within a row) and need no shuffle; the
index filters are evaluated inside the generate stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.functions.draws import hash_uniform
from rookery.functions.text import (SAN_MOVE, UCI_MOVE, first_invalid_index, parse_movetext,
                                    tokens)


@dataclass(frozen=True)
class ExplodeParams:
    skip_first: int = 4
    skip_last: int = 2
    sample_rate: float = 0.3
    seed: int = 42


def movetext_fallback(df: DataFrame) -> DataFrame:
    """``movetext`` else ``moves``; an empty string counts as missing."""
    return df.withColumn("movetext", F.coalesce(F.nullif(F.col("movetext"), F.lit("")),
                                                F.nullif(F.col("moves"), F.lit(""))))


def game_tokens(games: DataFrame) -> DataFrame:
    """Adds ``sans`` (cleaned SAN tokens) and ``stop`` (first malformed token)."""
    g = games.withColumn("sans", parse_movetext("movetext"))
    return g.withColumn("stop", first_invalid_index("sans", SAN_MOVE))


def explode_plies(games: DataFrame, params: ExplodeParams = ExplodeParams(),
                  sample: bool = False) -> DataFrame:
    """One row per position before ply ``ply`` (0-based) inside the
    ``[skip_first, n - skip_last)`` window. Replay stops at the first malformed
    token; the position in front of it is still produced (it is valid).
    With ``sample`` a keyed Bernoulli draw keeps ``u <= sample_rate``."""
    sf, sl = params.skip_first, params.skip_last
    g = game_tokens(games).filter(F.size("sans") >= sf + sl + 1)
    e = g.select("*", F.posexplode("sans").alias("ply", "san"))
    keep = (F.col("ply") >= sf) & (F.col("ply") < F.size("sans") - sl) & (
        F.col("stop").isNull() | (F.col("ply") <= F.col("stop")))
    e = e.filter(keep)
    if sample:
        e = e.filter(hash_uniform(params.seed, F.col("game_id"), F.col("ply")) <= params.sample_rate)
    return e


def explode_puzzle_turns(puzzles: DataFrame) -> DataFrame:
    """Solver turns of a puzzle line: odd indices before the first malformed
    move, with the index and full line length carried along."""
    p = puzzles.withColumn("line", tokens(F.coalesce(F.col("moves"), F.lit(""))))
    p = p.filter((F.col("fen").isNotNull()) & (F.col("fen") != "") & (F.size("line") >= 2))
    p = p.withColumn("stop", first_invalid_index("line", UCI_MOVE))
    e = p.select("*", F.posexplode("line").alias("move_index", "uci"))
    return e.filter((F.col("move_index") % 2 == 1)
                    & (F.col("stop").isNull() | (F.col("move_index") < F.col("stop"))))
