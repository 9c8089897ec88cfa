"""Source normalisation: games and puzzles as typed records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.functions.text import tokens


def normalise_tags(col, split: bool):
    """str-or-list normalisation, once at ingest: strings are split on
    whitespace (themes) or wrapped as a one-element list (opening tags);
    empty entries are dropped."""
    c = F.col(col) if isinstance(col, str) else col
    if split:
        arr = tokens(F.coalesce(c, F.lit("")))
    else:
        arr = F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.array(c))
    return F.filter(arr, lambda t: t != "")


def scan_games(games: DataFrame) -> DataFrame:
    return games.select("game_id", "termination", "result", "white_elo", "black_elo", "movetext", "moves")


def scan_puzzles(puzzles: DataFrame) -> DataFrame:
    return puzzles.select(
        "puzzle_id", "rating",
        normalise_tags("themes", split=True).alias("themes"),
        normalise_tags("opening_tags", split=False).alias("opening_tags"),
        "fen", "moves")
