"""Wording of the traces. The phrases are this engine's own; only which pool a
position draws from follows the reference's rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = 2  # of the wording; a change of it changes traces

POOLS = {
    "context_mate": ["Tip: count the attackers around the king.", "Tip: try every check before anything else.",
                     "Tip: a mating net may already be there."],
    "context_endgame": ["Tip: who wins the race to promote?", "Tip: bring the king to the centre first.",
                        "Tip: trade down only if the pawns work out."],
    "context_loose": ["Tip: something is unprotected.", "Tip: one piece has no defender left."],
    "context_tactical": ["Tip: one move may hit two things.", "Tip: a short combination is in the air."],
    "context_generic": ["Tip: what would the other side like to do next?", "Tip: compare the three most active moves.",
                        "Tip: begin with the least useful piece."],
    "orient_game": ["Taken from a played game.", "A position from practice.", "This arose over the board."],
    "orient_puzzle": ["Set as an exercise.", "A puzzle with one best answer.", "An exercise position."],
    "assess_balanced": ["Chances look level.", "I would call this equal."],
    "assess_better": ["The mover is ahead.", "Things favour the mover."],
    "assess_worse": ["The mover has problems to solve.", "The mover is behind."],
    "assess_slight": ["One side is a touch ahead.", "The scales tip only a little."],
    "conclusion_firm": ["It has to be {move}.", "Nothing but {move} will do."],
    "conclusion_soft": ["{move} gets my vote among several.", "Of the good moves I pick {move}."],
    "conclusion_default": ["My choice: {move}.", "I settle on {move}.", "{move} it is."],
    "reconsider": ["One more look before I decide.", "I want to verify the critical line again."],
    "opponent": ["The reply I fear most is an active one.", "The other side will look for activity."],
    "quality_best": ["top of the list", "nothing scores higher"],
    "quality_close": ["almost as strong", "within a hair of the top"],
    "quality_inferior": ["a step down", "it concedes something"],
    "quality_bad": ["a mistake", "this goes wrong"],
    "quality_mate": ["mates by force", "the king cannot get away"],
    "quality_allows_mate": ["gets mated", "lets the king be caught"],
    "side_to_move": ["{mover} to move.", "It is the move of {mover}.", "{mover} has the move."],
    "opens_opening": ["Opening: {name}.", "This comes from the {name}.", "A position of the {name}."],
    "opens_endgame": ["An endgame.", "We are in an endgame.", "Few pieces are left."],
    "opens_phase": ["Still the opening.", "Development goes on.", "The game is young."],
    "plans_opening": ["Usual {family} plans fit.", "Think of typical {family} ideas.", "The standard {family} setups apply."],
    "walkthrough": ["{mover} to move, move {move}.", "Move {move}, and {mover} decides.", "At move {move} the turn is with {mover}."],
    "tablebase": ["Tablebase: {result}.", "By the tablebase this is {result}."],
    "profile_mate": ["Mate can be forced.", "There is a forced mate."],
    "profile_only": ["There is one good move.", "Only one move holds."],
    "profile_many": ["Many moves are playable.", "There is a wide choice."],
    "profile_few": ["A few moves compete.", "Some moves deserve a look."],
    "snapshot": ["Snapshot: {notes}", "In short: {notes}", "What stands out: {notes}"],
    "technique": ["Technique decides this {type}.", "This {type} asks for care.", "In a {type} like this, precision counts."],
    "threat_check": ["The king is in check.", "First the check has to be met."],
    "threat_loose": ["Something hangs.", "A piece of mine is in danger."],
    "threat_none": ["Nothing is threatened at once.", "There is no direct threat."],
    "plan": ["Plan: {plan}.", "My plan would be: {plan}.", "I would like to {plan}."],
    "candidates": ["Candidates: {moves}.", "I look at {moves}.", "Worth a look: {moves}."],
    "avoid": ["Avoid {move}: it costs too much.", "{move} would be a mistake.", "Not {move}, tempting as it is."],
    "dead_end": ["I tried {move} without success.", "{move} leads nowhere.", "{move} does not hold up."],
    "compare": ["{first} convinces me more than {second}.", "Between {first} and {second}, the former is better.", "{first} asks more than {second}."],
    "main_line": [" Main line: {line}.", " It may go on {line}."],
}


def phrase_table(spark: SparkSession, pools: dict[str, list[str]] | None = None, version: int = VERSION) -> DataFrame:
    """The wording as a table: ``version, slot, idx, text``."""
    rows = [(version, slot, i, text) for slot, texts in (pools or POOLS).items() for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "version int, slot string, idx int, text string")


def with_phrases(rows: DataFrame, table: DataFrame | None = None, version: int = VERSION) -> DataFrame:
    """Put the wording on each row, ``phrases``: a map from slot to texts, and ``slots``:
    the texts of the slots of ``POOLS`` as fields, which need no search. The table is
    one small row after its aggregation, which is broadcast."""
    table = phrase_table(rows.sparkSession) if table is None else table
    slots = table.where(F.col("version") == version).groupBy("slot").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]).alias("texts"))
    one = slots.agg(F.map_from_entries(F.collect_list(F.struct("slot", "texts"))).alias("phrases"))
    one = one.withColumn("slots", F.struct(*[F.element_at("phrases", F.lit(slot)).alias(slot) for slot in POOLS]))
    return rows.crossJoin(F.broadcast(one))


NOTES = {
    "material": {"even": "Material is equal.", "white": "White has more material.", "black": "Black has more material."},
    "structure": {"own_isolated": "A pawn stands alone.", "own_doubled": "Two pawns share a file.",
                  "own_backward": "A pawn lags behind.", "more_islands": "The pawns are scattered.",
                  "fewer_islands": "The pawns hold together.", "opponent_weakness": "The other pawns can be attacked.",
                  "healthy": "The pawns are sound."},
    "king": {"own_exposed": "The king lacks cover.", "opponent_exposed": "The enemy king lacks cover.",
             "both_safe": "Both kings are covered."},
    "development": {"several": "Three or more minor pieces are at home.", "some": "Some minor pieces are at home.",
                    "complete": "The minor pieces are out."},
}
