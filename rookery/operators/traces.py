"""Trace text operators: prompt extraction, guardrails, dialogue, opening
names and families, hints (SURVEY 2.8, 2.8.1).

Text work is per row and stays in JVM built-ins; small rule and phrase
tables are literal dimensions (broadcast, size fixed by construction).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.functions.draws import hash_uniform
from rookery.functions.text import prefix_lines, replace_word_keep_case

# --- fixed values -----------------------------------------------------------
# Guardrail for drawn positions: (word, replacement), applied in this order.
GUARD_WORDS = [("winning", "drawn"), ("losing", "drawn"), ("win", "draw"), ("loss", "draw")]
# Opening families: ordered substring rules on the lower-cased name
# (priority, family, keyword); no match -> "other".
FAMILY_RULES = [
    ("sicilian", ["sicilian"]),
    ("french", ["french"]),
    ("caro-kann", ["caro-kann"]),
    ("pirc", ["pirc", "modern"]),
    ("king's indian", ["king's indian", "kings indian"]),
    ("grunfeld", ["grünfeld", "grunfeld"]),
    ("slav", ["slav"]),
    ("queen's gambit", ["queen's gambit", "queens gambit"]),
    ("catalan", ["catalan"]),
    ("nimzo-indian", ["nimzo", "nimzo-indian"]),
    ("ruy lopez", ["ruy lopez", "spanish"]),
    ("italian", ["italian"]),
    ("scotch", ["scotch"]),
    ("english", ["english"]),
    ("london", ["london"]),
    ("dutch", ["dutch"]),
]
FAMILY_DEFAULT = "other"
# --- end of fixed values -----------------------------------------------------

FAMILY_RULE_ROWS = [(i, fam, kw) for i, (fam, kws) in enumerate(FAMILY_RULES) for kw in kws]
SPEAKERS = [("Coach", "mentor"), ("Student", "learner")]


def prompt_text(messages) -> Column:
    """First user message's content, else all contents joined by spaces."""
    m = F.col(messages) if isinstance(messages, str) else messages
    user = F.try_element_at(F.filter(m, lambda x: x["role"] == "user"), F.lit(1))["content"]
    every = F.array_join(F.transform(m, lambda x: F.coalesce(x["content"], F.lit(""))), " ")
    return F.coalesce(user, every)


def guardrail(text: Column) -> Column:
    t = text
    for target, rep in GUARD_WORDS:
        t = replace_word_keep_case(t, target, rep)
    return t


def dialogue(text: Column, key: Column, seed: int = 42) -> Column:
    """Prefix each non-blank line with a speaker chosen by a keyed draw."""
    u = hash_uniform(seed, key, F.lit("speaker"))
    speaker = F.when(u < 0.5, F.lit(SPEAKERS[0][0])).otherwise(F.lit(SPEAKERS[1][0]))
    return prefix_lines(text, F.concat(speaker, F.lit(": ")))


def opening_short_name(name) -> Column:
    n = F.col(name) if isinstance(name, str) else name
    return F.trim(F.substring_index(F.substring_index(n, ":", 1), ",", 1))


def family_rules(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(FAMILY_RULE_ROWS, "prio INT, family STRING, kw STRING"))


def opening_family(spark: SparkSession, names: DataFrame) -> DataFrame:
    """Theta join of distinct names against the rule table (broadcast
    nested loop on ``contains``), first matching rule wins."""
    j = names.join(family_rules(spark), F.instr(F.lower("name"), F.col("kw")) > 0, "left")
    g = j.groupBy("name").agg(F.min_by("family", "prio").alias("family"))
    return g.select("name", F.coalesce(F.col("family"), F.lit(FAMILY_DEFAULT)).alias("family"))
