"""Prompt formatting, extraction and text operators."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from rookery.functions import text as T
from rookery.functions.draws import hash_uniform
from rookery.operators import filters as flt
from rookery.operators import traces as TR
from rookery.plans import sqlfrag as S
from rookery.plans.q_scoring import ANALYSED
from rookery.plans.registry import register
from rookery.sources.fixtures import plan_memo
from rookery.sources.fixtures import (fx_candidates, fx_chat, fx_positions, fx_rollouts, fx_valid_list,
                                      with_fx)
from rookery.sources.tables import table


def fill_sql(template: str, **exprs: str) -> str:
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(S.q(template[pos:m.start()]))
        parts.append(f"coalesce(CAST({exprs[m.group(1)]} AS VARCHAR), '')")
        pos = m.end()
    if pos < len(template):
        parts.append(S.q(template[pos:]))
    return "concat(" + ", ".join(parts) + ")"


@plan_memo
def basic_rows(spark, sf):
    """Positions with their legal list and chosen move (best, else first legal)."""
    from rookery.operators.scoring import rank_candidates
    best = rank_candidates(fx_candidates(spark, sf)).filter("rank = 1").select("pos_id", F.col("uci").alias("best"))
    j = fx_positions(spark, sf).select("pos_id", "fen").join(fx_valid_list(spark, sf), "pos_id")
    j = j.join(best, "pos_id", "left")
    return j.withColumn("chosen_move", flt.resolve_chosen_move("best", F.lit(None).cast("string"), "valid_moves"))


BASIC_SQL = f"""{ANALYSED},
br AS (SELECT p.pos_id, p.fen, v.valid_moves, a.uci AS best FROM fx_positions p
  JOIN fx_valid_list v ON v.pos_id = p.pos_id LEFT JOIN analysed a ON a.pos_id = p.pos_id AND a.rank = 1),
basic AS (SELECT *, CASE WHEN best IS NOT NULL AND list_contains(valid_moves, best) THEN best
  ELSE coalesce(valid_moves[1], '') END AS chosen_move FROM br)"""
BFX = ("fx_positions", "fx_valid_list", "fx_candidates")


@register("format_sft", with_fx(
    f"WITH {BASIC_SQL} SELECT pos_id, "
    f"{fill_sql(T.PROMPT_TEMPLATE, fen='fen', legal_moves=S.join_str('valid_moves', ', '))} AS prompt, "
    f"{fill_sql(T.COMPLETION_TEMPLATE, trace=chr(39) + 'Play ' + chr(39) + ' || chosen_move || ' + chr(39) + '.' + chr(39), move='chosen_move')}"
    " AS completion FROM basic", *BFX))
def q_format_sft(spark, sf):
    b = basic_rows(spark, sf).withColumn("trace", F.concat(F.lit("Play "), F.col("chosen_move"), F.lit(".")))
    return b.select("pos_id",
                    T.fill(T.PROMPT_TEMPLATE, fen="fen", legal_moves=F.array_join("valid_moves", ", ")).alias("prompt"),
                    T.fill(T.COMPLETION_TEMPLATE, trace="trace", move="chosen_move").alias("completion"))


@register("format_chat", with_fx(
    f"WITH {BASIC_SQL} SELECT pos_id, 1 AS n_messages, 'user' AS role, "
    f"{fill_sql(T.PROMPT_TEMPLATE, fen='fen', legal_moves=S.join_str('list_sort(valid_moves)', ', '))} AS content "
    "FROM basic", *BFX))
def q_format_chat(spark, sf):
    b = basic_rows(spark, sf)
    msgs = F.array(F.struct(F.lit("user").alias("role"), T.fill(
        T.PROMPT_TEMPLATE, fen="fen", legal_moves=F.array_join(F.array_sort("valid_moves"), ", ")).alias("content")))
    m = b.select("pos_id", msgs.alias("messages"))
    return m.select("pos_id", F.size("messages").alias("n_messages"), F.col("messages")[0]["role"].alias("role"),
                    F.col("messages")[0]["content"].alias("content"))


@register("format_chat_system", with_fx(
    f"WITH {BASIC_SQL} SELECT pos_id, 2 AS n_messages, {S.q(T.SYSTEM_CONTENT)} AS system_content, "
    f"{fill_sql(T.USER_TEMPLATE_MINIMAL, fen='fen', legal_moves=S.join_str('list_sort(valid_moves)', ' '))} "
    "AS user_content FROM basic", *BFX))
def q_format_chat_system(spark, sf):
    b = basic_rows(spark, sf)
    msgs = F.array(
        F.struct(F.lit("system").alias("role"), F.lit(T.SYSTEM_CONTENT).alias("content")),
        F.struct(F.lit("user").alias("role"), T.fill(
            T.USER_TEMPLATE_MINIMAL, fen="fen", legal_moves=F.array_join(F.array_sort("valid_moves"), " "))
            .alias("content")))
    m = b.select("pos_id", msgs.alias("messages"))
    return m.select("pos_id", F.size("messages").alias("n_messages"),
                    F.col("messages")[0]["content"].alias("system_content"),
                    F.col("messages")[1]["content"].alias("user_content"))


@register("extract_prompt_text", with_fx(
    "SELECT conv_id, md5(coalesce(list_filter(messages, lambda m: m.role = 'user')[1].content, "
    "array_to_string(list_transform(messages, lambda m: coalesce(m.content, '')), ' '))) AS text_md5, "
    "CAST(length(coalesce(list_filter(messages, lambda m: m.role = 'user')[1].content, "
    "array_to_string(list_transform(messages, lambda m: coalesce(m.content, '')), ' '))) AS INT) AS n_chars "
    "FROM fx_chat", "fx_chat"))
def q_extract_prompt_text(spark, sf):
    c = fx_chat(spark, sf)
    t = TR.prompt_text("messages")
    return c.select("conv_id", F.md5(t).alias("text_md5"), F.length(t).alias("n_chars"))


@register("extract_fen", with_fx(
    f"WITH {BASIC_SQL}, pr AS (SELECT pos_id, fen, "
    f"{fill_sql(T.PROMPT_TEMPLATE, fen='fen', legal_moves=S.join_str('list_sort(valid_moves)', ', '))} AS prompt "
    f"FROM basic) SELECT pos_id, CASE WHEN regexp_matches(prompt, {S.q(T.FEN_IN_PROMPT)}) THEN "
    f"trim(regexp_extract(prompt, {S.q(T.FEN_IN_PROMPT)}, 1)) END AS fen, "
    f"trim(regexp_extract(prompt, {S.q(T.FEN_IN_PROMPT)}, 1)) = fen AS round_trip FROM pr", *BFX))
def q_extract_fen(spark, sf):
    b = basic_rows(spark, sf)
    p = b.select("pos_id", "fen", T.fill(T.PROMPT_TEMPLATE, fen="fen", legal_moves=F.array_join(
        F.array_sort("valid_moves"), ", ")).alias("prompt"))
    e = T.extract_fen("prompt")
    return p.select("pos_id", e.alias("fen_x"), (e == F.col("fen")).alias("round_trip")) \
        .withColumnRenamed("fen_x", "fen")


STRIP = "regexp_replace({x}, '^\\s+|\\s+\\z', '', 'g')"


@register("split_response", with_fx(
    f"SELECT prompt_id, sample_id, md5(r) AS reasoning_md5, CAST(length(r) AS INT) AS reasoning_chars, move FROM "
    f"(SELECT prompt_id, sample_id, CASE WHEN regexp_matches(completion, {S.q(T.THINK_BLOCK)}) THEN "
    f"{STRIP.format(x='regexp_extract(completion, ' + S.q(T.THINK_BLOCK) + ', 1)')} END AS r, "
    f"CASE WHEN regexp_matches(completion, {S.q(T.MOVE_ANY)}) THEN "
    f"{STRIP.format(x='regexp_extract(completion, ' + S.q(T.MOVE_ANY) + ', 1)')} END AS move FROM fx_rollouts)",
    "fx_rollouts", "fx_candidates"))
def q_split_response(spark, sf):
    r = fx_rollouts(spark, sf)
    reasoning, move = T.split_response("completion")
    s = r.select("prompt_id", "sample_id", reasoning.alias("r"), move.alias("move"))
    return s.select("prompt_id", "sample_id", F.md5("r").alias("reasoning_md5"),
                    F.length("r").alias("reasoning_chars"), "move")


@register("close_tag", with_fx(
    "SELECT prompt_id, sample_id, CAST(length(CASE WHEN strpos(completion, '<uci_move>') > 0 AND "
    "strpos(completion, '</uci_move>') = 0 THEN completion || '</uci_move>' ELSE completion END) AS INT) AS n_chars, "
    "ends_with(CASE WHEN strpos(completion, '<uci_move>') > 0 AND strpos(completion, '</uci_move>') = 0 "
    "THEN completion || '</uci_move>' ELSE completion END, '</uci_move>') AS closed FROM fx_rollouts",
    "fx_rollouts", "fx_candidates"))
def q_close_tag(spark, sf):
    r = fx_rollouts(spark, sf).withColumn("t", T.close_tag("completion"))
    return r.select("prompt_id", "sample_id", F.length("t").alias("n_chars"),
                    F.col("t").endswith("</uci_move>").alias("closed"))


@register("approx_tokens", "SELECT doc_id, CAST(greatest(1, length(text) - length(replace(replace(replace(text, ' ', "
          "''), chr(10), ''), chr(9), '')) + 1, CAST(floor(length(text) / 4) AS BIGINT)) AS INT) AS approx_tokens "
          "FROM documents")
def q_approx_tokens(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", T.approx_tokens("text").cast("int").alias("approx_tokens"))


GUARD_WORDS = TR.GUARD_WORDS


def guard_sql(x: str) -> str:
    for target, rep in GUARD_WORDS:
        x = f"regexp_replace({x}, {S.q(chr(92) + 'b' + target.upper() + chr(92) + 'b')}, {S.q(rep.upper())}, 'g')"
        x = (f"regexp_replace({x}, {S.q(chr(92) + 'b' + target[:1].upper() + '(?i:' + target[1:] + ')' + chr(92) + 'b')},"
             f" {S.q(rep.capitalize())}, 'g')")
        x = f"regexp_replace({x}, {S.q('(?i)' + chr(92) + 'b' + target + chr(92) + 'b')}, {S.q(rep)}, 'g')"
    return x


@register("guardrail_replace", "SELECT doc_id, md5(t) AS text_md5, CAST(length(t) AS INT) AS n_chars, "
          "t <> text AS changed FROM (SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN "
          f"{guard_sql('text')} ELSE text END AS t FROM documents)")
def q_guardrail_replace(spark, sf):
    """Documents stand in for traces; every third one is a drawn position."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    t = TR.guardrail(F.col("text"))
    d = d.withColumn("t", F.when(F.col("doc_id") % 3 == 0, t).otherwise(F.col("text")))
    return d.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").alias("n_chars"),
                    (F.col("t") != F.col("text")).alias("changed"))


def dialogue_sql(text: str, prefix: str) -> str:
    lines = (f"CASE WHEN coalesce({text}, '') = '' THEN []::VARCHAR[] ELSE "
             f"string_split(regexp_replace({text}, '\\n\\z', ''), chr(10)) END")
    return (f"array_to_string(list_transform({lines}, lambda ln: CASE WHEN regexp_matches(ln, '^\\s*$') "
            f"THEN '' ELSE {prefix} || ln END), chr(10))")


SPEAKER_SQL = ("CASE WHEN " + S.uniform(42, "doc_id", "'speaker'") + " < 0.5::DOUBLE THEN "
               + S.q(TR.SPEAKERS[0][0]) + " ELSE " + S.q(TR.SPEAKERS[1][0]) + " END || ': '")


@register("dialogue_render", f"SELECT doc_id, md5(d) AS text_md5, CAST(length(d) AS INT) AS n_chars FROM "
          f"(SELECT doc_id, {dialogue_sql('text', SPEAKER_SQL)} AS d FROM documents)")
def q_dialogue_render(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    out = TR.dialogue(F.col("text"), F.col("doc_id"))
    d = d.select("doc_id", out.alias("d"))
    return d.select("doc_id", F.md5("d").alias("text_md5"), F.length("d").alias("n_chars"))


# ---- openings: names and families ---------------------------------------------

def lookup_names(spark, sf):
    from rookery.plans.q_board import q_opening_lookup
    return q_opening_lookup(spark, sf).filter(F.col("name").isNotNull())


LOOKUP_SQL_KEYS = ("fx_games", "fx_lines")


def _lookup_sql():
    from rookery.plans.q_board import BOOK_SQL, FEN_KEY_SQL, sql_valid_prefix
    from rookery.functions.board import DUCK, replay_states_sql
    from rookery.sources.fixtures import START_FEN
    return (f"{BOOK_SQL}, gd AS (SELECT DISTINCT line_uci FROM gl), "
            f"gs AS (SELECT line_uci, {replay_states_sql(DUCK, S.q(START_FEN), sql_valid_prefix(S.tokens('line_uci')))}"
            " AS sts FROM gd), "
            "gx AS (SELECT line_uci, unnest(sts) AS fen, CAST(unnest(range(len(sts))) AS INT) AS ply, len(sts) AS n "
            "FROM gs), "
            f"gp AS (SELECT line_uci, ply, {FEN_KEY_SQL} AS key FROM gx WHERE ply < n - 1), "
            "lk AS (SELECT gl.game_id, gp.ply, o.eco, o.name, o.move_count FROM gl JOIN gp ON gp.line_uci = gl.line_uci "
            "LEFT JOIN oidx o ON o.key = gp.key WHERE o.name IS NOT NULL)")


def short_name_sql(x: str) -> str:
    return f"trim(split_part(split_part({x}, ':', 1), ',', 1))"


@register("opening_short_name", with_fx(
    f"WITH {_lookup_sql()} SELECT game_id, ply, {short_name_sql('name')} AS short_name FROM lk", *LOOKUP_SQL_KEYS))
def q_opening_short_name(spark, sf):
    n = lookup_names(spark, sf)
    return n.select("game_id", "ply", TR.opening_short_name("name").alias("short_name"))


FAMILY_SQL = ("fam AS (SELECT name, coalesce(min_by(family, prio), 'other') AS family FROM "
              "(SELECT DISTINCT name FROM lk) n LEFT JOIN (VALUES "
              + ", ".join(f"({i}, {S.q(f)}, {S.q(k)})" for i, f, k in TR.FAMILY_RULE_ROWS)
              + ") r(prio, family, kw) ON strpos(lower(n.name), r.kw) > 0 GROUP BY name)")


@register("opening_family", with_fx(
    f"WITH {_lookup_sql()}, {FAMILY_SQL} SELECT lk.game_id, lk.ply, fam.family FROM lk JOIN fam ON fam.name = lk.name",
    *LOOKUP_SQL_KEYS))
def q_opening_family(spark, sf):
    n = lookup_names(spark, sf)
    fam = TR.opening_family(spark, n.select("name").distinct())
    return n.join(fam, "name").select("game_id", "ply", "family")
