"""Trace assembly.

One row a position: the pool candidates and the best line are arrays on it, so
after the join that builds the row everything is expressions in place, without
a window or another shuffle. Section order, gates, multipliers, caps, trim order
and fallbacks follow the reference; the wording is in ``phrases``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.functions.draws import hash_uniform
from rookery.operators.phrases import NOTES, POOLS, with_phrases

# --- fixed values -----------------------------------------------------------
SECTION_ORDER = ["orientation", "opening_plan", "fen_walkthrough", "context_hint", "assessment",
                 "decision_profile", "static_eval", "endgame_technique", "threat_scan", "plan", "opponent",
                 "candidates", "avoid_blunder", "exploration", "reconsideration", "dead_end", "comparison",
                 "conclusion"]
DROP_ORDER = ["avoid_blunder", "opening_plan", "endgame_technique", "decision_profile", "context_hint",
              "comparison", "dead_end", "reconsideration", "fen_walkthrough", "static_eval", "exploration",
              "candidates", "threat_scan", "opponent", "plan", "assessment", "orientation"]
# Gate probabilities (strict u < p) before style / source multipliers.
SECTION_PROBS = {"opening_plan": 0.25, "fen_walkthrough": 0.15, "context_hint": 0.18, "decision_profile": 0.25,
                 "static_eval": 0.25, "endgame_technique": 0.30, "threat_scan": 0.45, "plan": 0.30, "opponent": 0.25,
                 "reconsideration": 0.20, "dead_end": 0.20, "comparison": 0.30}
SOURCE_MULT = {"context_hint": {"game": 0.7, "puzzle": 1.5}, "decision_profile": {"game": 0.8, "puzzle": 1.2}}
STYLE_MULT = {"quick": 0.25, "concise": 0.6}
PV_PROB, PV_FORCED_MIN = 0.55, 0.85
PV_STYLE = {"quick": 0.25, "concise": 0.6, "dialogue": 0.6}
# Extras of a candidate: probability, factor for the best move, most per trace, factors by style.
EXTRAS = {"pv": (0.30, 1.2, 1, {"concise": 0.4, "tactical": 1.2}),
          "motif": (0.50, 1.1, 2, {"quick": 0.25, "concise": 0.5, "tactical": 1.1}),
          "trap": (1.0, 1.0, 1, {"quick": 0.25, "concise": 0.6, "tactical": 1.1})}
INITIAL_GUESS_BEST_PROB = 0.7
EXPLAIN_MAX_PLIES = 4
MAX_STATIC_NOTES = 2
# Theme substrings that choose a hint, in order of precedence with the board's own signs.
THEME_MARKERS = {"mate": ["mate"], "endgame": ["endgame"], "loose": ["hanging", "trapped"],
                 "tactical": ["fork", "pin", "skewer", "deflection", "attraction", "interference", "discovered", "double", "backrank"]}
# --- end of fixed values -----------------------------------------------------

UNGATED = ("static_eval",)  # their gate does not depend on the style
POS_DRAWS = ["opening_plan", "fen_walkthrough", "context_hint", "ctx_phrase", "assess_phrase", "decision_profile",
             "static_eval", "note_material", "note_structure", "note_king", "note_development", "orient_phrase",
             "endgame_technique", "threat_scan", "plan", "plan_pick", "opponent", "opp_phrase", "reconsideration",
             "recon_phrase", "dead_end", "comparison", "concl_phrase", "guess", "guess_pick", "pv_gate",
             "side_phrase", "opens_phrase", "plans_phrase", "walk_phrase", "tb_phrase", "profile_phrase", "snap_phrase", "tech_phrase",
             "threat_phrase", "plan_phrase", "cands_phrase", "avoid_phrase", "dead_phrase", "cmp_phrase", "line_phrase"]
CAND_DRAWS = ["ord", "quality", "cand_pv", "cand_motif", "cand_trap"]
CAND_FIELDS = ["uci", "win_prob", "category", "mate_in", "trap_kind", "confidence", "pv", "u_quality", "u_cand_pv",
               "u_cand_motif", "u_cand_trap"]
SEPARATOR = "\n\n"


def draw(name: str) -> Column:
    """The position's draw of that name. It is drawn where it is used, so that what a
    gate leaves out costs no hash."""
    return hash_uniform(42, F.col("pos_id"), F.lit(name))


def drawn(u: Column, n: int) -> Column:
    """0-based index of an even draw among ``n``."""
    return F.floor(u * n).cast("int")


def texts_of(pool: str | Column) -> Column:
    """The texts of a slot. Known slots are fields of the row of phrases, others are
    looked for in the map."""
    if isinstance(pool, str) and pool in POOLS:
        return F.col(f"slots.{pool}")
    return F.element_at(F.col("phrases"), F.lit(pool) if isinstance(pool, str) else pool)


def texts_by(prefix: str, code: Column) -> Column:
    """The texts of the slot that the code names after the prefix."""
    return by_code(code, {k[len(prefix):]: texts_of(k) for k in POOLS if k.startswith(prefix)}, "array<string>")


def pick(pool: str | Column, u: Column, **values: Column) -> Column:
    """A phrase of the slot, its placeholders filled; null where a value is."""
    return phrase(texts_of(pool), u, **values)


def phrase(texts: Column, u: Column, **values: Column) -> Column:
    out = F.element_at(texts, F.floor(u * F.size(texts)).cast("int") + 1)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def by_code(code: Column, choices: dict[str, Column], kind: str = "string") -> Column:
    out = F.lit(None).cast(kind)
    for k, v in choices.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def factor(column: Column, factors: dict[str, float]) -> Column:
    return F.coalesce(by_code(column, {k: F.lit(v) for k, v in factors.items()}).cast("double"), F.lit(1.0))


def gate(name: str) -> Column:
    p = F.lit(SECTION_PROBS[name])
    if name in SOURCE_MULT:
        p = p * factor(F.col("source"), SOURCE_MULT[name])
    if name not in UNGATED:
        p = p * factor(F.col("style"), STYLE_MULT)
    return draw(name) < F.least(F.lit(1.0), p)


def tokens(text: Column) -> Column:
    """Estimate: words by white space, or a quarter of the characters if more."""
    gaps = F.length(text) - F.length(F.translate(text, " \n\t", ""))
    return F.greatest(F.lit(1), gaps + 1, F.floor(F.length(text) / 4)).cast("bigint")


def joined(texts: Column) -> Column:
    """The texts that are not empty, of an array."""
    return F.array_join(F.filter(texts, lambda x: F.coalesce(x, F.lit("")) != ""), SEPARATOR)


def joined_texts(texts: list[Column]) -> Column:
    """The same of columns. Unlike a filtered array this is compiled code, and as it
    names each column twice Spark works them out in a projection of their own."""
    return F.concat_ws(SEPARATOR, *[F.when(t != "", t) for t in texts])


def candidate_aggregates(over: Callable[[Column], Column] = lambda c: c) -> dict[str, Column]:
    """The picked candidates in their drawn order and the best line in words, as
    aggregates of a position's moves in one pass; ``over`` may put each over a window."""
    n = F.col("slot") - F.col("best_slot") + 1
    text = F.concat("uci", F.when(F.col("forcing"), F.lit(" (forcing)")).otherwise(F.lit("")))
    plies = F.array_sort(over(F.collect_list(F.when(n.between(1, EXPLAIN_MAX_PLIES), F.struct(n.alias("n"), text.alias("t"))))))
    return {"cands": F.array_sort(over(F.collect_list(F.when(F.col("picked"), F.struct(F.col("u_ord"), *CAND_FIELDS))))),
            "line_text": F.array_join(F.transform(plies, lambda x: x["t"]), "; ")}


def with_extras(rows: DataFrame) -> DataFrame:
    """Which candidates get a line, a motif, a trap note: a draw each, and at
    most so many per trace in candidate order."""
    def wants(name: str) -> Callable[[Column], Column]:
        p, best, _, styles = EXTRAS[name]
        have = {"pv": lambda c: c["pv"] != "", "motif": lambda c: F.lit(True), "trap": lambda c: c["trap_kind"].isNotNull()}[name]
        return lambda c: have(c) & (c[f"u_cand_{name}"] < F.least(F.lit(1.0), F.lit(p) * factor(F.col("style"), styles)
                                                                  * F.when(c["uci"] == F.col("best_uci"), best).otherwise(1.0)))

    for name in EXTRAS:
        rows = rows.withColumn(f"want_{name}", F.transform("cands", wants(name)))
    def first(wanted: Column, most: int) -> Column:
        return F.transform(wanted, lambda w, i: w & (F.size(F.filter(F.slice(wanted, F.lit(1), i + 1), lambda x: x)) <= most))

    return rows.withColumns({f"inc_{name}": first(F.col(f"want_{name}"), most) for name, (_, _, most, _) in EXTRAS.items()})


def paragraph(c: Column, i: Column) -> Column:
    behind = F.col("best_wp") - c["win_prob"]
    quality = (F.when(c["mate_in"] > 0, pick("quality_mate", c["u_quality"]))
               .when(c["mate_in"].isNotNull(), pick("quality_allows_mate", c["u_quality"]))
               .when(behind <= 0.02, pick("quality_best", c["u_quality"]))
               .when(behind <= 0.06, pick("quality_close", c["u_quality"]))
               .when(behind <= 0.12, pick("quality_inferior", c["u_quality"]))
               .otherwise(pick("quality_bad", c["u_quality"])))
    motif = F.coalesce(F.concat(F.lit(" Motif: "), F.replace(F.col("top_motif"), F.lit("_"), F.lit(" ")), F.lit(".")),
                       F.concat(F.lit(" It is rated "), c["category"], F.lit(".")))
    trap = F.concat(F.lit(" It "), F.when(c["trap_kind"] == "trap", F.lit("tempts, yet deeper search refutes it"))
                    .otherwise(F.lit("looks odd, yet deeper search supports it")), F.lit(" ("), c["confidence"], F.lit(")."))
    at = lambda name: F.element_at(F.col(f"inc_{name}"), i + 1)
    empty = F.lit("")
    return F.concat(c["uci"], F.lit(": "), quality, F.lit("."),
                    F.when(at("pv"), F.concat(F.lit(" Line: "), c["pv"], F.lit("."))).otherwise(empty),
                    F.when(at("motif"), motif).otherwise(empty), F.when(at("trap"), trap).otherwise(empty))


def with_codes(rows: DataFrame) -> DataFrame:
    """The choices behind the wording."""
    rows = with_phrases(with_extras(rows))
    n = F.size("cands")
    ranked = F.array_sort(F.transform("cands", lambda c, i: F.struct((-c["win_prob"]).alias("w"), i.alias("i"), c["uci"].alias("uci"))))
    worst = F.array_sort(F.transform("cands", lambda c, i: F.struct(c["win_prob"].alias("w"), i.alias("i"), c["uci"].alias("uci"))))
    theme = lambda kind: F.exists("themes", lambda t: F.lower(t).rlike("|".join(THEME_MARKERS[kind])))
    mover = F.when(F.col("side") == "w", F.lit("KQ")).otherwise(F.lit("kq"))
    may_castle = F.col("castling").contains(F.substring(mover, 1, 1)) | F.col("castling").contains(F.substring(mover, 2, 1))
    options = F.array_compact(F.array(F.when(may_castle, "castle"), F.when(F.col("passed_own"), "push_passed_pawn"),
                                      F.when(F.col("open_file"), "rook_to_open_file"),
                                      F.when(F.col("enemy_king_exposed"), "attack_king"), F.lit("improve_pieces")))
    line_p = F.lit(PV_PROB) * factor(F.col("style"), PV_STYLE)
    pressed = F.col("forced_mate") | F.col("only_move")
    rows = rows.withColumns({
        "n_cands": n, "paras": F.transform("cands", paragraph),
        "cand_ucis": F.transform("cands", lambda c: c["uci"]),
        "worst_uci": F.try_element_at(worst, F.lit(1))["uci"],
        "top1": F.try_element_at(ranked, F.lit(1))["uci"], "top2": F.try_element_at(ranked, F.lit(2))["uci"],
        "conclusion_pool": F.when(pressed, "firm").when(F.col("many_options"), "soft").otherwise("default"),
        "decision_frame": F.when(n >= 3, "three_way").when(n == 2, "two_way").otherwise("quick"),
        "orientation_code": F.when(F.col("opening_name").isNotNull(), "opening").when(F.col("phase") == "endgame", "endgame")
        .when(F.col("phase") == "opening", "opening_phase").otherwise("middlegame"),
        "context_code": F.when(theme("mate") | (F.coalesce(F.col("best_mate"), F.lit(0)) != 0), "mate")
        .when(theme("endgame") | (F.col("phase") == "endgame"), "endgame").when(theme("loose"), "loose")
        .when(theme("tactical"), "tactical").otherwise("generic"),
        "pv_gate": draw("pv_gate") < F.when(pressed, F.greatest(line_p, F.lit(PV_FORCED_MIN))).otherwise(line_p),
        "plan_option": F.element_at(options, F.floor(draw("plan_pick") * F.size(options)).cast("int") + 1)})
    failed = F.slice(F.filter("cand_ucis", lambda u: u != F.col("best_uci")), 1, 2)
    guess = F.try_element_at(F.col("cand_ucis"), F.floor(draw("guess_pick") * F.col("n_cands")).cast("int") + 1)
    rows = rows.withColumns({
        "failed_attempts": F.when(F.size(failed) > 0, F.array_join(failed, ",")),
        "initial_guess": F.when(draw("guess") < INITIAL_GUESS_BEST_PROB, F.col("best_uci")).otherwise(guess)})
    extra = {"opening_plan": F.col("opening_name").isNotNull(), "endgame_technique": F.col("phase") == "endgame",
             "dead_end": F.col("n_cands") >= 2, "comparison": F.col("n_cands") >= 2}
    rows = rows.withColumns({f"g_{k}": gate(k) & extra.get(k, F.lit(True)) for k in SECTION_PROBS})
    at = lambda prefix, code, u: drawn(u, F.size(texts_by(prefix, code)))
    return rows.withColumns({
        "ctx_phrase_idx": at("context_", F.col("context_code"), draw("ctx_phrase")),
        "concl_phrase_idx": at("conclusion_", F.col("conclusion_pool"), draw("concl_phrase"))})


def with_sections(rows: DataFrame) -> DataFrame:
    """``s_<name>`` for each section; empty where it is left out."""
    white = F.col("side") == "w"
    mover = F.when(white, F.lit("White")).otherwise(F.lit("Black"))
    opener = by_code(F.col("orientation_code"), {
        "opening": pick("opens_opening", draw("opens_phrase"), name=F.col("opening_short")),
        "endgame": pick("opens_endgame", draw("opens_phrase")), "opening_phase": pick("opens_phase", draw("opens_phrase"))})
    origin = by_code(F.col("source"), {s: pick(f"orient_{s}", draw("orient_phrase")) for s in ("game", "puzzle")})
    hint = phrase(texts_by("context_", F.col("context_code")), draw("ctx_phrase"))
    assess = F.coalesce(pick("tablebase", draw("tb_phrase"), result=F.col("tb_result")), by_code(F.col("assessment"), {
        k: pick(f"assess_{k}", draw("assess_phrase")) for k in ("balanced", "better", "worse")}), pick("assess_slight", draw("assess_phrase")))
    profile = F.when(F.col("forced_mate"), "mate").when(F.col("only_move"), "only").when(F.col("many_options"), "many").otherwise("few")
    threat = F.when(F.col("in_check"), "check").when(F.col("hang_own") > 0, "loose").otherwise("none")
    balance = F.when(F.col("mat_diff") == 0, "even").when(F.col("mat_diff") > 0, "white").otherwise("black")
    codes = {"material": balance, "structure": F.col("pawn_structure_code"), "king": F.col("king_safety_code"), "development": F.col("development")}
    notes = F.array(*[F.struct(draw(f"note_{k}").alias("u"), by_code(code, {c: F.lit(t) for c, t in NOTES[k].items()}).alias("t"))
                      for k, code in codes.items()])
    notes = F.slice(F.transform(F.array_sort(F.filter(notes, lambda x: x["t"].isNotNull())), lambda x: x["t"]), 1, MAX_STATIC_NOTES)
    ending = phrase(texts_by("conclusion_", F.col("conclusion_pool")), draw("concl_phrase"), move=F.col("best_uci"))
    main = F.when(F.col("pv_gate") & (F.coalesce("line_text", F.lit("")) != ""), pick("main_line", draw("line_phrase"), line=F.col("line_text"))).otherwise(F.lit(""))
    texts = {
        "orientation": F.concat_ws(" ", opener, origin, pick("side_to_move", draw("side_phrase"), mover=mover)),
        "opening_plan": pick("plans_opening", draw("plans_phrase"), family=F.col("family")),
        "fen_walkthrough": pick("walkthrough", draw("walk_phrase"), mover=mover, move=F.col("fullmove").cast("string")),
        "context_hint": hint, "assessment": assess,
        "decision_profile": phrase(texts_by("profile_", profile), draw("profile_phrase")),
        "static_eval": pick("snapshot", draw("snap_phrase"), notes=F.array_join(notes, " ")),
        "endgame_technique": pick("technique", draw("tech_phrase"), type=F.col("endgame_type")),
        "threat_scan": phrase(texts_by("threat_", threat), draw("threat_phrase")),
        "plan": pick("plan", draw("plan_phrase"), plan=F.replace(F.col("plan_option"), F.lit("_"), F.lit(" "))),
        "opponent": pick("opponent", draw("opp_phrase")),
        "candidates": pick("candidates", draw("cands_phrase"), moves=F.array_join("cand_ucis", ", ")),
        "avoid_blunder": pick("avoid", draw("avoid_phrase"), move=F.col("avoid_uci")),
        "exploration": joined(F.col("paras")),
        "reconsideration": pick("reconsider", draw("recon_phrase")),
        "dead_end": pick("dead_end", draw("dead_phrase"), move=F.col("worst_uci")),
        "comparison": pick("compare", draw("cmp_phrase"), first=F.col("top1"), second=F.col("top2")),
        "conclusion": F.concat(ending, main)}
    return rows.withColumns({f"s_{k}": F.coalesce(F.when(F.col(f"g_{k}"), v) if k in SECTION_PROBS else v, F.lit("")) for k, v in texts.items()})


def assembled(exploration: Column | None = None) -> Column:
    if exploration is None:
        return joined_texts([F.col(f"s_{k}") for k in SECTION_ORDER])
    return joined(F.array(*[exploration if k == "exploration" else F.col(f"s_{k}") for k in SECTION_ORDER]))


def with_budget(rows: DataFrame, budget: int | None = None) -> DataFrame:
    """``stage`` and ``trimmed``: the whole text if it fits or there is no budget
    (the default); else as many paragraphs as fit; else without paragraphs and the
    first optional sections in drop order; else the conclusion."""
    if budget is None:
        return rows.withColumn("stage", F.lit("full")).withColumn("trimmed", assembled())
    n = F.size("paras")
    fewer = F.transform(F.sequence(n, F.lit(0), F.lit(-1)), lambda j: F.struct(
        j.alias("j"), assembled(joined(F.slice("paras", F.lit(1), j))).alias("t")))
    fits = F.filter(fewer, lambda x: tokens(x["t"]) <= budget)
    place = {k: i for i, k in enumerate(DROP_ORDER)}
    left = F.array(*[F.struct(F.lit(place.get(k, len(DROP_ORDER))).alias("o"), F.col(f"s_{k}").alias("t"))
                     for k in SECTION_ORDER if k != "exploration"])
    dropped = F.transform(F.sequence(F.lit(0), F.lit(len(DROP_ORDER))), lambda d: joined(
        F.transform(F.filter(left, lambda x: x["o"] >= d), lambda x: x["t"])))
    small = F.filter(dropped, lambda t: tokens(t) <= budget)
    # the shorter forms are made only where the longer ones do not fit
    rows = rows.withColumn("_full", assembled())
    rows = rows.withColumn("_fit", F.when(tokens(F.col("_full")) <= budget, F.struct(n.alias("j"), F.col("_full").alias("t")))
                           .otherwise(F.try_element_at(fits, F.lit(1))))
    rows = rows.withColumn("_drop", F.when(F.col("_fit").isNull(), F.try_element_at(small, F.lit(1))))
    return rows.withColumns({
        "stage": F.when(F.col("_fit")["j"] == n, "full").when(F.col("_fit").isNotNull(), "popped")
        .when(F.col("_drop").isNotNull(), "dropped").otherwise("conclusion"),
        "trimmed": F.coalesce(F.col("_fit")["t"], F.col("_drop"), F.col("s_conclusion"))}).drop("_full", "_fit", "_drop")
