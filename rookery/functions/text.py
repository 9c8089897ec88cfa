"""String expressions: movetext cleaning, tag extraction, token estimates.

All are Spark built-ins (regexp_replace / regexp_extract / split / filter),
so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Movetext cleaner (dataset generation): comments, move numbers with trailing
# space, a trailing result, and ?/! annotation runs are removed.
MOVETEXT_COMMENT = r"\{[^}]*\}"
MOVETEXT_NUMBER = r"\d+\.+\s*"
MOVETEXT_RESULT = r"(1-0|0-1|1/2-1/2|\*)\s*$"
MOVETEXT_NAGS = r"\?+|!+"
# RL variant: move numbers without the trailing space, result only at the very
# end of the string, annotation marks kept.
MOVETEXT_NUMBER_RL = r"\d+\.+"
MOVETEXT_RESULT_RL = r"(1-0|0-1|1/2-1/2|\*)$"
# Structural token shapes.
UCI_MOVE = r"^[a-h][1-8][a-h][1-8][qrbn]?$"
SAN_MOVE = r"^([NBRQK]?[a-h]?[1-8]?x?[a-h][1-8](=[NBRQ])?|O-O(-O)?)[+#]?$"
# Model-output tags.
MOVE_STRICT = r"<uci_move>([a-h][1-8][a-h][1-8][qrbn]?)</uci_move>"
MOVE_LENIENT = r"(?i)<uci_move>\s*([a-h][1-8][a-h][1-8][qrbn]?)\s*</uci_move>"
FEN_IN_PROMPT = r"FEN:\s*([^\n]+)"
FORMAT_PATTERN = r"(?i)<think>[\s\S]*?</think>\s*<uci_move>[a-h][1-8][a-h][1-8][qrbn]?</uci_move>"
GENERATION_PREFIX = "<think>\n"
THINK_BLOCK = r"(?s)<think>(.*?)</think>"
MOVE_ANY = r"<uci_move>(\S+)</uci_move>"
# Prompt templates (SFT and RL share the first; the minimal RL variant uses a
# system message and the short user line).
PROMPT_TEMPLATE = (
    "You are an expert chess player. Choose the best move.\n"
    "FEN: {fen}\n"
    "Legal moves (UCI): {legal_moves}\n"
    "\n"
    "Rules:\n"
    "- Put all reasoning inside <think>...</think>.\n"
    "- Output exactly one <uci_move>...</uci_move> tag with a single move copied from the legal moves list "
    "(no spaces).\n"
    "- Do not output anything after the closing </uci_move>.\n"
    "- Do not output \"resign\".\n"
    "\n"
    "Output format:\n"
    "<think>...</think>\n"
    "<uci_move>...</uci_move>\n"
)
SYSTEM_CONTENT = (
    "You are an expert chess player. Analyze the position and choose the best move.\n"
    "Rules:\n"
    "- Put all reasoning inside <think>...</think>.\n"
    "- Output exactly one <uci_move>...</uci_move> tag with a single move.\n"
    "- Do not output anything after </uci_move>.\n"
    "Output format:\n"
    "<think>...</think>\n"
    "<uci_move>...</uci_move>"
)
USER_TEMPLATE_MINIMAL = "FEN: {fen}\nLegal moves (UCI): {legal_moves}\n\nChoose the best move."
COMPLETION_TEMPLATE = "<think>{trace}</think>\n<uci_move>{move}</uci_move>"
# --- end of fixed values -----------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text) -> Column:
    """Whitespace split with empty strings removed (Spark keeps them)."""
    return F.filter(F.split(_c(text), r"\s+"), lambda t: t != "")


def clean_movetext(movetext) -> Column:
    s = F.coalesce(_c(movetext), F.lit(""))
    s = F.regexp_replace(s, MOVETEXT_COMMENT, "")
    s = F.regexp_replace(s, MOVETEXT_NUMBER, "")
    s = F.regexp_replace(s, MOVETEXT_RESULT, "")
    s = F.regexp_replace(s, MOVETEXT_NAGS, "")
    return s


def parse_movetext(movetext) -> Column:
    """SAN token array of a movetext string."""
    return tokens(clean_movetext(movetext))


def parse_movetext_rl(movetext) -> Column:
    s = F.coalesce(_c(movetext), F.lit(""))
    s = F.regexp_replace(s, MOVETEXT_COMMENT, "")
    s = F.regexp_replace(s, MOVETEXT_NUMBER_RL, "")
    s = F.regexp_replace(s, MOVETEXT_RESULT_RL, "")
    return tokens(s)


def first_invalid_index(arr, pattern: str) -> Column:
    """0-based index of the first element not matching ``pattern``; NULL if all match."""
    idx = F.transform(_c(arr), lambda t, i: F.when(~t.rlike(pattern), i))
    return F.array_min(F.filter(idx, lambda i: i.isNotNull()))


def valid_prefix(arr, pattern: str) -> Column:
    """Elements before the first non-matching one (a generator ``break``)."""
    a = _c(arr)
    stop = first_invalid_index(a, pattern)
    return F.when(stop.isNull(), a).otherwise(F.slice(a, 1, stop))


def approx_tokens(text) -> Column:
    """``max(1, max(spaces + newlines + tabs + 1, floor(len/4)))``."""
    t = F.coalesce(_c(text), F.lit(""))
    ws = F.length(t) - F.length(F.translate(t, " \n\t", ""))
    return F.greatest(F.lit(1), ws + 1, F.floor(F.length(t) / 4).cast("int"))


def extract_move_strict(text) -> Column:
    m = F.regexp_extract(_c(text), MOVE_STRICT, 1)
    return F.when(m == "", F.lit(None).cast("string")).otherwise(m)


def extract_move_lenient(text) -> Column:
    m = F.regexp_extract(_c(text), MOVE_LENIENT, 1)
    return F.when(m == "", F.lit(None).cast("string")).otherwise(F.lower(m))


def extract_fen(prompt) -> Column:
    m = F.regexp_extract(_c(prompt), FEN_IN_PROMPT, 1)
    return F.when(_c(prompt).rlike(FEN_IN_PROMPT), F.trim(m))


def prefix_completion(completion) -> Column:
    return F.concat(F.lit(GENERATION_PREFIX), F.coalesce(_c(completion), F.lit("")))


def fill(template: str, **cols) -> Column:
    """Render a ``{name}`` template with string columns (one concat)."""
    import re as _re
    parts = []
    pos = 0
    for m in _re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(F.coalesce(_c(cols[m.group(1)]).cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def split_response(text) -> tuple[Column, Column]:
    """(reasoning inside the first think block, trimmed; move in the first
    uci_move tag). NULL when absent."""
    t = _c(text)
    reasoning = F.when(t.rlike(THINK_BLOCK), strip_ws(F.regexp_extract(t, THINK_BLOCK, 1)))
    move = F.when(t.rlike(MOVE_ANY), strip_ws(F.regexp_extract(t, MOVE_ANY, 1)))
    return reasoning, move


def close_tag(text) -> Column:
    t = _c(text)
    return F.when((F.instr(t, "<uci_move>") > 0) & (F.instr(t, "</uci_move>") == 0),
                  F.concat(t, F.lit("</uci_move>"))).otherwise(t)


def replace_word_keep_case(text, target: str, replacement: str) -> Column:
    """Whole-word, case-insensitive replace; ALL-CAPS and Capitalised forms
    keep their shape (three ordered passes)."""
    t = _c(text)
    t = F.regexp_replace(t, r"\b" + target.upper() + r"\b", replacement.upper())
    t = F.regexp_replace(t, r"\b" + target[:1].upper() + "(?i:" + target[1:] + r")\b", replacement.capitalize())
    return F.regexp_replace(t, r"(?i)\b" + target + r"\b", replacement)


def strip_ws(text) -> Column:
    """Strip leading/trailing whitespace of any kind (``str.strip``)."""
    return F.regexp_replace(_c(text), r"^\s+|\s+\z", "")


def lines_of(text) -> Column:
    """``str.splitlines`` for newline-separated text (a trailing newline does
    not start an extra line; empty text has no lines)."""
    t = F.regexp_replace(F.coalesce(_c(text), F.lit("")), r"\n\z", "")
    return F.when(F.coalesce(_c(text), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(t, "\n"))


def prefix_lines(text, prefix) -> Column:
    """Prefix every non-blank line; blank lines become empty."""
    p = _c(prefix) if not isinstance(prefix, str) else F.lit(prefix)
    return F.array_join(F.transform(lines_of(text), lambda ln: F.when(ln.rlike(r"^\s*$"), F.lit(""))
                                    .otherwise(F.concat(p, ln))), "\n")
