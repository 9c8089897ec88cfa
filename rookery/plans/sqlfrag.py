"""DuckDB SQL fragments mirroring the Column functions (oracle side only)."""

from __future__ import annotations

from rookery.functions import text as T
from rookery.functions.casts import INT_PATTERN
from rookery.functions.draws import sql_uniform


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> '')"


def clean_movetext(x: str) -> str:
    s = f"coalesce({x}, '')"
    for pat in (T.MOVETEXT_COMMENT, T.MOVETEXT_NUMBER, T.MOVETEXT_RESULT, T.MOVETEXT_NAGS):
        s = f"regexp_replace({s}, {q(pat)}, '', 'g')"
    return s


def parse_movetext(x: str) -> str:
    return tokens(clean_movetext(x))


def parse_movetext_rl(x: str) -> str:
    s = f"coalesce({x}, '')"
    for pat in (T.MOVETEXT_COMMENT, T.MOVETEXT_NUMBER_RL, T.MOVETEXT_RESULT_RL):
        s = f"regexp_replace({s}, {q(pat)}, '', 'g')"
    return tokens(s)


def first_invalid_index(arr: str, pattern: str) -> str:
    return (f"list_min(list_filter(list_transform({arr}, lambda t, i: CASE WHEN NOT "
            f"regexp_matches(t, {q(pattern)}) THEN CAST(i - 1 AS INT) END), lambda i: i IS NOT NULL))")


def safe_int(x: str, default) -> str:
    d = "NULL" if default is None else str(int(default))
    return (f"CAST(coalesce(CASE WHEN regexp_matches(CAST({x} AS VARCHAR), {q(INT_PATTERN)}) "
            f"THEN CAST(trim(CAST({x} AS VARCHAR)) AS BIGINT) END, {d}) AS INT)")


def rating_or_default(x: str, default: int = 1500) -> str:
    v = f"CAST({x} AS VARCHAR)"
    return (f"(CASE WHEN {v} IS NULL OR {v} = '' OR {v} = '0' THEN {default} "
            f"ELSE {safe_int(x, default)} END)")


def uniform(seed, *keys: str) -> str:
    return sql_uniform(seed, *keys)


def join_str(arr: str, sep: str) -> str:
    return f"array_to_string({arr}, {q(sep)})"
