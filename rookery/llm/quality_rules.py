"""Quality rules by repetition coverage.

Rolling hashes of every run of 5 to 10 words find the runs that a text repeats;
the measure is the share of its word characters inside later copies of such
runs, and inside lines equal to an earlier line.

Defined results: a null or blank text has no words and fails; each row is
judged alone, so repeated rows get the same verdict; an empty table gives an
empty result; input columns named like a new one are replaced. A run is
compared by a 64-bit hash within its own text only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rookery.llm import words as W
from rookery.llm.cluster import map_texts

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

BASE_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars"]


@dataclass(frozen=True)
class Limits:
    """A text is rejected when a share is above its limit."""
    min_words: int = 10
    repeat_words: float = 0.20                     # words in 5-word runs found twice or more
    gram_chars: tuple = ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10))
    line_chars: float = 0.20                       # word characters in lines equal to an earlier line
    lines: float = 0.30                            # such lines of all lines with a word
    symbols: float = 0.10                          # symbols a word


def _covered(n: int, at: np.ndarray, k: int) -> np.ndarray:
    """Words inside the runs of ``k`` words that start at ``at``."""
    d = np.bincount(at, minlength=n + k + 1)[:n + 1] - np.concatenate([np.zeros(k, int), np.bincount(at, minlength=n + 1)])[:n + 1]
    return np.cumsum(d)[:n] > 0


def _repeats(t: W.Texts, h: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the ``k``-word runs that their text holds twice or more, and
    of those among them that are not the first."""
    at = t.inside(k)
    if not len(at):
        return at, at
    key = W.grams(h, k)[at] ^ W.mix(owner[at].astype(np.uint64))
    s = np.sort(key)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return at[:0], at[:0]
    p = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    hit = twice[p] == key
    every, group = at[hit], p[hit]
    _, first = np.unique(group, return_index=True)
    later = np.ones(len(every), dtype=bool)
    later[first] = False
    return every, every[later]


def _lines(text: bytes) -> tuple[int, int, int]:
    """Lines with a word, those equal to an earlier one, word characters in the latter."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    chars = 0
    if dup:
        seen: set[bytes] = set()
        for x in lines:
            if x in seen:
                chars += len(b"".join(x.split()).decode("utf-8", "replace"))
            seen.add(x)
    return len(lines), dup, chars


def measure(column: pa.Array, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """Per text: BASE_FIELDS, then the word characters inside later copies of
    repeated runs for each length."""
    out: list[list[np.ndarray]] = []
    for t in W.texts(column):
        n, owner, h = len(t), t.owner, t.hashes()
        points = np.concatenate([[0], np.cumsum((t.buf & 0xC0) != 0x80)])
        chars = (points[t.ends] - points[t.starts]).astype(np.float64)
        symbols = np.concatenate([[0], np.cumsum(SYMBOLS[t.buf])])
        per = lambda mask: np.bincount(owner[mask], weights=chars[mask], minlength=n).astype(np.int64)
        lines = np.array([_lines(t.bytes(i)) for i in range(n)], dtype=np.int64).reshape(n, 3)
        every, _ = _repeats(t, h, owner, 5)
        cols = [t.counts.astype(np.int64), per(np.ones(len(h), dtype=bool)),
                symbols[t.offsets[1:]] - symbols[t.offsets[:-1]], lines[:, 1],
                np.bincount(owner[_covered(len(h), every, 5)], minlength=n), lines[:, 0], lines[:, 2]]
        for k in lengths:
            _, later = _repeats(t, h, owner, k)
            cols.append(per(_covered(len(h), later, k)))
        out.append(cols)
    return [np.concatenate([c[i] for c in out]).astype(np.int64) for i in range(len(BASE_FIELDS) + len(lengths))]


def quality_rules(df: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                  limits: Limits = Limits()) -> DataFrame:
    """``keep`` (default: all columns) with the measures of each whole text,
    ``base_failed`` and ``kept``. The comparisons are on integers."""
    lengths = tuple(k for k, _ in limits.gram_chars)
    names = BASE_FIELDS + [f"dup_chars_{k}" for k in lengths]
    fields = T.StructType([T.StructField(n, T.LongType()) for n in names])
    out = map_texts(df, text_col, fields, lambda c: [pa.array(x) for x in measure(c, lengths)], keep)

    def above(part: str, whole: str, share: float):
        return F.lit(100) * F.col(part) > F.lit(round(100 * share)) * F.col(whole)

    failed = (F.col("n_words") < limits.min_words) | above("n_repeat_words", "n_words", limits.repeat_words)
    method = (above("dup_line_chars", "word_chars", limits.line_chars) | above("n_dup_lines", "n_lines", limits.lines)
              | above("n_symbols", "n_words", limits.symbols))
    for k, share in limits.gram_chars:
        method = method | above(f"dup_chars_{k}", "word_chars", share)
    return out.withColumn("base_failed", failed).withColumn("kept", ~(failed | method))
