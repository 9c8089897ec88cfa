"""Score conventions as Column expressions (JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Move-quality category edges on cp_loss (inclusive upper bounds).
CATEGORY_EDGES = [(0, "best move"), (10, "excellent"), (30, "good"),
                  (50, "slight inaccuracy"), (100, "inaccuracy"), (200, "mistake")]
CATEGORY_ELSE = "blunder"
MATE_WIN_LABEL = "winning mate"
# cp -> win probability: base-10 logistic with scale 400.
WIN_PROB_SCALE = 400.0
# RL fallback expectation: natural logistic with scale 300, mates at +-10000.
EXPECTATION_SCALE = 300.0
RL_MATE_CP = 10000
# --- end of fixed values -----------------------------------------------------


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def win_probability(cp) -> Column:
    """``1 / (1 + 10^(-cp/400))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), -col(cp) / F.lit(WIN_PROB_SCALE)))


def categorize_move(cp_loss, mate_in) -> Column:
    """Quality label. Any non-positive mate (including 0) is a blunder and a
    negative cp_loss falls in the first bucket below 0 -> 'excellent'."""
    cl, mi = col(cp_loss), col(mate_in)
    expr = F.when(mi.isNotNull() & (mi > 0), F.lit(MATE_WIN_LABEL)).when(
        mi.isNotNull(), F.lit(CATEGORY_ELSE))
    first = True
    for edge, label in CATEGORY_EDGES:
        cond = (cl == edge) if first else (cl <= edge)
        expr = expr.when(cond, F.lit(label))
        first = False
    return expr.otherwise(F.lit(CATEGORY_ELSE))


def score_expectation(cp, scale: float = EXPECTATION_SCALE) -> Column:
    """Natural-exponent logistic expectation; NULL score -> 0.5."""
    c = col(cp)
    return F.when(c.isNull(), F.lit(0.5)).otherwise(
        F.lit(1.0) / (F.lit(1.0) + F.exp(-c / F.lit(float(scale)))))


def normalized_score(cp, mate_in) -> Column:
    """Clamp ``cp/1000`` into [-1, 1]; mates are +-1."""
    c, m = col(cp), col(mate_in)
    return (F.when(m.isNotNull() & (m > 0), F.lit(1.0))
            .when(m.isNotNull(), F.lit(-1.0))
            .otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c / F.lit(1000.0)))))


def score_label(cp, mate_in) -> Column:
    """``M<n>`` for mates, else signed centipawns ``+35cp`` / ``-12cp``."""
    c, m = col(cp), col(mate_in)
    return F.when(m.isNotNull(), F.concat(F.lit("M"), m.cast("string"))).otherwise(
        F.concat(F.when(c >= 0, F.lit("+")).otherwise(F.lit("")), c.cast("string"), F.lit("cp")))
