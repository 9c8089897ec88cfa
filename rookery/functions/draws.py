"""Keyed pseudo-random draws.

Every random choice in the engine is a pure function of ``(seed, keys)``:
``sha256("seed|k1|k2...")`` -> first 13 hex digits (52 bits) -> ``/ 2**52``.
The value is exact in a double, independent of partitioning, task retries and
row order, and identical in DuckDB (see ``sql_uniform``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = 4503599627370496.0


def _key(*keys) -> Column:
    cols = [k if isinstance(k, Column) else F.lit(str(k)) for k in keys]
    return F.concat_ws("|", *[c.cast("string") for c in cols])


def hash_uniform(seed, *keys) -> Column:
    """u in [0, 1) drawn from ``seed`` and the row keys."""
    digest = F.sha2(_key(seed, *keys), 256)
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(TWO_POW_52)


def sql_uniform(seed, *keys: str) -> str:
    """DuckDB expression equal to :func:`hash_uniform` (keys are SQL text)."""
    parts = ", ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return (f"(('0x' || substr(sha256(concat_ws('|', {parts})), 1, 13))::BIGINT"
            f" / {TWO_POW_52}::DOUBLE)")
