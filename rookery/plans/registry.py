"""Query registry: key -> (Spark builder, DuckDB oracle SQL).

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's tables. The oracle is standalone SQL over the same tables (the
``fx_*`` views are inlined as CTEs); it is omitted for rows-only keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so its queries register themselves."""
    import importlib
    import pkgutil

    import rookery.plans as pkg

    for mod in pkgutil.iter_modules(pkg.__path__):
        if mod.name.startswith("q_"):
            importlib.import_module(f"rookery.plans.{mod.name}")
