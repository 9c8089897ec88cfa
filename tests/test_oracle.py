"""Every registered query against its DuckDB oracle at sf0.001
(row count, column names and an order-insensitive value hash)."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import digest, duck  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[key])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(rel.columns, drows)[0]


def test_every_key_of_the_library_has_an_oracle():
    from rookery.plans.registry import ORACLE as sql
    from rookery.plans.registry import QUERIES as keys
    assert set(keys) == set(sql)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
