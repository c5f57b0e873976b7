"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry
from daybook.registry import all_queries  # noqa: E402
from compare import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), ORACLES[name], con)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["numcta", "amount", "saldo", "numcta2", "resta"]
    assert df.count() >= 0
