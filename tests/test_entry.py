"""The driver contract: entry(), queries(), oracle_sql() — checked against DuckDB on sf0.001."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_mod
from conftest import SMOKE_SF

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_SF), reason="test data not present")


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "clinical_risk_flag" in df.columns


CLAIMS = sorted(set(entry_mod.queries()) - set(entry_mod.LLM_QUERIES))


def test_every_claims_query_has_an_oracle():
    assert set(CLAIMS) == set(entry_mod.oracle_sql()) - set(entry_mod.LLM_QUERIES)
    assert len(CLAIMS) >= 32


@pytest.fixture(scope="module")
def duck():
    from oracle_check import duck as connect

    return connect(SMOKE_SF)


@pytest.mark.parametrize("key", CLAIMS)
def test_query_matches_oracle(spark, duck, key):
    from oracle_check import compare

    ok, msg = compare(spark, duck, SMOKE_SF, key, entry_mod.queries()[key], entry_mod.oracle_sql()[key])
    assert ok, msg
