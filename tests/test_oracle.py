"""Every registered query against its DuckDB oracle on sf0.001 (the driver's
gate runs the same comparison on sf0.01)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from helpers import SF_SMALL
from oracle_check import compare, duck
from touchline.plans.queries import REGISTRY

ORACLE = E.oracle_sql()
SLOW = {"outcome_model"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if n not in SLOW))
def test_query_matches_oracle(spark, con, name):
    out = compare(spark, SF_SMALL, name, E.queries()[name], ORACLE.get(name), con)
    assert out["spark_rows"] > 0, out
    if ORACLE.get(name) is not None:
        assert out["cols"] and out["values"], out


def test_every_query_but_the_model_has_an_oracle():
    assert set(REGISTRY) - set(ORACLE) == {"outcome_model"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "league_position" in df.columns


def test_outcome_model_trains(spark):
    df = E.queries()["outcome_model"](spark, SF_SMALL)
    rows = df.collect()
    assert rows and 0.0 <= rows[0].test_accuracy <= 1.0
    assert {r.prediction for r in rows} <= {0.0, 1.0, 2.0}
