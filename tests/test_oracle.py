"""Every registered query that SQL can express, value by value against DuckDB; the others must run and return rows."""

import os

import pytest

import compare
from farol.queries.catalog import ORACLES, QUERIES

SF = os.environ.get("FAROL_ORACLE_SF", "sf0.001")
DATA = os.environ.get("FAROL_TEST_DATA", "/root/testdata")
# Fits of several models each; exercised with a gate in test_models.py.
SLOW = {"m6_svm_calibrated", "v20_learning_curve"}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(f"{DATA}/{SF}")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert compare.difference(QUERIES[name](spark, f"{DATA}/{SF}"), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_runs(spark, name):
    df = QUERIES[name](spark, f"{DATA}/{SF}")
    assert df.count() >= 0
    assert len(set(df.columns)) == len(df.columns)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_returns_bands(spark):
    import __spark_entry__ as e
    rows = e.entry(spark).collect()
    assert {r["faixa_triagem"] for r in rows} <= {"VERDE", "AMARELO", "VERMELHO"}
    assert sum(r["n"] for r in rows) == 1500
    assert all(r["recall"] >= 0.99 for r in rows)
