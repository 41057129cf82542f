"""Every registered query equals its DuckDB oracle on sf0.001 (the driver
runs the same check at sf0.01: ``REVMART_ORACLE_SF=sf0.01 pytest tests/test_oracle.py``)."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, duckdb_con
from revmart.plans import catalog

QUERIES = catalog.QUERIES
ORACLE = catalog.ORACLE


@pytest.fixture(scope="module")
def sf_dir():
    return os.path.join("/root/testdata", os.environ.get("REVMART_ORACLE_SF", "sf0.001"))


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_con(sf_dir)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    ok, msg = compare(QUERIES[name](spark, sf_dir), con, ORACLE[name])
    assert ok, f"{name}: {msg}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["nu_media_reviews_app", "nu_versao_app", "nu_quantidade_usuarios", "pt_ano_mes"]
    assert df.count() > 0
