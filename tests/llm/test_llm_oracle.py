"""Corpus queries that SQL can express equal their SQL on the test tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, duckdb_con
from revmart.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, name):
    sf_dir = os.path.join("/root/testdata", os.environ.get("REVMART_ORACLE_SF", "sf0.01"))
    ok, message = compare(registry.QUERIES[name](spark, sf_dir), duckdb_con(sf_dir), registry.ORACLE[name])
    assert ok, message


def test_all_operators_are_registered():
    numbers = {n.split("_")[0] for n in registry.QUERIES}
    assert numbers == {f"op{k}" for k in range(1, 14)}
    assert set(registry.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(registry.ORACLE) <= set(entry.oracle_sql())
