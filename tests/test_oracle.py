"""Every query against DuckDB on the smallest tables; those with a fitted model by their rows alone."""

import pytest

import __spark_entry__ as entry
from oracle.sql import ORACLES
from pulsegrid.catalog import QUERIES

from .oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"flagship"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_duckdb(spark, con, name):
    rows, differing, message = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert differing == 0 and rows > 0, message


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["caseid", "Risk Predicted", "n", "share"] and rows.count() > 0
