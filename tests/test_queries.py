"""Every registered query against its SQL, and the driver's entry points."""

from __future__ import annotations

import pytest
from oracle_check import assert_same, duck

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.01"
# Operators for training text have tests of their own.
LLM = {n for n in contract.queries() if n.startswith("op") or n == "pipeline"}
QUERIES = sorted(set(contract.queries()) - LLM)
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, con, name):
    found = contract.queries()[name](spark, SF_DIR)
    relation = con.sql(contract.oracle_sql()[name])
    wanted_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in found.schema} == wanted_types
    wanted = relation.df()
    assert len(wanted) > 0
    assert_same(found.toPandas(), wanted)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 1500
    assert df.columns[-2:] == ["year", "month"]
