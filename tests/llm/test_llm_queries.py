"""Queries with SQL against that SQL."""

from __future__ import annotations

import pytest
from oracle_check import assert_same, duck

from querymill.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    wanted = duck(SF_DIR).sql(ORACLE[name]).df()
    longs = {f.name: "Int64" for f in found.schema if f.dataType.simpleString() in ("int", "bigint")}
    assert_same(found.toPandas().astype(longs), wanted.astype(longs))


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
