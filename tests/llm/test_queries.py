"""Registered pipeline queries against their DuckDB SQL on the sf0.001 tables."""

import pytest
from oracle_compare import compare, duck

from curata.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    problems, _, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert not problems, "\n".join(problems)


def test_names():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == sorted(int(n[2:].split("_")[0]) for n in QUERIES)
