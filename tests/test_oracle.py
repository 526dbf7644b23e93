"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    problems, _, _ = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert not problems, "\n".join(problems)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "subtotal_mismatch" in df.columns
