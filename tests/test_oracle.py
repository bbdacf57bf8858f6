"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE
from oracle_check import compare, duck

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


#: The training-data queries have their own tests and may have no SQL.
LLM = set(llm.queries()) if (llm := entry._llm()) else set()


def test_every_query_has_an_oracle():
    assert set(QUERIES) - LLM == set(ORACLE) - LLM
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLE)))
def test_query_matches_oracle(spark, con, name):
    n, problems = compare(spark, con, SF_ORACLE, name, QUERIES[name], ORACLE[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "validation_errors_text"]
    assert df.count() > 0
