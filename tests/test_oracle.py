"""Every registered query against its DuckDB oracle (batch at sf0.01, streams at sf0.001)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE, SF_SMALL
from oracle_compare import compare, duck

# The training-data queries have their own tests (tests/llm).
QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.LLM_QUERIES}
SQL = {k: v for k, v in entry.oracle_sql().items() if k not in entry.LLM_QUERIES}


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


@pytest.fixture(scope="module")
def cons():
    return {SF_ORACLE: duck(SF_ORACLE), SF_SMALL: duck(SF_SMALL)}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, cons, name):
    sf = SF_SMALL if name.startswith("stream_") else SF_ORACLE
    n, problems = compare(QUERIES[name](spark, sf), cons[sf], SQL[name])
    assert not problems, f"{name}: {problems}"
    assert n > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "name", "gender", "score", "rn"]
    assert df.count() > 0
    assert dict(df.dtypes)["rn"] == "bigint"
