"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

import pytest

import __spark_entry__ as entry_mod
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.01"
ORACLES = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    n, problems = compare(spark, con, name, entry_mod.queries()[name], ORACLES[name], SF)
    assert not problems, f"{name}: {problems}"


@pytest.mark.parametrize("name", sorted(set(entry_mod.queries()) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    df = entry_mod.queries()[name](spark, SF)
    assert df.count() >= 0


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["tenant_id", "session_id", "window_end", "feature_window"]
