"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from medallion.checks.compare import compare_frames, duck_connection
from tests.conftest import SF_SMALL

# The training-data queries have their tests in tests/llm.
OWN = {n: q for n, q in queries().items() if not n.startswith("op") or not n[2:3].isdigit()}
OWN.pop("pipeline", None)
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, duck, name):
    res = compare_frames(OWN[name](spark, SF_SMALL), duck, ORACLE[name])
    assert res["columns_match"] and res["hash_match"], res


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["order_id", "quantity", "unit_price", "order_value_khr"]
    assert df.count() > 0
