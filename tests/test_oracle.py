"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF
from tests.oracle_compare import compare

NAMES = sorted(E.oracle_sql())


def test_every_query_has_sql_or_is_declared_rows_only():
    rows_only = set(E.queries()) - set(E.oracle_sql())
    # training-data queries without SQL are tested against brute force in tests/llm
    assert {n for n in rows_only if n != "pipeline" and not n.startswith("op")} == set()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res[0] in ("ok", "rows-only"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                          "o_orderpriority"]
    assert df.count() > 0
