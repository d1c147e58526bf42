"""Every registered query against its DuckDB SQL on the smallest tables."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare

SF = "/root/testdata/sf0.001"
MAY_BE_EMPTY = {"duplicate_ids", "within_radius"}  # no such rows need be in the smallest tables


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["hour", "count"] and df.count() >= 0


def test_every_query_has_a_name_and_sql_names_exist():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 100


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF, verbose=False)


def test_all_queries_match_oracle(results):
    bad = {k: v for k, v in results.items() if v[0] not in ("OK", "rows-only") or v[1] == 0 and k not in MAY_BE_EMPTY and not k.startswith("op")}
    assert not bad, bad
