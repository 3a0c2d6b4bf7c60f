"""The driver contract: entry() runs, and every registered query matches its
DuckDB oracle on the smallest scale factor."""

import pytest

from oracle_check import check, duck

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                          "o_orderpriority"]
    assert df.count() == 1500 + 1500 // 50


def test_every_query_has_an_oracle():
    from lodestone.plans.queries import all_oracles, all_queries
    assert set(all_queries()) == set(all_oracles())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def _names():
    import sys
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    from lodestone.plans.queries import all_queries
    return sorted(all_queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    r = check(spark, name, SF, con)
    assert r["match"], r
