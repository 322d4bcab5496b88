"""Every registered query equals its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import pytest

from scripts.check_oracle import compare, duck

import __spark_entry__ as E

from orderflow.plans.oracle import ORACLE
from orderflow.plans.registry import QUERIES

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, QUERIES[name], ORACLE.get(name), SF_SMALL, con)
    assert name in ORACLE, "every registered query has an oracle"
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["schema_ok"], res
    assert res["hash_ok"], res
    assert "type_diff" not in res, res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["order_id", "gk_id", "location", "order_day", "order_revenue",
                          "total_qty", "total_items", "brands_in_order"]
    assert df.count() > 0
