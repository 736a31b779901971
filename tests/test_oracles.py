"""Every query with an oracle gives its rows; every other gives rows at all."""

from __future__ import annotations

import pytest

from sablefin import catalog
from tests.oracle import assert_same

#: Feeds too small for an alert at this scale.
MAY_BE_EMPTY = {"set_intersect", "set_except", "semi_join_cells", "r01_structuring", "r03_round_dollar"}


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_oracle(spark, sf, name):
    n = assert_same(catalog.QUERIES[name](spark, sf), catalog.ORACLE_SQL[name], sf)
    assert n or name in MAY_BE_EMPTY


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_rows(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["rule_id", "customer_id", "period", "metric_value", "alert_amount", "txn_count"]
