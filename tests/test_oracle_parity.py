"""Every SQL-backed registered key equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as ent
from compare import duck, same
from conftest import SF_SMALL

SQL = ent.oracle_sql()
SLOW = {"smote_class_counts", "smote_neighbors"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", [k for k in SQL if k not in SLOW])
def test_key_matches_oracle(spark, con, key):
    same(ent.queries()[key](spark, SF_SMALL), con, SQL[key])


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.columns == ["type_name", "total_transactions", "fraud_count", "fraud_rate_pct",
                          "total_volume", "fraud_volume"]
    assert df.count() == 5


def test_every_key_has_a_callable():
    assert set(SQL) <= set(ent.queries())
