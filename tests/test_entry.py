"""The driver contract: entry runs, every oracle key is a query key, and every
oracle matches its Spark query on sf0.001 (the driver checks sf0.01)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_check import compare


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["row_label", "patient_name", "doctor_name"]


def test_oracles_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_oracle_matches(spark, duck_small, key):
    df = entry.queries()[key](spark, SF_SMALL)
    assert compare(df, duck_small.sql(entry.oracle_sql()[key])) is None
