"""Physical-plan properties that matter at scale."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_filter_and_pruning_reach_the_scan(spark):
    plan = _plan(entry.queries()["join_lookup"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,ScalarSubquery" in plan
    assert "o_totalprice" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_surrogate_key_uses_range_partitioning_not_a_global_window(spark):
    from quarry.operators.keys import surrogate_key

    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    keyed = surrogate_key(o, ["o_orderdate", "o_orderkey"])
    plan = _plan(keyed)
    # the only window left runs over one row per partition (the offsets)
    assert "row_number" not in plan


def test_admission_has_no_window_over_slots(spark):
    plan = _plan(entry.queries()["admit_bookings"](spark, SF_SMALL))
    assert "Window" not in plan


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_no_cartesian_or_nested_loop_joins(spark, key):
    plan = _plan(entry.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_bucketed_reassembly_needs_no_shuffle(spark):
    import uuid

    from quarry.operators import clean as cl
    from quarry.session import scratch_path

    df = spark.range(20_000).selectExpr("id AS row_id", "id % 7 AS a", "id % 11 AS b")
    parts = {"pa": df.select("row_id", "a"), "pb": df.select("row_id", "b")}
    stored = cl.store_bucketed(parts, f"quarry_t{uuid.uuid4().hex[:8]}", scratch_path(spark, "bucket_test"),
                               key="row_id", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(cl.reassemble(stored, key="row_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    assert "hashpartitioning(row_id" not in plan
