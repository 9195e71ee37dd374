import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows_of
from tidemark.operators.changes import DiffLimits, compared_hashes, market_regions, new_rows
from tidemark.operators.transforms import with_row_hash

PATHS = [
    DiffLimits(),
    DiffLimits(broadcast=0),
    DiffLimits(broadcast=0, shuffle=0),
    DiffLimits(broadcast=0, shuffle=0, hot=1),
]


@pytest.mark.parametrize("path", PATHS)
def test_same_copy_gives_nothing(spark, customers, path):
    rows = with_row_hash(customers)
    assert new_rows(rows, rows, path).isEmpty()


@pytest.mark.parametrize("path", PATHS)
def test_empty_previous_gives_all(spark, customers, path):
    rows = with_row_hash(customers)
    assert rows_of(new_rows(rows, rows.limit(0), path).drop("hash")) == rows_of(customers)


def test_no_previous_needs_no_shuffle(spark, customers):
    plan = plan_of(new_rows(with_row_hash(customers), None))
    assert "Exchange" not in plan and "Join" not in plan


def test_hash_comes_first(spark, customers):
    rows = with_row_hash(customers)
    for previous in (None, rows):
        assert new_rows(rows, previous).columns[0] == "hash"


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    now=st.lists(st.integers(0, 6), max_size=40),
    before=st.lists(st.integers(0, 6), max_size=40),
    path=st.sampled_from(PATHS + [DiffLimits(broadcast=2, shuffle=0, hot=3)]),
)
def test_bag_difference(spark, now, before, path):
    """Every path keeps all copies of exactly the values the previous copy lacks."""
    schema = "v int"
    current = with_row_hash(spark.createDataFrame([(v,) for v in now], schema))
    previous = with_row_hash(spark.createDataFrame([(v,) for v in before], schema))
    found = sorted(r.v for r in new_rows(current, previous, path).collect())
    assert found == sorted(v for v in now if v not in set(before))


def test_a_third_of_all_rows_alike(spark):
    """One value owns a third of the rows; its copies take no part in the shuffle."""
    current = with_row_hash(
        spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("v"))
    )
    previous = with_row_hash(spark.range(100, 200).select(F.col("id").alias("v")))
    found = new_rows(current, previous, DiffLimits(broadcast=0, shuffle=0, hot=5_000))
    assert found.where("v = -1").count() == 10_000
    assert found.count() == 30_000 - 67
    plan = plan_of(found)
    assert "Union" in plan and "LeftSemi" in plan and "LeftAnti" in plan


def test_only_merged_hashes_are_shuffled(spark, customers):
    rows = with_row_hash(customers)
    plan = plan_of(compared_hashes(rows, rows)).split("== Physical Plan ==")[1]
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan and "Join" not in plan


def test_hash_is_not_computed_twice_for_the_join(spark, customers):
    rows = with_row_hash(customers)
    plan = plan_of(new_rows(rows, with_row_hash(customers.limit(5))))
    current_side = plan.split("== Physical Plan ==")[1].split("BroadcastExchange")[0]
    assert current_side.count("StructsToJsonEvaluator") == 1


def test_small_previous_is_broadcast(spark, customers):
    rows = with_row_hash(customers)
    plan = plan_of(new_rows(rows, with_row_hash(customers.limit(5))))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_unknown_region():
    assert market_regions("eu-west-1") == ["NA", "EU"]
    with pytest.raises(ValueError):
        market_regions("moon-1")
