from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidemark.functions.predicates import bucketed_checkpoint_predicate, checkpoint_predicate
from tidemark.model import CheckpointSpec
from tidemark.operators.checkpoint import specs_of


def spec(field, kind, op, value):
    return CheckpointSpec(field, kind, op, value)


@pytest.mark.parametrize(
    "bad",
    [
        spec("a", "numeric", "like", "1"),
        spec("a", "numeric", "> 0 or 1 =", "1"),
        spec("a", "money", ">", "1"),
        spec("a", "numeric", ">", "1; drop"),
        spec("a", "boolean", "=", "maybe"),
        spec("a", "string", "=", None),
        spec("a", "timestamp", ">", ""),
    ],
)
def test_bad_checkpoints_are_refused(spark, bad):
    with pytest.raises(ValueError):
        checkpoint_predicate([bad])


def test_no_fields_is_refused(spark):
    with pytest.raises(ValueError):
        checkpoint_predicate([])


@pytest.mark.parametrize("definition", ["ts::timestamp", "ts", "a::b::c::d", "ts::timestamp::>|"])
def test_malformed_definitions_are_refused(definition):
    with pytest.raises(ValueError):
        specs_of(definition, "2024-01-01")


def test_text_values_cannot_become_sql(spark):
    rows = spark.createDataFrame([("x' or '1'='1",), ("y",)], "a string")
    found = rows.where(checkpoint_predicate([spec("a", "string", "=", "x' or '1'='1")]))
    assert found.count() == 1


def test_comparisons_reach_the_scan(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    specs = specs_of(
        "o_orderdate::timestamp::>|o_orderkey::numeric::>=|o_orderstatus::string::=",
        "1997-01-01 00:00:00|100|F",
    )
    plan = plan_of(orders.where(checkpoint_predicate(specs)).select("o_orderkey"))
    pushed = plan[plan.index("PushedFilters"):]
    for text in (
        "GreaterThan(o_orderdate",
        "GreaterThanOrEqual(o_orderkey,100)",
        "EqualTo(o_orderstatus,F)",
    ):
        assert text in pushed
    assert "o_totalprice" not in plan[plan.index("ReadSchema"):].split("\n")[0]


def test_all_fields_must_pass(spark):
    """Kept as configured: a row new in one field and old in another is not read."""
    rows = spark.createDataFrame([(1, 9), (9, 1), (9, 9)], "a int, b int")
    specs = specs_of("a::numeric::>|b::numeric::>", "5|5")
    assert rows.where(checkpoint_predicate(specs)).count() == 1


def test_buckets_cross_the_year(spark, tmp_path):
    rows = spark.createDataFrame(
        [
            (2023, 11, datetime(2023, 11, 30)),
            (2023, 12, datetime(2023, 12, 1)),
            (2023, 12, datetime(2023, 12, 24)),
            (2024, 1, datetime(2024, 1, 3)),
        ],
        "year int, month int, ts timestamp_ntz",
    )
    path = str(tmp_path / "buckets")
    rows.write.partitionBy("year", "month").parquet(path)
    specs = specs_of(
        "year::numeric::>=|month::numeric::>=|ts::timestamp::>", "2023-12-10 00:00:00"
    )
    found = spark.read.parquet(path).where(bucketed_checkpoint_predicate(specs))
    assert found.count() == 2
    assert "year" in plan_of(found).split("PartitionFilters: [")[1].split("]")[0]


def test_buckets_stored_as_text(spark):
    rows = spark.createDataFrame([("2023", "09"), ("2023", "11"), ("2024", "02")], "y string, m string")
    specs = specs_of("y::string::>=|m::string::>=", "2023-10-01")
    assert rows.where(bucketed_checkpoint_predicate(specs)).count() == 2


def test_equal_buckets_stay_equal(spark):
    rows = spark.createDataFrame([(2023, 10), (2023, 11), (2024, 10)], "y int, m int")
    specs = specs_of("y::numeric::=|m::numeric::>=", "2023-10-01")
    assert rows.where(bucketed_checkpoint_predicate(specs)).count() == 2


def test_one_field_is_an_ordinary_checkpoint(spark):
    rows = spark.createDataFrame([(1,), (2,)], "a int")
    assert rows.where(bucketed_checkpoint_predicate(specs_of("a::numeric::>", "1"))).count() == 1


def test_decimal_values(spark):
    rows = spark.createDataFrame([(1.5,), (2.5,)], "a double").select(
        F.col("a").cast("decimal(10,2)")
    )
    assert rows.where(checkpoint_predicate(specs_of("a::numeric::>", "1.50"))).count() == 1
