import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.functions.predicates import bucketed_checkpoint_predicate, checkpoint_predicate
from tidemark.model import FILE_INGEST_LOG, PIPELINE_CONFIG
from tidemark.operators import checkpoint as cp, config as cf


def frame(spark, *rows):
    return spark.createDataFrame(
        [tuple(r.get(n) for n in PIPELINE_CONFIG.names) for r in rows], PIPELINE_CONFIG
    )


def row(**more):
    base = dict(
        SOURCE_NAMESPACE="ns",
        SOURCE_TABLE_NAME="orders",
        TARGET_TABLE_NAME="t_orders",
        LAYER_TYPE="BRONZE",
        SOURCE_SYSTEM="mysql",
        EXTRACT_METHOD="FULL_EXTRACT",
        TARGET_STORE_TYPE="x",
        PROC_GROUP="A",
        IS_ACTIVE=True,
    )
    return {**base, **more}


def test_objects_without_lander_say_so(spark):
    found = cf.object_specs(frame(spark, row()))
    assert len(found) == 1 and found[0].source_system == "MYSQL"
    assert (found[0].flatten_mode, found[0].lander_target) == ("NA", "NA")


def test_lander_of_another_group_is_not_taken(spark):
    rows = frame(
        spark,
        row(),
        row(LAYER_TYPE="LANDER", PROC_GROUP="B", TARGET_TABLE_NAME="raw", FLATTEN_MODE="SNOWFLAKE"),
    )
    assert [s.lander_target for s in cf.object_specs(rows)] == ["NA"]


def test_source_named_twice_fills_both_targets(spark):
    rows = frame(spark, row(TARGET_TABLE_NAME="b"), row(TARGET_TABLE_NAME="a"))
    assert cf.list_objects(rows).count() == 1
    assert [s.target_table for s in cf.object_specs(rows)] == ["a", "b"]


def test_missing_configuration_is_an_error(spark):
    with pytest.raises(AnalysisException):
        cf.read_config(spark, "no_such_database.pipeline_config")


@pytest.mark.parametrize(
    "text,flag",
    [("TRUE", True), ("True", True), (" true", True), ("FALSE", False), ("False", False), (None, None)],
)
def test_text_flags(spark, text, flag):
    stored = spark.createDataFrame([(text,)], "processed_flag string")
    assert cf.conform(stored, FILE_INGEST_LOG).first().PROCESSED_FLAG is flag


@pytest.mark.parametrize(
    "text,keys",
    [
        ('{"partition_key":"a,b","clustering_key":"c"}', ["a", "b", "c"]),
        ('{"partition_key":"a","clustering_key":""}', ["a"]),
        ('{"partition_key":"a"}', ["a"]),
    ],
)
def test_primary_keys(spark, text, keys):
    assert cf.primary_keys(frame(spark, row(SOURCE_KEY_FIELDS=text))).first().primary_key == keys


def test_advance_moves_bronze_rows_of_the_object_only(spark):
    rows = frame(
        spark,
        row(CHECKPOINT_TO_VALUE="old"),
        row(LAYER_TYPE="LANDER", CHECKPOINT_TO_VALUE="old"),
        row(SOURCE_NAMESPACE="other", CHECKPOINT_TO_VALUE="old"),
        row(SOURCE_TABLE_NAME="parts", CHECKPOINT_TO_VALUE="old"),
    )
    moved = cp.advance_checkpoints(rows, cp.checkpoint_row(spark, "ns", "orders", "new"))
    assert moved.columns == rows.columns
    assert moved.where("CHECKPOINT_TO_VALUE = 'new'").count() == 1
    still = cp.advance_checkpoints(rows, cp.checkpoint_row(spark, "ns", "orders", None))
    assert still.where("CHECKPOINT_TO_VALUE = 'old'").count() == 4


def test_next_checkpoint_forms(spark):
    rows = spark.sql(
        "SELECT timestamp'2024-01-01 10:00:00.250' AS z, timestamp_ntz'2024-01-01 10:00:00.5' AS n, "
        "cast(1.50 AS decimal(5,2)) AS d, 'x.y' AS s, true AS b"
    )
    fields = ["z", "n", "d", "s", "b"]
    full = cp.next_checkpoint(rows, fields).first().checkpoint
    assert full == "2024-01-01 10:00:00.25|2024-01-01 10:00:00.5|1.50|x.y|true"
    cut = cp.next_checkpoint(rows, fields, "second").first().checkpoint
    assert cut == "2024-01-01 10:00:00|2024-01-01 10:00:00|1.50|x.y|true"


def test_next_checkpoint_is_one_aggregation(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    plan = cp.next_checkpoint(events, ["ts", "event_id"])._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("FileScan") == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in physical


def test_checkpoint_round_trip(spark, sf):
    """What a run stores is what the next run reads from: nothing is read twice."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    half = events.where(F.col("event_id") < 500)
    stored = cp.next_checkpoint(half, ["ts"]).first().checkpoint
    rest = events.where(checkpoint_predicate(cp.specs_of("ts::timestamp::>", stored)))
    assert rest.count() + half.count() == events.count()


def test_two_bucket_checkpoint(spark, tmp_path):
    """Only year and month are known: the greatest pair is stored as yyyy-mm."""
    rows = spark.createDataFrame([(2023, 12), (2024, 2), (2024, 1)], "y int, m int")
    specs = cp.specs_of("y::numeric::>=|m::numeric::>", "2023-01")
    watched, seen = cp.observe_checkpoint(rows, specs, bucketed=True)
    watched.write.parquet(str(tmp_path / "x"))
    stored, count = cp.observed_value(seen, specs)
    assert (stored, count) == ("2024-02", 3)
    again = rows.where(bucketed_checkpoint_predicate(cp.specs_of("y::numeric::>=|m::numeric::>", stored)))
    assert again.isEmpty()
