from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import rows_of
from tidemark.model import Run
from tidemark.operators import transforms as t


def test_hash_ignores_an_added_null_column(spark, customers):
    plain = t.with_row_hash(customers).select("hash")
    wider = t.with_row_hash(customers.withColumn("later", F.lit(None).cast("string"))).select("hash")
    assert rows_of(plain) == rows_of(wider)


def test_hash_depends_on_column_order(spark, customers):
    turned = customers.select(*reversed(customers.columns))
    assert t.with_row_hash(customers).select("hash").intersect(
        t.with_row_hash(turned).select("hash")
    ).isEmpty()


def test_hash_is_32_lowercase_hex(spark, customers):
    assert t.with_row_hash(customers).where(~F.col("hash").rlike("^[0-9a-f]{32}$")).isEmpty()


def test_hash_sees_microseconds_and_no_session_zone(spark):
    rows = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:00.123456' AS a UNION ALL "
        "SELECT timestamp_ntz'2024-01-01 00:00:00.123999'"
    )
    assert t.with_row_hash(rows).select("hash").distinct().count() == 2
    zoned = spark.sql("SELECT timestamp'2024-01-01 00:00:00.123456Z' AS a")
    here = rows_of(t.with_row_hash(zoned).select("hash"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows_of(t.with_row_hash(zoned).select("hash")) == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_nested_rows_hash(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    nested = vectors.select("vec_id", F.struct("embedding", "label").alias("n"), F.map_from_arrays(
        F.array(F.lit("k")), F.array("label")).alias("m"))
    hashed = t.with_row_hash(nested)
    assert hashed.select("hash").distinct().count() == vectors.count()


def test_column_names_with_dots_and_backticks(spark):
    rows = spark.createDataFrame([(1, 2)], T.StructType(
        [T.StructField("a.b", T.IntegerType()), T.StructField("c`d", T.IntegerType())]))
    assert t.to_src(rows).first().SRC == '{"a.b":1,"c`d":2}'


def test_rename_reserved(spark):
    rows = spark.createDataFrame([(1, 2)], "id int, HASH int")
    assert t.rename_reserved(rows).columns == ["id", "src_hash"]
    assert t.rename_reserved(rows.select("id")).columns == ["id"]
    with pytest.raises(ValueError):
        t.rename_reserved(spark.createDataFrame([(1, 2)], "hash int, src_hash int"))


def test_stamp_is_utc_and_zone_free(spark):
    east = timezone(timedelta(hours=5, minutes=30))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = t.with_ingest_ts(spark.range(1), datetime(2024, 3, 10, 8, 15, tzinfo=east)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.INGEST_EFF_DTIMEUTC == datetime(2024, 3, 10, 2, 0)


def test_lowercase_collision(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError):
            t.lowercase_columns(spark.createDataFrame([(1, 2)], "a int, A int"))
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_void_inside_containers(spark):
    rows = spark.range(1).select(
        F.lit(None).alias("v"),
        F.array(F.lit(None)).alias("a"),
        F.create_map(F.lit("k"), F.lit(None)).alias("m"),
        F.struct(F.lit(1).alias("x"), F.struct(F.lit(None).alias("z")).alias("y")).alias("s"),
    )
    found = t.void_to_string(rows)
    assert "void" not in found.schema.simpleString()
    assert found.schema["s"].dataType["x"].dataType == T.IntegerType()


def test_region_tag_without_region(spark):
    assert t.with_region_tag(spark.range(1), "orders").first().ITB_DB_REGION is None


@pytest.mark.parametrize(
    "text", ["2024-01-01 00:00:00", "2024-03-10 02:30:00.000001", "2024-11-03 05:30:00", "1969-07-20 20:17:40"]
)
@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_normalise_timestamps_outside_utc(spark, zone, text):
    """Also where the session zone skips or repeats the hour."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.sql(f"SELECT timestamp'{text}Z' AS a, 1 AS b")
        assert t.normalise_timestamps(rows).first().a == datetime.fromisoformat(text)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_aligned_names(spark):
    rows = spark.createDataFrame([(1, 2)], "B int, a int")
    assert t.aligned_names(rows, ["a", "b"]).columns == ["a", "b"]
    with pytest.raises(ValueError):
        t.aligned_names(rows, ["a"])


def test_run_parts():
    run = Run(datetime(2024, 1, 2, 3, 4, tzinfo=timezone.utc), "s3a://lake/bronze/")
    assert (run.scheme, run.bucket) == ("s3a://", "lake/bronze")
    assert run.hour == datetime(2024, 1, 2, 3)
    assert (Run(run.run_ts, "/tmp/x").scheme, Run(run.run_ts, "/tmp/x").bucket) == ("", "/tmp/x")
