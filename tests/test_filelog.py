from datetime import datetime, timedelta

import pytest

from tidemark.model import FILE_INGEST_LOG
from tidemark.operators import filelog as fl

NOW = datetime(2024, 5, 1, 10, 20, 30)


def inventory(spark, *rows):
    return spark.createDataFrame(rows, "path string, modified timestamp_ntz, length bigint")


def log_of(spark, *paths, table="orders", modified=NOW):
    rows = [(f"s3a://lake/{p}", modified, 1) for p in paths]
    return fl.to_log_rows(inventory(spark, *rows), table, "lake", NOW)


def keys(df):
    return sorted(r.FILE_WITH_PATH for r in df.collect())


def test_log_rows(spark):
    log = log_of(spark, "orders/incr_load/2024/05/01/10/a.parquet", "orders/x/_SUCCESS")
    assert [(f.name, f.dataType) for f in log.schema] == [
        (f.name, f.dataType) for f in FILE_INGEST_LOG
    ]
    row = log.first()
    assert log.count() == 1 and len(row.FILE_UID) == 32
    assert (row.PROCESSED_FLAG, row.FILE_ERROR_MSG) == (False, "NA")


def test_missing_folder_is_an_empty_inventory(spark, tmp_path):
    assert fl.file_inventory(spark, str(tmp_path / "nothing")).isEmpty()


def test_inventory_reads_no_content(spark, customers, tmp_path):
    path = str(tmp_path / "c")
    customers.write.parquet(path)
    found = fl.file_inventory(spark, path)
    plan = found._jdf.queryExecution().toString()
    assert "content" not in plan.split("== Physical Plan ==")[1]
    assert found.where("length > 0").count() == found.count() > 0


def test_names_that_begin_alike(spark):
    log = log_of(spark, "orders/incr_load/2024/05/01/10/a", "orders_archive/incr_load/2024/05/01/10/b")
    assert keys(fl.files_since(log, "orders", NOW - timedelta(days=1))) == [
        "orders/incr_load/2024/05/01/10/a"
    ]
    assert fl.latest_hour_files(log, "orders").count() == 1


def test_only_increments_since(spark):
    log = log_of(
        spark,
        "orders/incr_load/2024/05/01/10/a",
        "orders/full_load/2024/05/01/10/b",
        "orders/tmp/2024/05/01/10/c",
        "orders/key_incr_load/2024/05/01/10/d",
    )
    assert len(keys(fl.files_since(log, "orders", NOW - timedelta(seconds=1)))) == 1
    assert keys(fl.files_since(log, "orders", NOW)) == []


def test_latest_hour_ignores_short_paths(spark):
    log = log_of(
        spark,
        "orders/full_load/2024/04/30/23/a",
        "orders/full_load/2024/05/01/09/b",
        "orders/full_load/2024/05/01/09/c",
        "orders/zzz",
    )
    assert keys(fl.latest_hour_files(log, "orders")) == [
        "orders/full_load/2024/05/01/09/b",
        "orders/full_load/2024/05/01/09/c",
    ]
    assert fl.latest_hour_files(log, "absent").isEmpty()


def test_same_file_is_logged_once(spark):
    log, again = log_of(spark, "orders/a", "orders/b"), log_of(spark, "orders/b", "orders/c")
    assert keys(fl.unlogged(log, again)) == ["orders/c"]


@pytest.mark.parametrize("hours,expired", [(0, 0), (1, 0), (3, 0), (4, 1), (6, 3)])
def test_three_run_hours_are_kept(spark, hours, expired):
    rows = [("orders", f"p{h}-{i}", NOW + timedelta(hours=h, minutes=i)) for h in range(hours) for i in (0, 7)]
    found = fl.expired_files(
        spark.createDataFrame(rows, "table_name string, path string, modified timestamp_ntz")
    )
    assert sorted(r.path for r in found.collect()) == sorted(
        f"p{h}-{i}" for h in range(expired) for i in (0, 7)
    )


def test_hours_are_cut_right_in_a_daylight_saving_gap(spark):
    """02:30 does not exist in New York on that day, but it does in UTC."""
    start = datetime(2024, 3, 10, 1, 30)
    rows = [("t", f"p{h}", start + timedelta(hours=h)) for h in range(4)]
    frame = spark.createDataFrame(rows, "table_name string, path string, modified timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [r.path for r in fl.expired_files(frame, keep=3).collect()] == ["p0"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
