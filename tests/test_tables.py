from datetime import timedelta

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import plan_of, rows_of
from tidemark.model import INCR_LOAD, KEY_INCR_LOAD, Run
from tidemark.operators.filelog import file_inventory
from tidemark.tables.hours import load_path, read_load, write_load
from tidemark.tables.lakehouse import LakehouseTable
from tidemark.tables.snapshots import VersionedTable, merged_schema


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path), "t")


def test_empty_table(spark, table):
    assert table.current() is None and table.log().isEmpty()
    with pytest.raises(ValueError):
        table.read()
    with pytest.raises(ValueError):
        table.rollback()
    assert table.read_or_empty(T.StructType([T.StructField("a", T.LongType())])).columns == ["a"]


def test_unpublished_snapshot_is_invisible(spark, table, customers):
    table.replace(customers.limit(3))
    table.write(customers)
    assert table.refresh().read().count() == 3
    # the next try takes the place of the leftover
    table.replace(customers.limit(7))
    assert table.refresh().read().count() == 7


def test_failed_replace_changes_nothing(spark, table, customers):
    table.replace(customers.limit(3))
    broken = customers.withColumn("c_name", F.raise_error(F.lit("source broke")))
    with pytest.raises(Exception, match="source broke"):
        table.replace(broken)
    assert table.refresh().read().count() == 3


def test_replace_then_rollback_is_identity(spark, table, customers):
    table.append(customers.limit(5))
    table.append(customers.limit(4))
    before = rows_of(table.read())
    table.replace(customers)
    table.rollback()
    assert rows_of(VersionedTable(spark, table.path[:-2], "t").read()) == before


def test_rollback_of_the_first_snapshot(spark, table, customers):
    table.append(customers)
    with pytest.raises(ValueError):
        table.rollback()
    table.rollback(to_empty=True)
    assert table.refresh().current() is None
    table.append(customers.limit(2))
    assert table.read().count() == 2


def test_repeated_first_slice(spark, table, customers):
    table.append(customers, slice_key="a")
    table.append(customers, slice_key="a")
    assert table.read().count() == customers.count()
    table.rollback(to_empty=True)
    assert table.current() is None


def test_replace_while_reading_itself(spark, table, customers):
    table.replace(customers)
    table.replace(table.read().where("c_custkey % 2 = 0"))
    assert table.read().count() == customers.where("c_custkey % 2 = 0").count()


def test_snapshot_before_an_hour(spark, table, customers, run):
    table.replace(customers.limit(1), run.hour)
    table.replace(customers.limit(2), run.hour + timedelta(hours=1))
    table.replace(customers.limit(3), run.hour + timedelta(hours=1))
    assert table.before(run.hour) is None
    assert table.before(run.hour + timedelta(hours=1)).snapshot_id == 1
    assert table.before(run.hour + timedelta(hours=2)).snapshot_id == 3


def test_schema_rules():
    s = T.StructType.fromDDL

    assert merged_schema(s("a int, b string"), s("c double, a bigint")) == s(
        "a bigint, b string, c double"
    )
    assert merged_schema(s("a bigint"), s("a int")) == s("a bigint")
    with pytest.raises(ValueError):
        merged_schema(s("a int"), s("a string"))


def test_reads_prune_columns_and_skip_other_snapshots(spark, table, customers):
    table.replace(customers)
    table.replace(customers.limit(1))
    plan = plan_of(table.read().select("c_custkey").where("c_custkey > 5"))
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    assert "snapshot_id=2" in plan and "snapshot_id=1" not in plan
    assert "GreaterThan(c_custkey,5)" in plan


def test_hour_layout(run):
    assert load_path(run, "t", INCR_LOAD) == f"{run.root}/t/incr_load/2024/05/01/10"
    first = load_path(run, "t", KEY_INCR_LOAD, "ts>1")
    assert first.startswith(f"{run.root}/t/key_incr_load/2024/05/01/10/slice=")
    assert first != load_path(run, "t", KEY_INCR_LOAD, "ts>2")
    with pytest.raises(ValueError):
        write_load(None, run, "t", "elsewhere")


def test_rerun_of_an_hour_changes_nothing(spark, run, customers):
    for _ in range(2):
        write_load(customers, run, "c", INCR_LOAD)
    other = Run(run.run_ts + timedelta(hours=1), run.root)
    write_load(customers.limit(1), other, "c", INCR_LOAD)
    assert rows_of(read_load(spark, run, "c", INCR_LOAD)) == rows_of(customers)


def test_file_count_only_on_request(spark, run, customers):
    spread = customers.repartition(3)
    plain = write_load(spread, run, "plain", INCR_LOAD)
    asked = write_load(spread, Run(run.run_ts, run.root, files=5), "asked", INCR_LOAD)

    def files(path):
        return file_inventory(spark, path).count()

    assert (files(plain), files(asked)) == (3, 5)


class _FakeSpark:
    """Records what would be sent to a lakehouse runtime, which is not present here."""

    def __init__(self, spark):
        self.spark, self.sql_texts = spark, []

    def table(self, name):
        assert name.endswith(".snapshots")
        return self.spark.sql(
            "SELECT * FROM VALUES (1L, null, timestamp'2024-01-01 00:00:00'), "
            "(2L, 1L, timestamp'2024-01-02 00:00:00'), (3L, 2L, timestamp'2024-01-02 00:00:00') "
            "AS t(snapshot_id, parent_id, committed_at)"
        )

    def sql(self, text):
        self.sql_texts.append(text)


def test_lakehouse_rollback_command(spark):
    fake = _FakeSpark(spark)
    LakehouseTable(fake, "cat", "my_lake", "orders-EU").rollback()
    assert fake.sql_texts == [
        "CALL cat.system.rollback_to_snapshot(table => 'cat.my_lake.`orders-EU`', snapshot_id => 2)"
    ]
    with pytest.raises(ValueError):
        LakehouseTable(fake, "cat", "db", "t; drop table x")
