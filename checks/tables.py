"""Versioned tables and hour folders: what is read back after each kind of write."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from checks.derived import RUN_TS, table
from tidemark.model import INCR_LOAD, KEY_INCR_LOAD, Run
from tidemark.operators.transforms import lowercase_columns
from tidemark.session import fresh_folder
from tidemark.tables.appends import AppendTable
from tidemark.tables.hours import read_load, write_load
from tidemark.tables.snapshots import VersionedTable


def _target(spark, name):
    return VersionedTable(spark, fresh_folder(spark, "tables"), name)


def append_merge_schema(spark, sf_dir):
    """A second append brings a new column; a third one a wider number."""
    customers = table(spark, sf_dir, "customer")
    target = AppendTable(spark, fresh_folder(spark, "tables"), "customer")
    target.append(customers.where("c_custkey % 3 = 0"), slice_key="a")
    target.append(
        lowercase_columns(
            customers.where("c_custkey % 3 = 1").withColumn("TIER", F.lit("gold"))
        ),
        slice_key="b",
    )
    target.append(
        customers.where("c_custkey % 3 = 2").withColumn(
            "c_nationkey", F.col("c_nationkey").cast("bigint") + 5_000_000_000
        ),
        slice_key="c",
    )
    return target.read()


APPEND_SQL = """
SELECT c_custkey, c_name, c_nationkey + CASE WHEN c_custkey % 3 = 2 THEN 5000000000 ELSE 0 END
  AS c_nationkey, c_acctbal, c_mktsegment, CASE WHEN c_custkey % 3 = 1 THEN 'gold' END AS tier
FROM customer"""


def append_repeated_slice(spark, sf_dir):
    """The second slice is appended twice, as after a failure; its rows stay single."""
    orders = table(spark, sf_dir, "orders")
    target = AppendTable(spark, fresh_folder(spark, "tables"), "orders")
    target.append(orders.where("o_orderkey % 2 = 0"), slice_key="a")
    target.append(orders.where("o_orderkey % 2 = 1"), slice_key="b")
    target.append(orders.where("o_orderkey % 2 = 1"), slice_key="b")
    return target.read()


def replace_table(spark, sf_dir):
    nations = table(spark, sf_dir, "supplier")
    target = _target(spark, "supplier")
    target.replace(nations.withColumn("s_acctbal", F.lit(0.0)))
    target.replace(nations.select(*reversed(nations.columns)))
    return target.read()


def rollback_table(spark, sf_dir):
    """Replace, append, roll back both; then the first contents are current again."""
    orders = table(spark, sf_dir, "orders")
    target = _target(spark, "orders")
    target.replace(orders.where("o_orderstatus = 'F'"))
    target.replace(orders.where("o_orderstatus = 'O'"))
    target.append(orders.where("o_orderstatus = 'P'"))
    target.rollback()
    target.rollback()
    return target.read()


def append_after_rollback(spark, sf_dir):
    """Rows of a snapshot that was rolled back never come back."""
    orders = table(spark, sf_dir, "orders")
    target = _target(spark, "orders")
    target.append(orders.where("o_orderstatus = 'F'"))
    target.append(orders.where("o_orderstatus = 'O'"))
    target.rollback()
    target.append(orders.where("o_orderstatus = 'P'"))
    return target.read()


def read_old_snapshot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    target = _target(spark, "orders")
    first = target.replace(orders)
    target.replace(orders.withColumn("o_totalprice", F.lit(0.0)))
    return target.read(first.snapshot_id)


def snapshot_history(spark, sf_dir):
    """One table per order status; which snapshot is current in each."""
    orders = table(spark, sf_dir, "orders")
    root = fresh_folder(spark, "tables")
    found = None
    for status in ("F", "O", "P"):
        target = VersionedTable(spark, root, status)
        target.append(orders.where(F.col("o_orderstatus") == status))
        target.append(orders.where(F.col("o_orderstatus") == status))
        target.rollback()
        counted = target.read().agg(F.count(F.lit(1)).alias("row_count")).withColumn(
            "table_name", F.lit(status)
        )
        row = target.log().groupBy("table_name").agg(
            F.max_by("snapshot_id", "version").alias("current_id"),
            F.max_by("operation", "version").alias("operation"),
            F.count(F.lit(1)).alias("commits"),
        )
        row = row.join(counted, "table_name")
        found = row if found is None else found.unionAll(row)
    return found


def write_increment(spark, sf_dir):
    """The same hour written twice holds the last write only."""
    run = Run(RUN_TS, fresh_folder(spark, "hours"), files=4)
    orders = table(spark, sf_dir, "orders")
    write_load(orders.where("o_orderkey % 2 = 0"), run, "orders", INCR_LOAD)
    write_load(orders, run, "orders", INCR_LOAD)
    later = Run(RUN_TS + timedelta(hours=1), run.root)
    write_load(orders.where("o_orderkey < 10"), later, "orders", INCR_LOAD)
    return read_load(spark, run, "orders", INCR_LOAD)


def write_key_increment(spark, sf_dir):
    """Two extracts in one hour from different checkpoints both stay; a repeat does not add."""
    run = Run(RUN_TS, fresh_folder(spark, "hours"))
    orders = table(spark, sf_dir, "orders")
    write_load(orders.where("o_orderkey < 4000"), run, "orders", KEY_INCR_LOAD, "k>0")
    write_load(orders.where("o_orderkey >= 4000"), run, "orders", KEY_INCR_LOAD, "k>4000")
    write_load(orders.where("o_orderkey >= 4000"), run, "orders", KEY_INCR_LOAD, "k>4000")
    return read_load(spark, run, "orders", KEY_INCR_LOAD)


def checks():
    return {
        "append_merge_schema": (append_merge_schema, APPEND_SQL),
        "append_repeated_slice": (append_repeated_slice, "SELECT * FROM orders"),
        "replace_table": (replace_table, "SELECT * FROM supplier"),
        "rollback": (rollback_table, "SELECT * FROM orders WHERE o_orderstatus = 'F'"),
        "append_after_rollback": (
            append_after_rollback,
            "SELECT * FROM orders WHERE o_orderstatus IN ('F', 'P')",
        ),
        "read_snapshot": (read_old_snapshot, "SELECT * FROM orders"),
        "snapshot_history": (
            snapshot_history,
            "SELECT o_orderstatus AS table_name, 1::BIGINT AS current_id, 'rollback' AS operation, "
            "3::BIGINT AS commits, count(*) AS row_count FROM orders GROUP BY o_orderstatus",
        ),
        "write_increment": (write_increment, "SELECT * FROM orders"),
        "write_key_increment": (write_key_increment, "SELECT * FROM orders"),
    }
