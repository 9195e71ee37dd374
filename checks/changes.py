"""Change detection and region filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.derived import (
    COLUMNS,
    PERTURBED_CUSTOMERS_SQL,
    hash_sql,
    perturbed_customers,
    table,
)
from tidemark.operators.changes import DiffLimits, new_rows, region_filter, region_semi_filter
from tidemark.operators.transforms import with_row_hash


# Every size counts as too large, so that whole tables take the path of huge ones.
HUGE = DiffLimits(broadcast=0, shuffle=0, hot=1000)


def incremental_diff(spark, sf_dir, limits=DiffLimits()):
    current = with_row_hash(table(spark, sf_dir, "customer"))
    previous = with_row_hash(perturbed_customers(spark, sf_dir))
    return new_rows(current, previous, limits)


def incremental_diff_joined(spark, sf_dir):
    """The same by the path for moderate sizes."""
    return incremental_diff(spark, sf_dir, DiffLimits(broadcast=0))


def incremental_diff_shuffled(spark, sf_dir):
    """The same by the path for huge tables."""
    return incremental_diff(spark, sf_dir, HUGE)


# Independent of the hash rule: rows are compared column by column.
INCREMENTAL_DIFF_SQL = f"""
WITH {PERTURBED_CUSTOMERS_SQL}
SELECT {hash_sql(COLUMNS["customer"])} AS hash, c.* FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM before b WHERE {
    " AND ".join(f"b.{c} IS NOT DISTINCT FROM c.{c}" for c in COLUMNS["customer"])})"""


def _lineitem_diff(spark, sf_dir, limits):
    """Discounts changed on some lines, others added."""
    now = table(spark, sf_dir, "lineitem")
    before = now.where("l_orderkey % 9 <> 0").withColumn(
        "l_discount",
        F.when(F.col("l_suppkey") % 5 == 0, F.col("l_discount") + 1).otherwise(
            F.col("l_discount")
        ),
    )
    return new_rows(with_row_hash(now), with_row_hash(before), limits).drop("hash")


def incremental_diff_lineitem(spark, sf_dir):
    return _lineitem_diff(spark, sf_dir, DiffLimits())


def incremental_diff_lineitem_shuffled(spark, sf_dir):
    return _lineitem_diff(spark, sf_dir, HUGE)


LINEITEM_DIFF_SQL = f"""
WITH before AS (
  SELECT * REPLACE (CASE WHEN l_suppkey % 5 = 0 THEN l_discount + 1 ELSE l_discount END
    AS l_discount) FROM lineitem WHERE l_orderkey % 9 <> 0)
SELECT l.* FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM before b WHERE {
    " AND ".join(f"b.{c} IS NOT DISTINCT FROM l.{c}" for c in COLUMNS["lineitem"])})"""


def incremental_diff_first_load(spark, sf_dir):
    return new_rows(with_row_hash(table(spark, sf_dir, "orders")), None)


def incremental_diff_duplicates(spark, sf_dir):
    """Few distinct rows, each copied very often: all copies of a new row survive."""
    flags = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    previous = flags.where("l_returnflag <> 'R'")
    return new_rows(with_row_hash(flags), with_row_hash(previous), HUGE).drop("hash")


def incremental_diff_micros(spark, sf_dir):
    """Rows that differ from the earlier copy by microseconds only count as new."""
    events = table(spark, sf_dir, "events")
    previous = events.withColumn(
        "ts",
        F.when(
            F.col("event_id") % 11 == 0, F.expr("ts - INTERVAL '0.000001' SECOND")
        ).otherwise(F.col("ts")),
    )
    return new_rows(with_row_hash(events), with_row_hash(previous)).drop("hash")


REGIONS = {"west": ("EUROPE", "AMERICA"), "east": ("ASIA",)}


def region_filtered(spark, sf_dir):
    """Orders by market, the market being the order status here."""
    markets = {"west": ("O", "F"), "east": ("P",)}
    return region_filter(table(spark, sf_dir, "orders"), "o_orderstatus", "west", markets)


def region_semi(spark, sf_dir):
    """Customers whose nation lies in a region served from here."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return region_semi_filter(
        table(spark, sf_dir, "customer"),
        nations,
        "c_nationkey",
        "n_nationkey",
        "r_name",
        "west",
        REGIONS,
    )


def region_semi_shuffled(spark, sf_dir):
    """Lines of the orders of one market, with neither side broadcast by hint."""
    return region_semi_filter(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "orders"),
        "l_orderkey",
        "o_orderkey",
        "o_orderpriority",
        "east",
        {"east": ("1-URGENT", "2-HIGH")},
        broadcast_rows=0,
    )


def checks():
    return {
        "incremental_diff": (incremental_diff, INCREMENTAL_DIFF_SQL),
        "incremental_diff_joined": (incremental_diff_joined, INCREMENTAL_DIFF_SQL),
        "incremental_diff_shuffled": (incremental_diff_shuffled, INCREMENTAL_DIFF_SQL),
        "incremental_diff_lineitem": (incremental_diff_lineitem, LINEITEM_DIFF_SQL),
        "incremental_diff_lineitem_shuffled": (
            incremental_diff_lineitem_shuffled,
            LINEITEM_DIFF_SQL,
        ),
        "incremental_diff_first_load": (
            incremental_diff_first_load,
            f"SELECT {hash_sql(COLUMNS['orders'])} AS hash, * FROM orders",
        ),
        "incremental_diff_duplicates": (
            incremental_diff_duplicates,
            "SELECT l_returnflag, l_linestatus FROM lineitem WHERE l_returnflag = 'R'",
        ),
        "incremental_diff_micros": (
            incremental_diff_micros,
            "SELECT * FROM events WHERE event_id % 11 = 0",
        ),
        "region_filter": (
            region_filtered,
            "SELECT * FROM orders WHERE o_orderstatus IN ('O', 'F')",
        ),
        "region_semi": (
            region_semi,
            "SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation "
            "JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('EUROPE', 'AMERICA'))",
        ),
        "region_semi_shuffled": (
            region_semi_shuffled,
            "SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders "
            "WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))",
        ),
    }
