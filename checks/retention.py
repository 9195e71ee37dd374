"""What is kept, what is pruned, and what a comparison of stored tables reads."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from checks.changes import LINEITEM_DIFF_SQL, REGIONS
from checks.derived import COLUMNS, RUN_HOUR_SQL, RUN_TS, json_sql, table
from tidemark.functions.rows import ref
from tidemark.model import (
    FULL_EXTRACT,
    FULL_EXTRACT_INCR,
    FULL_LOAD,
    HASH,
    INCR_LOAD,
    POSTGRESQL,
    ObjectSpec,
    Run,
)
from tidemark.operators.changes import region_semi_pruned
from tidemark.operators.transforms import with_ingest_ts, with_row_hash
from tidemark.plans import flows
from tidemark.session import fresh_folder, stage
from tidemark.sources.files import read_files
from tidemark.sources.ranges import in_ranges, range_filters, split_points
from tidemark.tables.hashes import HashIndexes
from tidemark.tables.hours import read_load
from tidemark.tables.partitions import PartitionedLoads


def _run(root, hour):
    return Run(RUN_TS + timedelta(hours=hour), root)


def _spec(name, method, **more):
    return ObjectSpec("shop", name, name, POSTGRESQL, method, **more)


def incremental_diff_bucketed(spark, sf_dir):
    """Two stored copies are compared by their bucketed hash indexes."""
    now = table(spark, sf_dir, "lineitem")
    discount = F.when(F.col("l_suppkey") % 5 == 0, F.col("l_discount") + 1).otherwise(F.col("l_discount"))
    before = now.where("l_orderkey % 9 <> 0").withColumn("l_discount", discount)
    current = stage(with_row_hash(now), "snapshot")
    indexes = HashIndexes(spark, fresh_folder(spark, "indexes"), bucket_rows=20_000)
    indexes.write(current, 2, current.count())
    indexes.write(with_row_hash(before), 1, current.count())
    fresh = stage(indexes.new_hashes(2, 1), "new-hashes")
    return current.join(fresh, HASH, "left_semi").select(*map(ref, COLUMNS["lineitem"]))


def retention_full_load(spark, sf_dir):
    """After five hourly full copies those of the three latest hours are left."""
    root, rows = fresh_folder(spark, "flow"), table(spark, sf_dir, "supplier")
    for hour in range(5):
        stores = flows.Stores.parquet(spark, _run(root, hour))
        flows.full_extract(rows.where(F.col("s_suppkey") % 5 <= hour), _spec("supplier", FULL_EXTRACT), stores)
    files = read_files(spark, [f"{root}/supplier/{FULL_LOAD}"])
    hour = F.regexp_extract(F.col("_metadata.file_path"), "/([0-9]{2})/[^/]*$", 1).cast("int") - RUN_TS.hour
    return files.select(hour.alias("hour"), *COLUMNS["supplier"])


def retention_raw(spark, sf_dir):
    """Five copies are landed; three contents of the raw target are left."""
    root, rows = fresh_folder(spark, "flow"), table(spark, sf_dir, "supplier")
    spec = _spec("supplier", FULL_EXTRACT, flatten_mode="SNOWFLAKE", lander_target="raw")
    for hour in range(5):
        stores = flows.Stores.parquet(spark, _run(root, hour))
        flows.full_extract(rows.where(F.col("s_suppkey") % 5 <= hour), spec, stores)
    files = spark.read.option("recursiveFileLookup", "true").parquet(stores.raw("raw").data_path)
    taken = F.regexp_extract(F.col("_metadata.file_path"), "snapshot_id=([0-9]+)", 1).cast("long")
    return files.select(taken.alias("snapshot_id"), "SRC")


def repeat_after_retention(spark, sf_dir):
    """Five hours, then the third latest one again: its increment is what it was."""
    root, rows = fresh_folder(spark, "flow"), table(spark, sf_dir, "supplier")
    for hour in (0, 1, 2, 3, 4, 2):
        stores = flows.Stores.parquet(spark, _run(root, hour))
        flows.full_extract_incr(rows.where(F.col("s_suppkey") % 5 <= hour), _spec("supplier", FULL_EXTRACT_INCR), stores)
    return read_load(spark, _run(root, 2), "supplier", INCR_LOAD).select(*COLUMNS["supplier"])


def land_partition_pruned(spark, sf_dir):
    """Loads of three hours, the second one written twice; what came after the first is landed."""
    loads, customers = PartitionedLoads(spark, fresh_folder(spark, "loads"), "customer"), table(spark, sf_dir, "customer")
    for hour, part in ((0, 0), (1, 2), (1, 1), (2, 2)):
        run = _run("/none", hour)
        rows = with_ingest_ts(with_row_hash(customers.where(F.col("c_custkey") % 3 == part)), run.run_ts)
        loads.write(rows, run, INCR_LOAD)
        loads.write(rows.limit(1), run, FULL_LOAD)
    return loads.raw_rows(FULL_EXTRACT_INCR, INCR_LOAD, _run("/none", 0).hour)


def region_semi_of_partitions(spark, sf_dir):
    """Customers stored by nation: the regions' filter prunes what is read of them."""
    path = fresh_folder(spark, "by-nation")
    table(spark, sf_dir, "customer").write.partitionBy("c_nationkey").parquet(path)
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return region_semi_pruned(
        spark.read.parquet(path), nations, "c_nationkey", "n_nationkey", "r_name", "west", REGIONS
    ).select(*COLUMNS["customer"])


def range_splits_lineitem(spark, sf_dir):
    """A slice of lines in eight ranges of price: each line is in one, none is twice the mean."""
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 10")
    points = split_points(lines, "l_extendedprice", 8)
    found = None
    for part in range_filters("l_extendedprice", points):
        rows = lines.where(part)
        found = rows if found is None else found.unionAll(rows)
    ranged = stage(in_ranges(found, "l_extendedprice", points), "ranges")
    sizes = ranged.groupBy("range").count()
    even = sizes.agg((F.max("count") < 2 * F.avg("count")).alias("even"), F.count(F.lit(1)).alias("ranges"))
    return ranged.drop("range").crossJoin(F.broadcast(even))


def checks():
    customers = json_sql([*COLUMNS["customer"], "INGEST_EFF_DTIMEUTC"])
    suppliers = json_sql([*COLUMNS["supplier"], "INGEST_EFF_DTIMEUTC"])
    return {
        "incremental_diff_bucketed": (incremental_diff_bucketed, LINEITEM_DIFF_SQL),
        "retention_full_load": (
            retention_full_load,
            "SELECT hour, supplier.* FROM supplier, (VALUES (2), (3), (4)) t(hour) WHERE s_suppkey % 5 <= hour",
        ),
        "retention_raw": (
            retention_raw,
            f'SELECT h + 1 AS snapshot_id, {suppliers} AS "SRC" FROM (SELECT *, {RUN_HOUR_SQL} + INTERVAL (h) HOUR AS '
            '"INGEST_EFF_DTIMEUTC" FROM supplier, (VALUES (2), (3), (4)) t(h) WHERE s_suppkey % 5 <= h)',
        ),
        "repeat_after_retention": (repeat_after_retention, "SELECT * FROM supplier WHERE s_suppkey % 5 = 2"),
        "land_partition_pruned": (
            land_partition_pruned,
            f'SELECT {customers} AS "SRC" FROM (SELECT *, {RUN_HOUR_SQL} + INTERVAL (c_custkey % 3) HOUR AS '
            '"INGEST_EFF_DTIMEUTC" FROM customer WHERE c_custkey % 3 > 0)',
        ),
        "region_semi_pruned": (
            region_semi_of_partitions,
            "SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation "
            "JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('EUROPE', 'AMERICA'))",
        ),
        "range_splits_lineitem": (
            range_splits_lineitem,
            "SELECT *, true AS even, 8 AS ranges FROM lineitem WHERE l_quantity > 10",
        ),
    }
