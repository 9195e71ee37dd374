"""File inventory and file log; retention; readers of files and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.derived import (
    COLUMNS,
    INVENTORY_SQL,
    LOG_SQL,
    RUN_TS,
    RUN_TS_SQL,
    file_log,
    inventory,
    json_sql,
    table,
)
from tidemark.functions.names import relative_path
from tidemark.model import INCR_LOAD, Run
from tidemark.operators import filelog as fl
from tidemark.operators.transforms import void_to_string, with_row_hash
from tidemark.plans.lander import land_files
from tidemark.session import fresh_folder
from tidemark.sources.files import read_documents, read_files
from tidemark.tables.hours import write_load
from tidemark.tables.log import FileLog
from tidemark.tables.snapshots import VersionedTable, expired_snapshots
from tidemark.tables.snapshots import current_snapshot as current_rows


def file_log_rows(spark, sf_dir):
    return fl.to_log_rows(inventory(spark, sf_dir), "all", "lake", RUN_TS)


FILE_LOG_ROWS_SQL = f"""
WITH {LOG_SQL} SELECT * REPLACE (false AS PROCESSED_FLAG, 'all' AS TABLE_NAME) FROM file_log"""


def relative_paths(spark, sf_dir):
    return inventory(spark, sf_dir).select(
        "length", relative_path(F.col("path"), "lake").alias("file_key")
    )


def pending_files(spark, sf_dir):
    return fl.pending_files(file_log(spark, sf_dir), "tbl_1")


def files_since(spark, sf_dir):
    return fl.files_since(file_log(spark, sf_dir), "tbl_1", "2024-01-10 06:00:00").select(
        "FILE_UID", "FILE_WITH_PATH"
    )


def latest_hour_files(spark, sf_dir):
    return fl.latest_hour_files(file_log(spark, sf_dir), "tbl_1").select(
        "FILE_UID", "FILE_WITH_PATH"
    )


LATEST_HOUR_SQL = f"""
WITH {LOG_SQL},
own AS (SELECT *, string_split(FILE_WITH_PATH, '/') AS p FROM file_log
  WHERE split_part(FILE_WITH_PATH, '/', 1) = 'tbl_1'),
hours AS (SELECT *, CASE WHEN len(p) > 5
  THEN p[3] || '-' || p[4] || '-' || p[5] || '-' || p[6] END AS h FROM own)
SELECT FILE_UID, FILE_WITH_PATH FROM hours WHERE h = (SELECT max(h) FROM hours)"""


def mark_processed(spark, sf_dir):
    log = file_log(spark, sf_dir)
    done = fl.pending_files(log, "tbl_2").select("FILE_UID")
    return fl.mark_processed(log, done.unionAll(done), RUN_TS.replace(hour=12)).select(
        "FILE_UID", "PROCESSED_FLAG", "FILE_PROCESSED_DTIMEUTC"
    )


MARK_PROCESSED_SQL = f"""
WITH {LOG_SQL}
SELECT FILE_UID, PROCESSED_FLAG OR TABLE_NAME = 'tbl_2' AS PROCESSED_FLAG,
  CASE WHEN TABLE_NAME = 'tbl_2' AND NOT PROCESSED_FLAG THEN {RUN_TS_SQL} + INTERVAL 2 HOUR
    ELSE FILE_PROCESSED_DTIMEUTC END AS FILE_PROCESSED_DTIMEUTC
FROM file_log"""


def unlogged_files(spark, sf_dir):
    """A listing in which some files are in the log already."""
    log = file_log(spark, sf_dir).where("length(FILE_UID) = 32 AND substr(FILE_UID, 1, 1) < '8'")
    return fl.unlogged(log, file_log(spark, sf_dir)).select("FILE_UID", "TABLE_NAME")


def expired_files(spark, sf_dir):
    return fl.expired_files(inventory(spark, sf_dir), keep=3)


EXPIRED_FILES_SQL = f"""
WITH {INVENTORY_SQL},
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY table_name
  ORDER BY date_trunc('hour', modified) DESC) AS r FROM inventory)
SELECT table_name, path, modified, length FROM ranked WHERE r > 3"""


def _snapshot_log(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "concat('t', cast(user_id as string)) AS table_name",
        "event_id AS snapshot_id",
        "event_id - 1 AS parent_id",
        "date_trunc('minute', ts) AS committed_at",
    ).withColumn("committed_at", F.col("committed_at").cast("timestamp_ntz"))


SNAPSHOT_LOG_SQL = """
log AS (SELECT 't' || user_id AS table_name, event_id AS snapshot_id,
  event_id - 1 AS parent_id, date_trunc('minute', ts) AS committed_at FROM events)"""


def expired_snapshot_rows(spark, sf_dir):
    return expired_snapshots(_snapshot_log(spark, sf_dir), keep=3)


def current_snapshot(spark, sf_dir):
    return current_rows(_snapshot_log(spark, sf_dir))


def file_inventory(spark, sf_dir):
    """The folders that a partitioned write of the orders really produced."""
    path = fresh_folder(spark, "inventory")
    table(spark, sf_dir, "orders").write.partitionBy("o_orderstatus", "o_orderpriority").parquet(
        path
    )
    found = fl.file_inventory(spark, path)
    parts = F.split("path", "/")
    return (
        found.where("length > 0 AND modified IS NOT NULL")
        .select(
            F.element_at(parts, -3).alias("status_folder"),
            F.element_at(parts, -2).alias("priority_folder"),
        )
        .distinct()
    )


def read_file_list(spark, sf_dir):
    """Two explicit folders of different schema, read together."""
    first, second = fresh_folder(spark, "list"), fresh_folder(spark, "list")
    customers = table(spark, sf_dir, "customer")
    customers.where("c_custkey % 2 = 0").write.parquet(first)
    customers.where("c_custkey % 2 = 1").withColumn("tier", F.lit("new")).write.parquet(second)
    return read_files(spark, [first, second])


def read_file_list_empty(spark, sf_dir):
    """No pending file at all: an empty frame of the known schema, added to real rows."""
    rows = table(spark, sf_dir, "customer")
    return rows.unionByName(read_files(spark, [], rows.schema))


def read_json_documents(spark, sf_dir):
    """Event properties as JSON documents, schema inferred, an always-null field kept."""
    path = fresh_folder(spark, "documents")
    table(spark, sf_dir, "events").select(
        F.concat(
            F.lit('{"id": '), F.col("event_id"), F.lit(', "gap": null, "props": '), "props", F.lit("}")
        )
    ).write.text(path)
    found = void_to_string(read_documents(spark, path))
    return found.select("id", "gap", F.col("props.k").alias("k"))


def landed_files(spark, sf_dir):
    """Bronze files, explicitly listed, replace what the raw target held before."""
    run = Run(RUN_TS, fresh_folder(spark, "landing"))
    customers = with_row_hash(table(spark, sf_dir, "customer"))
    folder = write_load(customers, run, "customer", INCR_LOAD)
    target = VersionedTable(spark, run.root, "raw_customer")
    target.replace(table(spark, sf_dir, "orders").selectExpr("'old' AS SRC"))
    land_files(spark, [folder], target, run)
    return target.read()


def stored_file_log(spark, sf_dir):
    """Orders written and logged by status; the logged files hold exactly their rows, twice tried."""
    run = Run(RUN_TS, fresh_folder(spark, "logged"), files=2)
    orders, log = table(spark, sf_dir, "orders"), FileLog(spark, run.root)
    found = None
    for status in ("F", "O", "P"):
        for _ in range(2):  # the second try replaces the files of the first
            rows = orders.where(F.col("o_orderstatus") == status)
            log.record(run, status, write_load(rows, run, status, INCR_LOAD))
        paths = [r.file_path for r in log.pending(run, status).collect()]
        held = read_files(spark, paths, orders.schema).select(F.lit(status).alias("table_name"), "*")
        found = held if found is None else found.unionAll(held)
    logged = log.read().groupBy(F.col("TABLE_NAME").alias("table_name")).agg(
        F.count(F.lit(1)).alias("files"), F.bool_or("PROCESSED_FLAG").alias("processed")
    )
    return found.join(logged, "table_name")


def checks():
    return {
        "file_log_rows": (file_log_rows, FILE_LOG_ROWS_SQL),
        "relative_paths": (
            relative_paths,
            f"WITH {INVENTORY_SQL} SELECT length, replace(path, 's3a://lake/', '') AS file_key "
            "FROM inventory",
        ),
        "pending_files": (
            pending_files,
            f"WITH {LOG_SQL} SELECT FILE_UID, 's3a://lake/' || FILE_WITH_PATH AS file_path "
            "FROM file_log WHERE TABLE_NAME = 'tbl_1' AND NOT PROCESSED_FLAG",
        ),
        "files_since": (
            files_since,
            f"WITH {LOG_SQL} SELECT FILE_UID, FILE_WITH_PATH FROM file_log "
            "WHERE FILE_WITH_PATH LIKE 'tbl#_1/incr#_load/%' ESCAPE '#' "
            "AND FILE_MODIFIED_DTIMEUTC > TIMESTAMP '2024-01-10 06:00:00'",
        ),
        "latest_hour_files": (latest_hour_files, LATEST_HOUR_SQL),
        "mark_processed": (mark_processed, MARK_PROCESSED_SQL),
        "unlogged_files": (
            unlogged_files,
            f"WITH {LOG_SQL} SELECT FILE_UID, TABLE_NAME FROM file_log "
            "WHERE substr(FILE_UID, 1, 1) >= '8'",
        ),
        "expired_files": (expired_files, EXPIRED_FILES_SQL),
        "expired_snapshots": (
            expired_snapshot_rows,
            f"WITH {SNAPSHOT_LOG_SQL} SELECT * FROM log QUALIFY dense_rank() OVER "
            "(PARTITION BY table_name ORDER BY date_trunc('hour', committed_at) DESC) > 3",
        ),
        "current_snapshot": (
            current_snapshot,
            f"WITH {SNAPSHOT_LOG_SQL} SELECT * FROM log QUALIFY row_number() OVER "
            "(PARTITION BY table_name ORDER BY committed_at DESC, snapshot_id DESC) = 1",
        ),
        "file_inventory": (
            file_inventory,
            "SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS status_folder, "
            "'o_orderpriority=' || o_orderpriority AS priority_folder FROM orders",
        ),
        "read_file_list": (
            read_file_list,
            "SELECT *, CASE WHEN c_custkey % 2 = 1 THEN 'new' END AS tier FROM customer",
        ),
        "read_file_list_empty": (read_file_list_empty, "SELECT * FROM customer"),
        "read_documents": (
            read_json_documents,
            "SELECT event_id AS id, NULL::VARCHAR AS gap, (props::JSON ->> 'k')::BIGINT AS k "
            "FROM events",
        ),
        "stored_file_log": (
            stored_file_log,
            "SELECT o_orderstatus AS table_name, 2::BIGINT AS files, false AS processed, orders.* FROM orders",
        ),
        "land_files": (
            landed_files,
            f'SELECT {json_sql(COLUMNS["customer"])} AS "SRC" FROM customer',
        ),
    }


