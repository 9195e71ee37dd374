"""Hour folders: ``<root>/<table>/<kind>/yyyy/mm/dd/hh``."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.names import hour_path, path_hour, relative_path
from tidemark.model import FULL_LOAD, INCR_LOAD, KEY_INCR_LOAD, Run
from tidemark.operators.filelog import expired_hours, file_inventory
from tidemark.sources.files import delete_folder, read_files
from tidemark.tables.snapshots import write_parquet


def load_path(run: Run, table: str, kind: str, slice_key: str | None = None) -> str:
    """The folder a run writes a load of a table to.

    A checkpoint extract can run several times an hour, each time with rows the
    earlier ones lack, so each try gets a folder of its own inside the hour.
    """
    path = hour_path(run.root, table, kind, run.hour)
    if kind == KEY_INCR_LOAD and slice_key is not None:
        path += "/slice=" + hashlib.md5(slice_key.encode()).hexdigest()[:12]
    return path


def write_load(
    df: DataFrame, run: Run, table: str, kind: str, slice_key: str | None = None
) -> str:
    """Write one load; repeating it changes nothing. Returns its folder."""
    if kind not in (FULL_LOAD, INCR_LOAD, KEY_INCR_LOAD):
        raise ValueError(f"unknown load kind {kind!r}")
    path = load_path(run, table, kind, slice_key)
    write_parquet(df, path, run.files, run.max_records_per_file)
    return path


def read_load(
    spark: SparkSession,
    run: Run,
    table: str,
    kind: str,
    schema: T.StructType | None = None,
) -> DataFrame:
    """All rows of one load hour."""
    return read_files(spark, [hour_path(run.root, table, kind, run.hour)], schema)


def expire_loads(spark: SparkSession, run: Run, table: str, kind: str, keep: int) -> list[str]:
    """Delete the load folders of a kind beyond the ``keep`` latest hours; returns them.

    Hours are told by the paths, so copying files about renews none. A run leaves one hour
    to expire, so a folder or so comes to the driver, never a list of files.
    """
    inventory = file_inventory(spark, f"{run.root}/{table}/{kind}")
    path = relative_path(F.col("path"), run.bucket)
    files = inventory.select(F.lit(table).alias("table_name"), path_hour(path).alias("run_hour"))
    hours = expired_hours(files.where("run_hour IS NOT NULL"), keep).collect()
    folders = [f"{run.root}/{table}/{kind}/{r.run_hour.replace('-', '/')}" for r in hours]
    for folder in folders:
        delete_folder(spark, folder)
    return folders
