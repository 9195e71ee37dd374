"""File inventory, file log and the choice of files to land or retire."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from tidemark.functions.names import path_hour, path_part, relative_path
from tidemark.functions.rows import cut_to_hour, ntz, utc_wall_clock
from tidemark.model import FILE_INGEST_LOG, INCR_LOAD, NOT_AVAILABLE
from tidemark.session import few_rows
from tidemark.sources.files import path_exists

INVENTORY = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modified", T.TimestampNTZType()),
        T.StructField("length", T.LongType()),
    ]
)
FILE_NAME_NOISE = "_SUCCESS"


def file_inventory(spark: SparkSession, *paths: str) -> DataFrame:
    """Every file below ``paths``: path, UTC modification time, length.

    Spark lists the store in parallel; file contents are never read. Paths that
    do not exist hold no files.
    """

    present = [p for p in paths if path_exists(spark, p)]
    if not present:
        return few_rows(spark, [], INVENTORY)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(present)
    modified = utc_wall_clock(F.col("modificationTime")).alias("modified")
    return files.select("path", modified, "length")


def to_log_rows(inventory: DataFrame, table: str, bucket: str, run_ts: datetime) -> DataFrame:
    """Log rows of an inventory, not yet processed. Marker files are left out."""
    path = relative_path(F.col("path"), bucket)
    filled = {
        "FILE_WITH_PATH": path,
        "FILE_MODIFIED_DTIMEUTC": F.col("modified"),
        "PROCESSED_FLAG": F.lit(False),
        "FILE_UID": F.md5(path),
        "BUCKET_NAME": F.lit(bucket),
        "FILE_PROCESSED_DTIMEUTC": ntz(run_ts.replace(microsecond=0)),
        "TABLE_NAME": F.lit(table),
        "FILE_ERROR_MSG": F.lit(NOT_AVAILABLE),
        "MAP_SRC_TRGT_OBJECT_UID": F.lit(NOT_AVAILABLE),
        "CREATED_AT_DTIMEUTC": ntz(run_ts.replace(microsecond=0)),
        "REPROCESS_FLAG": F.lit(False),
    }
    return inventory.where(~F.element_at(F.split("path", "/"), -1).startswith(FILE_NAME_NOISE)).select(
        *[filled[f.name].cast(f.dataType).alias(f.name) for f in FILE_INGEST_LOG]
    )


def unlogged(log: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` whose file is not in the log yet."""
    return new.join(log.select("FILE_UID"), "FILE_UID", "left_anti").select(*new.columns)


def pending_files(log: DataFrame, table: str, scheme: str = "s3a://") -> DataFrame:
    """Unprocessed files of a table with their absolute path."""
    return log.where((F.col("TABLE_NAME") == table) & ~F.col("PROCESSED_FLAG")).select(
        "FILE_UID",
        F.concat(F.lit(scheme), "BUCKET_NAME", F.lit("/"), "FILE_WITH_PATH").alias("file_path"),
    )


def files_since(log: DataFrame, table: str, since: datetime | str) -> DataFrame:
    """Increment files of a table modified after ``since``."""
    path = F.col("FILE_WITH_PATH")
    return log.where(
        (path_part(path, 0) == table)
        & (path_part(path, 1) == INCR_LOAD)
        & (F.col("FILE_MODIFIED_DTIMEUTC") > ntz(since))
    )


def latest_hour_files(log: DataFrame, table: str) -> DataFrame:
    """Files of a table's latest run hour, as told by their paths.

    The latest hour is one row, so sending it to every task is always safe.
    """
    own = log.where(path_part(F.col("FILE_WITH_PATH"), 0) == table)
    hour = path_hour(F.col("FILE_WITH_PATH"))
    latest = own.agg(F.max(hour).alias("latest"))
    return own.join(F.broadcast(latest), hour == F.col("latest"), "left_semi")


def mark_processed(log: DataFrame, done: DataFrame, ts: datetime) -> DataFrame:
    """Set the processed flag and time of the files named in ``done``."""
    ids = done.select("FILE_UID").distinct().withColumn("done", F.lit(True))
    changed = {
        "PROCESSED_FLAG": F.coalesce("done", "PROCESSED_FLAG"),
        "FILE_PROCESSED_DTIMEUTC": F.when(F.col("done"), ntz(ts)).otherwise(
            F.col("FILE_PROCESSED_DTIMEUTC")
        ),
    }
    return log.join(ids, "FILE_UID", "left").select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in log.columns]
    )


def expired_files(inventory: DataFrame, keep: int = 3, group: str = "table_name") -> DataFrame:
    """Files older than the ``keep`` latest run hours of their group.

    Hours are made distinct before they are ranked, so a ranking window holds the
    hours of a group and never its files; files are then matched by group and
    hour, which spreads a group that owns most of the files.
    """
    stamped = inventory.withColumn("run_hour", cut_to_hour(F.col("modified")))
    expired = expired_hours(stamped, keep, group)
    return stamped.join(expired, [group, "run_hour"], "left_semi").select(*inventory.columns)


def expired_hours(files: DataFrame, keep: int = 3, group: str = "table_name") -> DataFrame:
    """(group, run_hour) of the hours before the ``keep`` latest ones of each group."""
    latest_first = Window.partitionBy(group).orderBy(F.col("run_hour").desc())
    return (
        files.select(group, "run_hour")
        .distinct()
        .withColumn("rank", F.dense_rank().over(latest_first))
        .where(F.col("rank") > keep)
        .select(group, "run_hour")
    )
