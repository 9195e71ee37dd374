"""Landing: bronze files to one-column JSON rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.names import relative_path
from tidemark.model import FULL_EXTRACT, FULL_EXTRACT_INCR, NOT_AVAILABLE, Run
from tidemark.operators.filelog import files_since, latest_hour_files
from tidemark.operators.transforms import drop_technical, to_src
from tidemark.session import stage
from tidemark.sources.files import by_schema, read_files
from tidemark.tables.log import FileLog
from tidemark.tables.snapshots import VersionedTable


def land(df: DataFrame, target: VersionedTable, run: Run) -> None:
    """Replace the rows of the raw target in one step; old contents go after some hours."""
    target.replace(df, run.hour, max_records=run.max_records_per_file)
    target.retire()


def land_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace the rows of a warehouse table, keeping its definition and grants."""
    df.write.format("jdbc").mode("overwrite").options(
        url=url, dbtable=table, truncate="true", **options
    ).save()


def raw_rows(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Bronze files as raw rows: technical columns off, the rest as JSON text."""
    return to_src(drop_technical(read_files(spark, paths, schema)))


def land_files(
    spark: SparkSession,
    paths: Sequence[str],
    target: VersionedTable,
    run: Run,
    schema: T.StructType | None = None,
) -> None:
    land(raw_rows(spark, paths, schema), target, run)


def files_to_land(log: DataFrame, table: str, method: str | None, since: str | None) -> DataFrame:
    """Log rows of a table's unprocessed files that its extract method lands.

    A full copy holds all rows, so of full extracts only the latest hour counts. Of
    increments those modified after ``since`` count. Without a method all do.
    """
    waiting = log.where((F.col("TABLE_NAME") == table) & ~F.col("PROCESSED_FLAG"))
    if method == FULL_EXTRACT:
        # The latest hour of all files, landed or not: an older copy never follows it.
        return latest_hour_files(log.where(F.col("TABLE_NAME") == table), table).where(~F.col("PROCESSED_FLAG"))
    if method == FULL_EXTRACT_INCR and since not in (None, "", NOT_AVAILABLE):
        return files_since(waiting, table, since)
    return waiting


def land_pending(
    spark: SparkSession,
    log: FileLog,
    table: str,
    target: VersionedTable,
    run: Run,
    method: str | None = None,
    since: str | None = None,
) -> int:
    """Land the files of a table that are due, then mark them. Returns their number.

    Load folders come to the driver, a few per hour; files are picked by a semi-join of
    their rows with the log. Each folder is read in its own schema, since columns may
    have been added or retyped between two loads. Full copies that a later one replaced are marked as well. The
    log is marked after the target is published: a crash between the two lands the same
    files again into a target that is replaced, never doubled.
    """
    logged = log.read(table)
    due = stage(files_to_land(logged, table, method, since).select("FILE_UID", "FILE_WITH_PATH"), "due-files")
    folder = F.regexp_replace("FILE_WITH_PATH", "/[^/]*$", "")
    folders = [r[0] for r in due.select(folder).distinct().collect()]
    if not folders:
        return 0
    landed = None
    for rows in by_schema(spark, [f"{run.root}/{f}" for f in sorted(folders)]):
        named = rows.withColumn("__file", relative_path(F.col("_metadata.file_path"), run.bucket))
        picked = named.join(due, F.col("__file") == F.col("FILE_WITH_PATH"), "left_semi").drop("__file")
        src = to_src(drop_technical(picked))
        landed = src if landed is None else landed.unionAll(src)
    land(landed, target, run)
    done = due.select("FILE_UID")
    if method == FULL_EXTRACT:
        done = done.unionAll(logged.where(~F.col("PROCESSED_FLAG")).select("FILE_UID"))
    log.done(table, done, run.run_ts)
    return due.count()
