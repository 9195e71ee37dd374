"""The stored file log.

Log rows are Parquet files in one folder per logged table and written load. Logging a
load replaces that load's rows, so a repeat leaves no row of a file that is gone, and
nothing older is read or rewritten. Files that were processed are noted beside the log,
in an event log per table that is folded to one file; a reader joins the two.
"""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.names import key_below
from tidemark.functions.rows import ntz
from tidemark.model import FILE_INGEST_LOG, Run
from tidemark.operators.filelog import file_inventory, pending_files, to_log_rows
from tidemark.session import few_rows
from tidemark.sources.files import path_exists
from tidemark.tables.events import EventLog

PROCESSED = T.StructType(
    [
        T.StructField("FILE_UID", T.StringType()),
        T.StructField("processed_at", T.TimestampNTZType()),
    ]
)


class FileLog:
    """Runs over different tables, and over different loads of one, can log at once."""

    def __init__(self, spark: SparkSession, root: str, name: str = "file_ingest_log"):
        self.spark, self.root = spark, f"{root.rstrip('/')}/{name}"

    def _stored(self, kind: str, tables: tuple[str, ...], schema: T.StructType) -> DataFrame:
        folders = [f"{self.root}/{kind}/{t}" for t in tables] or [f"{self.root}/{kind}"]
        present = [f for f in folders if path_exists(self.spark, f)]
        if not present:
            return few_rows(self.spark, [], schema)
        reader = self.spark.read.schema(schema).option("recursiveFileLookup", "true")
        return reader.parquet(*present)

    def read(self, *tables: str) -> DataFrame:
        """Log rows of the given tables, of all logged tables when none is given."""
        rows = self._stored("files", tables, FILE_INGEST_LOG)
        notes = self._stored("processed", tables, PROCESSED)
        done = notes.groupBy("FILE_UID").agg(F.max("processed_at").alias("processed_at"))
        changed = {
            "PROCESSED_FLAG": F.col("PROCESSED_FLAG") | F.col("processed_at").isNotNull(),
            "FILE_PROCESSED_DTIMEUTC": F.coalesce("processed_at", "FILE_PROCESSED_DTIMEUTC"),
        }
        return rows.join(done, "FILE_UID", "left").select(
            *[changed.get(c, F.col(c)).alias(c) for c in FILE_INGEST_LOG.names]
        )

    def record(self, run: Run, table: str, folder: str) -> None:
        """Log the files of a written folder in the place of what was logged for it."""
        load = hashlib.md5(key_below(folder, run.bucket).encode()).hexdigest()
        new = to_log_rows(file_inventory(self.spark, folder), table, run.bucket, run.run_ts)
        # One row per written file is little: one log file holds it.
        new.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/files/{table}/load={load}")

    def forget(self, run: Run, table: str, folders: list[str]) -> None:
        """The files of deleted folders wait for nothing any more; their rows stay."""
        if folders:
            below = F.lit(False)
            for folder in folders:
                below = below | F.col("FILE_WITH_PATH").startswith(key_below(folder, run.bucket) + "/")
            self.done(table, self.read(table).where(below & ~F.col("PROCESSED_FLAG")), run.run_ts)

    def pending(self, run: Run, table: str) -> DataFrame:
        return pending_files(self.read(table), table, run.scheme)

    def done(self, table: str, files: DataFrame, ts: datetime) -> None:
        """Note the files named in ``files`` as processed."""
        notes = files.select("FILE_UID", ntz(ts).alias("processed_at")).distinct()
        EventLog(self.spark, f"{self.root}/processed/{table}", PROCESSED, ("FILE_UID",)).append(notes)
