"""Versioned Parquet tables: write, publish, read, roll back.

A table is a folder of snapshot folders plus a small append-only snapshot log.
Readers follow the log alone, so a half-written snapshot is never seen, and a
roll back is one more log row. The log also keeps each snapshot's schema, so a
read starts without opening a single footer. One writer per table is assumed.
Where a lakehouse runtime is on the class path, use ``tables.lakehouse`` instead.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from tidemark.functions.rows import cut_to_hour
from tidemark.model import HASH_VERSION, SNAPSHOT_LOG
from tidemark.session import few_rows
from tidemark.sources.files import delete_folder, path_exists

APPEND, REPLACE, ROLLBACK = "append", "replace", "rollback"

#: Run hours whose snapshots are kept as backups.
BACKUP_HOURS = 3

_WIDER = {("int", "bigint"), ("float", "double")}


def current_snapshot(log: DataFrame, *order: str) -> DataFrame:
    """The log row of every table's current snapshot: the greatest by ``order``.

    A maximum over structs merges before the shuffle and is the same on ties.
    """
    order = order or ("committed_at", "snapshot_id")
    rest = [c for c in log.columns if c not in order and c != "table_name"]
    return (
        log.groupBy("table_name")
        .agg(F.max(F.struct(*order, *rest)).alias("row"))
        .select("table_name", *[F.col(f"row.{c}").alias(c) for c in log.columns if c != "table_name"])
    )


def expired_snapshots(log: DataFrame, keep: int = 3) -> DataFrame:
    """Superseded snapshots beyond the ``keep`` latest run hours of their table.

    Ranks distinct hours only, then matches rows by table and hour. The current
    snapshot is by definition in the latest hour and is never listed.
    """
    stamped = log.withColumn("commit_hour", cut_to_hour(F.col("committed_at")))
    latest_first = Window.partitionBy("table_name").orderBy(F.col("commit_hour").desc())
    expired = (
        stamped.select("table_name", "commit_hour")
        .distinct()
        .withColumn("rank", F.dense_rank().over(latest_first))
        .where(F.col("rank") > keep)
        .drop("rank")
    )
    return stamped.join(expired, ["table_name", "commit_hour"], "left_semi").select(*log.columns)


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` followed by the columns only ``new`` has; integers and floats widen."""
    found = {f.name: f for f in old}
    for f in new:
        have = found.get(f.name)
        if have is None:
            found[f.name] = T.StructField(f.name, f.dataType, True)
            continue
        pair = (have.dataType.simpleString(), f.dataType.simpleString())
        if pair in _WIDER:
            found[f.name] = T.StructField(f.name, f.dataType, True)
        elif pair[0] != pair[1] and pair[::-1] not in _WIDER:
            raise ValueError(f"column {f.name!r} cannot change from {pair[0]} to {pair[1]}")
    return T.StructType(list(found.values()))


def _schema_of(row: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(row.data_schema))


def _live(rows: list[Row]) -> Row | None:
    """The last row, unless it rolled the table back to the time before any data."""
    return rows[-1] if rows and rows[-1].snapshot_id is not None else None


class VersionedTable:
    def __init__(
        self, spark: SparkSession, root: str, name: str, history: list[Row] | None = None
    ):
        self.spark, self.name = spark, name
        self.path = f"{root.rstrip('/')}/{name}"
        self.log_path = f"{self.path}/_snapshot_log"
        self.data_path = f"{self.path}/full_load"
        self._history = history

    # -- the snapshot log -------------------------------------------------

    def log(self) -> DataFrame:
        if not path_exists(self.spark, self.log_path):
            return few_rows(self.spark, [], SNAPSHOT_LOG)
        return self.spark.read.schema(SNAPSHOT_LOG).parquet(self.log_path)

    def history(self) -> list[Row]:
        """The log on the driver, oldest first: one small row per commit.

        Read once per object; commits through the object keep it up to date, and
        ``refresh`` picks up those of others.
        """
        if self._history is None:
            exists = path_exists(self.spark, self.log_path)
            rows = self.log().collect() if exists else []
            self._history = sorted(rows, key=lambda r: r.version)
        return self._history

    def refresh(self) -> VersionedTable:
        self._history = None
        return self

    def current(self) -> Row | None:
        return _live(self.history())

    def before(self, hour: datetime) -> Row | None:
        """The snapshot that was current when the given run hour began.

        A repeated run of an hour compares with this one, so what it finds new
        includes what the first run of that hour found.
        """
        return _live([r for r in self.history() if r.run_hour is None or r.run_hour < hour])

    def _commit(self, row: dict) -> Row:
        rows = self.history()
        full = {
            "table_name": self.name,
            "version": (rows[-1].version if rows else 0) + 1,
            "committed_at": datetime.now(timezone.utc).replace(tzinfo=None),
            "hash_version": HASH_VERSION,
            **row,
        }
        values = tuple(full.get(f.name) for f in SNAPSHOT_LOG)
        few_rows(self.spark, [values], SNAPSHOT_LOG).write.mode("append").parquet(self.log_path)
        committed = Row(**dict(zip(SNAPSHOT_LOG.names, values)))
        self._history = [*rows, committed]
        return committed

    # -- writing ----------------------------------------------------------

    def snapshot_path(self, snapshot_id: int) -> str:
        return f"{self.data_path}/snapshot_id={snapshot_id}"

    def next_id(self) -> int:
        return max((r.snapshot_id or 0 for r in self.history()), default=0) + 1

    def write(
        self, df: DataFrame, files: int | None = None, max_records: int = 0
    ) -> tuple[int, T.StructType]:
        """Write an unpublished snapshot; a retry overwrites its own leftovers."""
        snapshot_id = self.next_id()
        write_parquet(df, self.snapshot_path(snapshot_id), files, max_records)
        return snapshot_id, df.schema

    def publish(
        self,
        snapshot_id: int,
        schema: T.StructType,
        operation: str = REPLACE,
        run_hour: datetime | None = None,
        slice_key: str | None = None,
        parent: Row | None = None,
    ) -> Row:
        """Make a written snapshot, made on top of ``parent``, the current one."""
        return self._commit(
            {
                "snapshot_id": snapshot_id,
                "parent_id": parent.snapshot_id if parent is not None else None,
                "operation": operation,
                "run_hour": run_hour,
                "slice_key": slice_key,
                "data_schema": schema.json(),
            }
        )

    def replace(self, df: DataFrame, run_hour: datetime | None = None, **write) -> Row:
        """New contents, by name, seen by readers in one step."""
        snapshot_id, schema = self.write(df, **write)
        return self.publish(snapshot_id, schema, REPLACE, run_hour, parent=self.current())

    def append(
        self,
        df: DataFrame,
        run_hour: datetime | None = None,
        slice_key: str | None = None,
        **write,
    ) -> Row:
        """Add rows; new columns are added to the schema and are null in older rows.

        With ``slice_key`` an append is idempotent: repeating the last slice puts
        the new rows in the place of its first attempt.
        """
        base = self.current()
        if base is not None and slice_key is not None and base.slice_key == slice_key:
            base = self._record(base.parent_id)
        schema = df.schema
        if base is not None:
            schema = merged_schema(_schema_of(base), schema)
        snapshot_id, _ = self.write(df, **write)
        return self.publish(
            snapshot_id,
            schema,
            APPEND if base is not None else REPLACE,
            run_hour,
            slice_key,
            base,
        )

    def rollback(self, to_empty: bool = False) -> Row:
        """Make the parent of the current snapshot current again.

        The first snapshot has no parent; ``to_empty`` undoes it nevertheless.
        """
        current = self.current()
        parent = self._record(current.parent_id) if current else None
        if parent is None and not (current and to_empty):
            raise ValueError(f"table {self.name!r} has no earlier snapshot")
        kept = ("snapshot_id", "parent_id", "run_hour", "slice_key", "data_schema")
        return self._commit(
            {"operation": ROLLBACK, **({k: parent[k] for k in kept} if parent else {})}
        )

    def of_latest_hours(self, keep: int) -> set[int]:
        """Ids of the snapshots made in the ``keep`` latest run hours, or in no hour."""
        made = {r.snapshot_id: r.run_hour for r in self.history() if r.operation != ROLLBACK}
        hours = sorted({h for h in made.values() if h is not None}, reverse=True)[:keep]
        return {i for i, hour in made.items() if hour is None or hour in hours}

    def retire(self, keep: int = BACKUP_HOURS) -> list[int]:
        """Delete superseded snapshots beyond the ``keep`` latest run hours.

        The current snapshot, and what it is made of, stays; so does what a reader of
        the ``keep`` latest hours may hold. The log keeps a row of each snapshot.
        """
        made = {r.snapshot_id: r.run_hour for r in self.history() if r.operation != ROLLBACK}
        hours = sorted({h for h in made.values() if h is not None}, reverse=True)[:keep]
        held = set(self.folders())
        gone = []
        for snapshot_id, hour in made.items():
            path = self.snapshot_path(snapshot_id)
            if hour is None or hour in hours or path in held or not hours or hour > hours[-1]:
                continue
            if path_exists(self.spark, path):
                delete_folder(self.spark, path)
                gone.append(snapshot_id)
        return gone

    # -- reading ----------------------------------------------------------

    def _record(self, snapshot_id: int | None) -> Row | None:
        """The row that first published a snapshot."""
        for row in self.history():
            if row.snapshot_id == snapshot_id and row.operation != ROLLBACK:
                return row
        return None

    def _folders(self, snapshot_id: int) -> list[str]:
        made = {r.snapshot_id: r for r in self.history() if r.operation != ROLLBACK}
        found = []
        while snapshot_id is not None:
            row = made[snapshot_id]
            found.append(self.snapshot_path(snapshot_id))
            snapshot_id = row.parent_id if row.operation == APPEND else None
        return found[::-1]

    def folders(self) -> list[str]:
        """The data folders of the current snapshot."""
        current = self.current()
        return [] if current is None else self._folders(current.snapshot_id)

    def read(self, snapshot_id: int | None = None) -> DataFrame:
        """The current snapshot, or an earlier one by id."""
        row = self.current() if snapshot_id is None else self._record(snapshot_id)
        if row is None:
            raise ValueError(f"table {self.name!r} has no snapshot {snapshot_id or ''}".rstrip())
        schema = _schema_of(row)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(
            *self._folders(row.snapshot_id)
        )

    def read_or_empty(self, schema: T.StructType) -> DataFrame:
        return few_rows(self.spark, [], schema) if self.current() is None else self.read()


def write_parquet(
    df: DataFrame, path: str, files: int | None = None, max_records: int = 0
) -> None:
    """Overwrite one folder. ``files`` costs a shuffle of all rows; leave it out at
    scale and bound the file size by ``max_records`` instead."""
    if files:
        df = df.repartition(files)
    df.write.option("maxRecordsPerFile", max_records).mode("overwrite").parquet(path)

