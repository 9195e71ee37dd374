"""The ingestion flows: source slice to bronze, file log, lander and checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from tidemark.functions.names import database_name, target_name_of
from tidemark.functions.rows import ref
from tidemark.model import (
    BRONZE,
    CASSANDRA,
    FLATTEN_LAND,
    FULL_EXTRACT,
    FULL_EXTRACT_INCR,
    FULL_LOAD,
    HASH,
    HASH_VERSION,
    INCR_LOAD,
    KEY_INCR_EXTRACT,
    KEY_INCR_LOAD,
    LANDER,
    STORE_APPEND,
    STORE_REPLACE,
    ObjectSpec,
    Run,
)
from tidemark.operators.changes import DiffLimits, new_rows
from tidemark.operators.checkpoint import observe_checkpoint, observed_value
from tidemark.operators.config import active_objects, object_specs
from tidemark.operators.transforms import (
    lowercase_columns,
    normalise_timestamps,
    rename_reserved,
    with_ingest_ts,
    with_row_hash,
)
from tidemark.plans.lander import land_pending
from tidemark.session import stage
from tidemark.sources.readers import Loader, read_source
from tidemark.sources.files import path_exists
from tidemark.tables.appends import AppendTable
from tidemark.tables.checkpoints import OBJECT, CheckpointMoves, carried_config, current_moves
from tidemark.tables.hashes import HashIndexes
from tidemark.tables.hours import expire_loads, load_path, write_load
from tidemark.tables.log import FileLog
from tidemark.tables.snapshots import BACKUP_HOURS, REPLACE, VersionedTable, write_parquet
from tidemark.tables.tries import Tries, new_try

Advance = Callable[[ObjectSpec, str], None] | CheckpointMoves


@dataclass(frozen=True)
class Outcome:
    """What one object's flow did."""

    source_table: str
    target_table: str
    extract_method: str
    written_to: str
    checkpoint: str | None = None
    landed_files: int = 0


@dataclass(frozen=True)
class Stores:
    """Where a flow keeps tables.

    ``table(database, name)`` gives a lakehouse target that is replaced, and
    ``append_table`` one that grows by slices: Parquet tables by default, a
    ``LakehouseTable`` for both where such a runtime is present.
    """

    spark: SparkSession
    run: Run
    log: FileLog
    table: Callable[[str, str], VersionedTable]
    append_table: Callable[[str, str], AppendTable]

    @classmethod
    def parquet(cls, spark: SparkSession, run: Run) -> Stores:
        return cls(
            spark,
            run,
            FileLog(spark, run.root),
            lambda database, name: VersionedTable(spark, f"{run.root}/{database}", name),
            lambda database, name: AppendTable(spark, f"{run.root}/{database}", name),
        )

    def lakehouse(self, name: str):
        return self.table(database_name(self.run.database), name)

    def appended(self, name: str):
        return self.append_table(database_name(self.run.database), name)

    def raw(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.run.root}/raw", name)


def _for_lakehouse(df: DataFrame) -> DataFrame:
    return normalise_timestamps(lowercase_columns(df))


def _land_if_configured(spec: ObjectSpec, stores: Stores) -> int:
    if spec.flatten_mode != FLATTEN_LAND:
        return 0
    target = stores.raw(spec.lander_target)
    return land_pending(
        stores.spark, stores.log, spec.target_table, target, stores.run, spec.extract_method, spec.lander_from
    )


def full_extract(source: DataFrame, spec: ObjectSpec, stores: Stores) -> Outcome:
    """Stamp and keep the whole slice; rows carry no hash."""
    run, store = stores.run, spec.store_type.lower()
    renamed = rename_reserved(source)
    if store == STORE_APPEND:
        table = stores.appended(target_name_of(spec.target_table, spec.source_system))
        rows = _for_lakehouse(with_ingest_ts(renamed, run.run_ts))
        # One slice per run hour: repeating the hour replaces its rows.
        table.append(rows, run.hour, slice_key=f"{FULL_LOAD}@{run.hour}")
        return Outcome(spec.source_table, spec.target_table, FULL_EXTRACT, table.path)
    if store == STORE_REPLACE:
        table = stores.lakehouse(spec.target_table)
        rows = with_ingest_ts(renamed, run.run_ts, truncate=False)
        table.replace(lowercase_columns(rows), run.hour)
        table.retire()
        return Outcome(spec.source_table, spec.target_table, FULL_EXTRACT, table.path)
    folder = write_load(with_ingest_ts(renamed, run.run_ts), run, spec.target_table, FULL_LOAD)
    stores.log.record(run, spec.target_table, folder)
    landed = _land_if_configured(spec, stores)
    if run.keep_hours is not None:
        # A later full copy replaces an earlier one; those beyond the kept hours go.
        gone = expire_loads(stores.spark, run, spec.target_table, FULL_LOAD, run.keep_hours)
        stores.log.forget(run, spec.target_table, gone)
    return Outcome(
        spec.source_table, spec.target_table, FULL_EXTRACT, folder, landed_files=landed
    )


def full_extract_incr(
    source: DataFrame,
    spec: ObjectSpec,
    stores: Stores,
    limits: DiffLimits | None = None,
) -> Outcome:
    """Keep a full snapshot and, of it, the rows the last one lacked.

    The source is read once, into an unpublished snapshot with an index of its hashes; the
    comparison then works on the stored indexes. Only when snapshot and increment are both
    complete is the snapshot published, so a failed run leaves the previous one current.
    A snapshot hashed by another rule cannot be compared: then all rows count as
    new, as on a first load. ``limits`` compares the snapshots' rows instead, without an
    index of the earlier one.
    """
    run = stores.run
    table = VersionedTable(stores.spark, run.root, spec.target_table)
    hashed, seen = with_ingest_ts(with_row_hash(rename_reserved(source)), run.run_ts), Observation()
    counted = hashed.observe(seen, F.count(F.lit(1)).alias("rows"))
    snapshot_id, schema = table.write(counted, run.files, run.max_records_per_file)
    current = stores.spark.read.schema(schema).parquet(table.snapshot_path(snapshot_id))
    indexes = HashIndexes(stores.spark, f"{table.path}/hash_index")
    indexes.write(current, snapshot_id, seen.get["rows"])

    base = table.before(run.hour)
    fresh = _fresh_rows(table, indexes, snapshot_id, current, base, limits)
    if base is not None:
        # Few rows out of a long scan: gather them, or each scan task leaves a crumb.
        fresh = fresh.hint("rebalance")
    folder = write_load(fresh, run, spec.target_table, INCR_LOAD)

    # Logged before it is published: a crash in between repeats the comparison,
    # while the other order would leave rows that no later run finds new.
    stores.log.record(run, spec.target_table, folder)
    table.publish(snapshot_id, schema, REPLACE, run.hour, parent=table.current())
    table.retire()
    # One more hour than of snapshots: what a repeat of the oldest kept hour compares with.
    indexes.retire(table.of_latest_hours(BACKUP_HOURS + 1))
    landed = _land_if_configured(spec, stores)
    return Outcome(
        spec.source_table, spec.target_table, FULL_EXTRACT_INCR, folder, landed_files=landed
    )


def _fresh_rows(
    table: VersionedTable,
    indexes: HashIndexes,
    snapshot_id: int,
    current: DataFrame,
    base: Row | None,
    limits: DiffLimits | None,
) -> DataFrame:
    """The rows of a written snapshot that its base lacks, copies included, hash first."""
    rows = current.select(HASH, *[ref(c) for c in current.columns if c != HASH])
    stored = base is not None and path_exists(table.spark, table.snapshot_path(base.snapshot_id))
    if base is None or base.hash_version != HASH_VERSION:
        return rows
    if stored and (limits is not None or not indexes.has(base.snapshot_id)):
        return new_rows(current, table.read(base.snapshot_id), limits or DiffLimits())
    if not indexes.has(base.snapshot_id):
        return rows
    fresh = stage(indexes.new_hashes(snapshot_id, base.snapshot_id), "new-hashes")
    # The planner knows the size of the stored hashes: few of them are sent to the rows.
    return rows.join(fresh, HASH, "left_semi")


def key_incr_extract(
    source: DataFrame, spec: ObjectSpec, stores: Stores, advance: Advance
) -> Outcome:
    """Append the slice beyond the checkpoint, then move the checkpoint.

    The new checkpoint and the row count are observed by the write itself. ``advance``
    moves it: stored moves, which know the try that made them, or a function. If the
    checkpoint cannot be moved, an append to a lakehouse table is taken back. Tries that
    were never finished are replaced by this one; what a finished one wrote stays, even
    if the checkpoint is set back or does not move. A slice with rows but no value for a
    new checkpoint stays open, and the next run replaces it.
    """
    run = stores.run
    lake = spec.store_type.lower() == STORE_REPLACE
    rows = with_ingest_ts(rename_reserved(source), run.run_ts, truncate=not lake)
    if not lake:
        # Lakehouse rows carry no hash, so none is computed for them.
        rows = with_row_hash(rows)
    bucketed = spec.source_system.upper() == CASSANDRA
    watched, seen = observe_checkpoint(rows, spec.checkpoints, bucketed=bucketed)
    tries, try_id = Tries(stores.spark, run.root, spec), new_try()
    table = stores.appended(spec.target_table) if lake else None

    def take_back(earlier: str, written_to: str) -> None:
        if lake:
            table.undo(earlier)
        elif path_exists(stores.spark, written_to):
            write_parquet(rows.limit(0), written_to)
            stores.log.record(run, spec.target_table, written_to)
        tries.close(earlier)

    stored = isinstance(advance, CheckpointMoves)
    left = tries.settle(advance.made_by(spec) if stored else None)
    tries.close(*left.closed)
    for earlier, written_to in left.replaced:
        take_back(earlier, written_to)

    where = table.path if lake else load_path(run, spec.target_table, KEY_INCR_LOAD, try_id)
    tries.start(where, try_id)
    if lake:
        table.append(_for_lakehouse(watched), run.hour, slice_key=try_id)
    else:
        write_load(watched, run, spec.target_table, KEY_INCR_LOAD, try_id)
        stores.log.record(run, spec.target_table, where)

    checkpoint, rows_seen = observed_value(seen, spec.checkpoints)
    if rows_seen and checkpoint is not None:
        try:
            if stored:
                advance.advance(spec, checkpoint, try_id)
            else:
                tries.seal(try_id, where, checkpoint)
                advance(spec, checkpoint)
        except Exception:
            # A move that was stored although it failed is a move.
            if lake and not (stored and try_id in advance.made_by(spec)):
                take_back(try_id, where)
            raise
    if not rows_seen or checkpoint is not None:
        tries.close(try_id)
    return Outcome(spec.source_table, spec.target_table, KEY_INCR_EXTRACT, where, checkpoint)


def ingest_object(
    spec: ObjectSpec, loaders: Mapping[str, Loader], stores: Stores, advance: Advance
) -> Outcome:
    source = read_source(stores.spark, spec, loaders, stores.run)
    if spec.extract_method == FULL_EXTRACT:
        return full_extract(source, spec, stores)
    if spec.extract_method == FULL_EXTRACT_INCR:
        return full_extract_incr(source, spec, stores)
    return key_incr_extract(source, spec, stores, advance)


def ingest(
    config: DataFrame,
    namespace: str,
    proc_group: str,
    loaders: Mapping[str, Loader],
    stores: Stores,
    save_config: Callable[[DataFrame], None] | None = None,
) -> list[Outcome]:
    """Run every active object of a namespace and group; the first failure stops it.

    ``save_config`` gets the configuration with the moved checkpoints, also after a
    failure, so that whoever reads it sees how far each object has come.
    """
    active = active_objects(config, namespace, proc_group, (BRONZE, LANDER))
    moves = CheckpointMoves(stores.spark, stores.run.root)
    specs = object_specs(active, current_moves(moves.read()))
    try:
        return [ingest_object(s, loaders, stores, moves) for s in specs]
    finally:
        if save_config is not None:
            made = moves.read()
            save_config(carried_config(config, made))
            _end_moves(specs, moves, made)


def _end_moves(specs: list[ObjectSpec], moves: CheckpointMoves, made: DataFrame) -> None:
    """Note that the configuration holds what the moves of these objects led to."""
    last = {tuple(r[c] for c in OBJECT): r for r in current_moves(made).collect()}
    for spec in specs:
        row = last.get((spec.namespace, spec.source_table, spec.proc_group, spec.target_table))
        if row is not None and row.configured == spec.configured_checkpoint != row.checkpoint:
            moves.saved(spec, row.checkpoint)
