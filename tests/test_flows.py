from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.functions.predicates import checkpoint_predicate
from tidemark.model import (
    FULL_EXTRACT,
    FULL_EXTRACT_INCR,
    INCR_LOAD,
    KEY_INCR_EXTRACT,
    KEY_INCR_LOAD,
    PIPELINE_CONFIG,
    ObjectSpec,
    Run,
)
from tidemark.operators.changes import DiffLimits
from tidemark.operators.checkpoint import specs_of
from tidemark.plans import flows
from tidemark.plans.flows import Stores
from tidemark.sources.readers import parquet_loader
from tidemark.tables.checkpoints import CheckpointMoves, latest_moves
from tidemark.tables.hours import read_load
from tidemark.tables.snapshots import VersionedTable


def spec(method, name="customer", **more):
    return ObjectSpec("shop", name, name, "POSTGRESQL", method, **more)


@pytest.fixture
def stores(spark, run):
    return Stores.parquet(spark, run)


def later(spark, run, hours):
    return Stores.parquet(spark, Run(run.run_ts + timedelta(hours=hours), run.root))


@pytest.mark.parametrize(
    "limits", [DiffLimits(), DiffLimits(broadcast=0), DiffLimits(broadcast=0, shuffle=0)]
)
def test_unchanged_source_gives_an_empty_increment(spark, run, stores, customers, limits):
    flows.full_extract_incr(customers, spec(FULL_EXTRACT_INCR), stores, limits)
    second = later(spark, run, 1)
    flows.full_extract_incr(customers, spec(FULL_EXTRACT_INCR), second, limits)
    assert read_load(spark, second.run, "customer", INCR_LOAD).isEmpty()


def test_rerun_of_an_hour_keeps_its_increment(spark, run, stores, customers):
    """The second run of an hour compares with the state before the hour."""
    flows.full_extract_incr(customers.where("c_custkey < 50"), spec(FULL_EXTRACT_INCR), stores)
    second = later(spark, run, 1)
    for top in (80, 100):
        part = customers.where(F.col("c_custkey") < top)
        flows.full_extract_incr(part, spec(FULL_EXTRACT_INCR), second)
    found = read_load(spark, second.run, "customer", INCR_LOAD)
    assert rows_of(found.select("c_custkey")) == rows_of(
        customers.where("c_custkey >= 50 AND c_custkey < 100").select("c_custkey")
    )


def test_snapshot_is_published_last(spark, run, stores, customers, monkeypatch):
    flows.full_extract_incr(customers.limit(10), spec(FULL_EXTRACT_INCR), stores)

    def broken(*_, **__):
        raise RuntimeError("store is full")

    second = later(spark, run, 1)
    with monkeypatch.context() as patch:
        patch.setattr(flows, "write_load", broken)
        with pytest.raises(RuntimeError):
            flows.full_extract_incr(customers, spec(FULL_EXTRACT_INCR), second)
    table = VersionedTable(spark, run.root, "customer")
    assert table.read().count() == 10
    flows.full_extract_incr(customers, spec(FULL_EXTRACT_INCR), later(spark, run, 1))
    assert table.refresh().read().count() == customers.count()


def test_other_hash_rule_forces_a_first_load(spark, run, stores, customers, monkeypatch):
    flows.full_extract_incr(customers, spec(FULL_EXTRACT_INCR), stores)
    monkeypatch.setattr(flows, "HASH_VERSION", 99)
    second = later(spark, run, 1)
    flows.full_extract_incr(customers, spec(FULL_EXTRACT_INCR), second)
    assert read_load(spark, second.run, "customer", INCR_LOAD).count() == customers.count()


def test_source_column_called_hash(spark, run, stores, customers):
    rows = customers.withColumnRenamed("c_name", "Hash")
    flows.full_extract_incr(rows, spec(FULL_EXTRACT_INCR), stores)
    found = read_load(spark, run, "customer", INCR_LOAD)
    assert {"hash", "src_hash"} <= set(found.columns)


DEFINITION = "o_orderkey::numeric::>"


def orders_slice(spark, sf, value):
    specs = specs_of(DEFINITION, value)
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return orders.where(checkpoint_predicate(specs)), specs


@pytest.mark.parametrize("store", ["parquet", "glue_iceberg_raw_table"])
def test_checkpoint_failure_leaves_table_and_checkpoint(spark, sf, run, stores, store):
    rows, specs = orders_slice(spark, sf, "500")
    moved = []

    def broken(*_):
        raise RuntimeError("configuration store is down")

    def working(_, value):
        moved.append(value)

    one = spec(KEY_INCR_EXTRACT, "orders", store_type=store, checkpoints=specs)
    with pytest.raises(RuntimeError):
        flows.key_incr_extract(rows, one, stores, broken)
    assert moved == []
    if store == "glue_iceberg_raw_table":
        assert stores.appended("orders").read().isEmpty()
    flows.key_incr_extract(rows, one, stores, working)
    if store == "glue_iceberg_raw_table":
        found = stores.appended("orders").read()
    else:
        found = read_load(spark, run, "orders", KEY_INCR_LOAD)
    assert found.count() == rows.count()
    assert moved == [str(spark.read.parquet(f"{sf}/orders.parquet").agg(F.max("o_orderkey")).first()[0])]


def test_slice_repeated_in_a_later_hour_is_not_doubled(spark, sf, run, stores):
    """The checkpoint could not be moved at ten; at eleven the slice is read again."""
    rows, specs = orders_slice(spark, sf, "500")
    one = spec(KEY_INCR_EXTRACT, "orders", checkpoints=specs)

    def broken(*_):
        raise RuntimeError("configuration store is down")

    with pytest.raises(RuntimeError):
        flows.key_incr_extract(rows, one, stores, broken)
    second = later(spark, run, 1)
    flows.key_incr_extract(rows, one, second, lambda *_: None)
    assert read_load(spark, run, "orders", KEY_INCR_LOAD).isEmpty()
    assert read_load(spark, second.run, "orders", KEY_INCR_LOAD).count() == rows.count()
    logged = [r.file_path for r in second.log.pending(run, "orders").collect()]
    assert spark.read.parquet(*logged).count() == rows.count()


def test_crash_before_publishing_loses_no_increment(spark, run, stores, customers, monkeypatch):
    flows.full_extract_incr(customers.limit(10), spec(FULL_EXTRACT_INCR), stores)

    def broken(*_, **__):
        raise RuntimeError("driver lost")

    second = later(spark, run, 1)
    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "publish", broken)
        with pytest.raises(RuntimeError):
            flows.full_extract_incr(customers, spec(FULL_EXTRACT_INCR), second)
    third = later(spark, run, 2)
    flows.full_extract_incr(customers, spec(FULL_EXTRACT_INCR), third)
    found = read_load(spark, third.run, "customer", INCR_LOAD)
    assert found.count() == customers.count() - 10


def test_empty_slice_moves_nothing(spark, sf, stores):
    rows, specs = orders_slice(spark, sf, "99999999")
    one = spec(KEY_INCR_EXTRACT, "orders", checkpoints=specs)
    outcome = flows.key_incr_extract(rows, one, stores, lambda *_: pytest.fail("moved"))
    assert outcome.checkpoint is None


def test_source_is_read_once_by_a_checkpoint_run(spark, sf, stores):
    """Rows are counted where they are read: maxima come from the write itself."""
    rows, specs = orders_slice(spark, sf, "0")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    counted = rows.mapInPandas(count, rows.schema)
    one = spec(KEY_INCR_EXTRACT, "orders", checkpoints=specs)
    flows.key_incr_extract(counted, one, stores, lambda *_: None)
    assert seen.value == rows.count()


def test_null_maximum_keeps_the_stored_value(spark, stores):
    rows = spark.createDataFrame([(1, None), (2, None)], "a int, b timestamp_ntz")
    specs = specs_of("a::numeric::>|b::timestamp::>", "0|2024-01-01 00:00:00")
    moved = []
    one = spec(KEY_INCR_EXTRACT, "t", checkpoints=specs)
    flows.key_incr_extract(rows, one, stores, lambda _, v: moved.append(v))
    assert moved == ["2|2024-01-01 00:00:00"]


def test_file_log_follows_rewritten_folders(spark, run, stores, customers):
    flows.full_extract(customers, spec(FULL_EXTRACT), stores)
    flows.full_extract(customers, spec(FULL_EXTRACT), stores)
    pending = Stores.parquet(spark, run).log.pending(run, "customer").collect()
    assert spark.read.parquet(*[r.file_path for r in pending]).count() == customers.count()


def test_logging_leaves_older_loads_alone(spark, run, stores, customers):
    """No stored log file is rewritten by a later hour, nor by marking files processed."""
    flows.full_extract(customers, spec(FULL_EXTRACT), stores)
    files = f"{stores.log.root}/files/customer"
    before = {r.path: r.modificationTime for r in _listed(spark, files)}
    second = later(spark, run, 1)
    flows.full_extract(customers, spec(FULL_EXTRACT), second)
    second.log.done("customer", second.log.pending(run, "customer"), run.run_ts)
    after = {r.path: r.modificationTime for r in _listed(spark, files)}
    assert before.items() < after.items()
    assert second.log.pending(run, "customer").isEmpty()


def _listed(spark, path):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "modificationTime").collect()


def test_full_extract_lands_and_marks(spark, run, stores, customers):
    one = spec(FULL_EXTRACT, flatten_mode="SNOWFLAKE", lander_target="raw_c")
    outcome = flows.full_extract(customers, one, stores)
    assert outcome.landed_files > 0
    assert stores.raw("raw_c").read().columns == ["SRC"]
    assert stores.raw("raw_c").read().count() == customers.count()
    assert stores.log.pending(run, "customer").isEmpty()


def config_rows(spark, *rows):
    full = [tuple(r.get(n) for n in PIPELINE_CONFIG.names) for r in rows]
    return spark.createDataFrame(full, PIPELINE_CONFIG)


def row(name, method, **more):
    return {
        "SOURCE_NAMESPACE": "shop",
        "SOURCE_TABLE_NAME": name,
        "TARGET_TABLE_NAME": f"t_{name}",
        "LAYER_TYPE": "BRONZE",
        "SOURCE_SYSTEM": "postgresql",
        "EXTRACT_METHOD": method,
        "TARGET_STORE_TYPE": "parquet",
        "PROC_GROUP": "A",
        "IS_ACTIVE": True,
        **more,
    }


def test_ingest_runs_active_objects_and_moves_checkpoints(spark, sf, run, stores):
    def config(value):
        return config_rows(
            spark,
            row("orders", KEY_INCR_EXTRACT, CHECKPOINT_FIELD_DEF=DEFINITION, CHECKPOINT_TO_VALUE=value),
            row("region", FULL_EXTRACT),
            row("nation", FULL_EXTRACT, IS_ACTIVE=False),
            row("part", FULL_EXTRACT, PROC_GROUP="B"),
            row("supplier", FULL_EXTRACT, SOURCE_NAMESPACE="elsewhere"),
        )

    loaders = {"POSTGRESQL": parquet_loader(sf)}
    done = flows.ingest(config("100"), "shop", "A", loaders, stores)
    assert [o.source_table for o in done] == ["orders", "region"]
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    moves = CheckpointMoves(spark, run.root)
    assert [r.checkpoint for r in moves.read().collect()] == [str(top)]
    # The same run again finds nothing new and moves nothing.
    second = later(spark, run, 1)
    flows.ingest(config("100"), "shop", "A", loaders, second)
    assert moves.read().count() == 1
    assert read_load(spark, second.run, "t_orders", KEY_INCR_LOAD).isEmpty()
    # An edited configuration restarts the object from the edited value.
    third = later(spark, run, 2)
    flows.ingest(config("200"), "shop", "A", loaders, third)
    found = read_load(spark, third.run, "t_orders", KEY_INCR_LOAD)
    assert found.count() == orders.where("o_orderkey > 200").count()
    assert {r.configured: r.checkpoint for r in latest_moves(moves.read()).collect()} == {
        "100": str(top),
        "200": str(top),
    }


def test_moves_are_followed_in_order(spark, run):
    moves = CheckpointMoves(spark, run.root)
    one = spec(KEY_INCR_EXTRACT, "orders", configured_checkpoint="1")
    for value in ("9", "10", "11"):
        moves.advance(one, value)
    assert [r.checkpoint for r in latest_moves(moves.read()).collect()] == ["11"]


def test_tables_are_logged_independently(spark, run, customers):
    """Two runs at once, each with its own view of the log, lose nothing."""
    one, two = Stores.parquet(spark, run), Stores.parquet(spark, run)
    flows.full_extract(customers.limit(5), spec(FULL_EXTRACT, "a"), one)
    flows.full_extract(customers.limit(5), spec(FULL_EXTRACT, "b"), two)
    flows.full_extract(customers.limit(5), spec(FULL_EXTRACT, "c"), one)
    assert {r.TABLE_NAME for r in one.log.read("a", "c").collect()} == {"a", "c"}
    assert {r.TABLE_NAME for r in two.log.read().collect()} == {"a", "b", "c"}


def test_ingest_stops_at_the_first_failure(spark, sf, run, stores):
    config = config_rows(spark, row("a_missing", FULL_EXTRACT), row("region", FULL_EXTRACT))
    with pytest.raises(Exception, match="a_missing"):
        flows.ingest(config, "shop", "A", {"POSTGRESQL": parquet_loader(sf)}, stores)
    assert stores.log.read().isEmpty()


def test_stamps_use_the_injected_time(spark, run, stores, customers):
    flows.full_extract_incr(customers, spec(FULL_EXTRACT_INCR), stores)
    stamps = read_load(spark, run, "customer", INCR_LOAD).select("INGEST_EFF_DTIMEUTC").distinct()
    assert [r[0] for r in stamps.collect()] == [datetime(2024, 5, 1, 10)]
