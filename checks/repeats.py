"""Flows that are repeated, reset or left unfinished: no committed row is lost or doubled."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from checks.derived import COLUMNS, RUN_HOUR_SQL, RUN_TS, json_sql, table
from tidemark.functions.predicates import bucketed_checkpoint_predicate, checkpoint_predicate
from tidemark.model import (
    FULL_EXTRACT,
    FULL_EXTRACT_INCR,
    FULL_LOAD,
    KEY_INCR_EXTRACT,
    KEY_INCR_LOAD,
    PIPELINE_CONFIG,
    POSTGRESQL,
    ObjectSpec,
    Run,
)
from tidemark.operators import checkpoint as cp
from tidemark.operators.checkpoint import specs_of
from tidemark.operators.filelog import file_inventory, to_log_rows
from tidemark.operators.transforms import with_row_hash
from tidemark.plans import flows
from tidemark.session import fresh_folder, stage
from tidemark.sources.files import read_documents, read_files
from tidemark.sources.readers import parquet_loader
from tidemark.tables.appends import AppendTable
from tidemark.tables.hours import read_load
from tidemark.tables.snapshots import VersionedTable


def _stores(spark, root=None, hours=0):
    run = Run(RUN_TS + timedelta(hours=hours), root or fresh_folder(spark, "flow"))
    return flows.Stores.parquet(spark, run)


def _spec(name, method, **more):
    return ObjectSpec("shop", name, name, POSTGRESQL, method, **more)


def _rows_by_hour(spark, stores, name, kind, columns, hours):
    found = None
    for h in hours:
        run = Run(RUN_TS + timedelta(hours=h), stores.run.root)
        rows = read_load(spark, run, name, kind).select(F.lit(h).alias("hour"), *columns)
        found = rows if found is None else found.unionAll(rows)
    return found


def _extract(rows, stores, definition, value, moved):
    specs = specs_of(definition, value)
    one = _spec("orders", KEY_INCR_EXTRACT, checkpoints=specs)
    flows.key_incr_extract(rows.where(checkpoint_predicate(specs)), one, stores, lambda _, v: moved.append(v))


def key_incr_reset_keeps_history(spark, sf_dir):
    """The checkpoint is set back after the source purged old rows; both hours keep theirs."""
    orders, first, moved = table(spark, sf_dir, "orders"), _stores(spark), []
    _extract(orders, first, "o_orderkey::numeric::>", "0", moved)
    later = _stores(spark, first.run.root, 2)
    _extract(orders.where("o_orderkey > 60"), later, "o_orderkey::numeric::>", "0", moved)
    return _rows_by_hour(spark, first, "orders", KEY_INCR_LOAD, COLUMNS["orders"], (0, 2))


def key_incr_inclusive_repeat(spark, sf_dir):
    """An inclusive checkpoint that does not move is read twice; nothing committed goes."""
    orders, first, moved = table(spark, sf_dir, "orders"), _stores(spark), []
    top = str(orders.agg(F.max("o_orderkey")).first()[0])
    _extract(orders, first, "o_orderkey::numeric::>=", top, moved)
    later = _stores(spark, first.run.root, 1)
    _extract(orders, later, "o_orderkey::numeric::>=", top, moved)
    return _rows_by_hour(spark, first, "orders", KEY_INCR_LOAD, COLUMNS["orders"], (0, 1))


def land_full_extract_backlog(spark, sf_dir):
    """Full copies of three hours wait; the latest one alone is landed, and none waits on."""
    root = None
    for h in range(3):
        stores = _stores(spark, root, h)
        root = stores.run.root
        mode = {"flatten_mode": "SNOWFLAKE", "lander_target": "raw"} if h == 2 else {}
        rows = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 <= h)
        flows.full_extract(rows, _spec("customer", FULL_EXTRACT, **mode), stores)
    assert stores.log.pending(stores.run, "customer").isEmpty()
    return stores.raw("raw").read()


def land_incr_from_value(spark, sf_dir):
    """Landing is switched on late: increments up to the configured time are passed over."""
    customers, first = table(spark, sf_dir, "customer"), _stores(spark)
    flows.full_extract_incr(customers.where("c_custkey % 2 = 0"), _spec("customer", FULL_EXTRACT_INCR), first)
    since = first.log.read("customer").agg(F.max("FILE_MODIFIED_DTIMEUTC").cast("string")).first()[0]
    later = _stores(spark, first.run.root, 1)
    one = _spec(
        "customer", FULL_EXTRACT_INCR, flatten_mode="SNOWFLAKE", lander_target="raw", lander_from=since
    )
    flows.full_extract_incr(customers, one, later)
    return later.raw("raw").read()


def _config(spark, *rows):
    full = [
        {
            "SOURCE_NAMESPACE": "shop", "LAYER_TYPE": "BRONZE", "SOURCE_SYSTEM": POSTGRESQL,
            "TARGET_STORE_TYPE": "parquet", "PROC_GROUP": "A", "IS_ACTIVE": True, **r,
        }
        for r in rows
    ]
    return spark.createDataFrame([tuple(r.get(c) for c in PIPELINE_CONFIG.names) for r in full], PIPELINE_CONFIG)


def _checkpoint_row(target, group="A", value="1000", name="orders"):
    return {
        "SOURCE_TABLE_NAME": name, "TARGET_TABLE_NAME": target, "PROC_GROUP": group,
        "EXTRACT_METHOD": KEY_INCR_EXTRACT, "CHECKPOINT_FIELD_DEF": "o_orderkey::numeric::>",
        "CHECKPOINT_TO_VALUE": value,
    }


def _ingested(spark, sf_dir, config, groups, save=None):
    stores = _stores(spark)
    for group in groups:
        flows.ingest(config, "shop", group, {POSTGRESQL: parquet_loader(sf_dir)}, stores, save)
    return stores


def two_groups_one_source(spark, sf_dir):
    """Two groups read one source from the same configured value; each gets all rows."""
    config = _config(spark, _checkpoint_row("of_a"), _checkpoint_row("of_b", "B"))
    stores = _ingested(spark, sf_dir, config, ("A", "B"))
    parts = [
        read_load(spark, stores.run, t, KEY_INCR_LOAD).select(F.lit(t).alias("target"), *COLUMNS["orders"])
        for t in ("of_a", "of_b")
    ]
    return parts[0].unionAll(parts[1])


def several_targets(spark, sf_dir):
    """One source with two targets in one group: both are filled."""
    config = _config(
        spark,
        *[
            {"SOURCE_TABLE_NAME": "customer", "TARGET_TABLE_NAME": t, "EXTRACT_METHOD": FULL_EXTRACT}
            for t in ("one", "two")
        ],
    )
    stores = _ingested(spark, sf_dir, config, ("A",))
    parts = [
        read_load(spark, stores.run, t, FULL_LOAD).select(F.lit(t).alias("target"), *COLUMNS["customer"])
        for t in ("one", "two")
    ]
    return parts[0].unionAll(parts[1])


def config_after_ingest(spark, sf_dir):
    """The configuration holds the moved checkpoint of the object that ran."""
    config, saved = _config(spark, _checkpoint_row("ran"), _checkpoint_row("other", "B")), []
    _ingested(spark, sf_dir, config, ("A",), lambda c: saved.append(stage(c, "config")))
    return saved[0].select("TARGET_TABLE_NAME", "CHECKPOINT_TO_VALUE")


def checkpoint_with_separator(spark, sf_dir):
    """A text maximum that holds the separator is read back as one value."""
    rows = table(spark, sf_dir, "part").select(
        F.concat(F.col("p_brand"), F.lit("|\\|"), F.col("p_type")).alias("label"), "p_partkey"
    )
    text = cp.next_checkpoint(rows, ["label", "p_partkey"]).first()["checkpoint"]
    specs = specs_of("label::string::>=|p_partkey::numeric::>=", text)
    config = _config(
        spark,
        {
            "SOURCE_TABLE_NAME": "part", "TARGET_TABLE_NAME": "part", "EXTRACT_METHOD": KEY_INCR_EXTRACT,
            "CHECKPOINT_FIELD_DEF": "label::string::>=|p_partkey::numeric::>=", "CHECKPOINT_TO_VALUE": text,
        },
    )
    parsed = cp.parse_checkpoints(config).select("field", F.col("value").alias("parsed"))
    read = spark.createDataFrame([(s.field, s.value) for s in specs], "field string, value string")
    return parsed.join(read, "field")


def advance_numeric(spark, sf_dir):
    """Several moves of one object: the last by position counts, not the greatest text."""
    moves = table(spark, sf_dir, "orders").select(
        F.lit("shop").alias("SOURCE_NAMESPACE"), F.lit("orders").alias("SOURCE_TABLE_NAME"),
        F.col("o_orderkey").cast("string").alias("checkpoint"), F.col("o_orderkey").alias("position"),
    )
    moved = cp.advance_checkpoints(_config(spark, _checkpoint_row("ran")), moves)
    return moved.select("TARGET_TABLE_NAME", "CHECKPOINT_TO_VALUE")


def append_earlier_hour_repeat(spark, sf_dir):
    """Hours ten, eleven, then ten again: every hour holds its rows once."""
    rows, first = table(spark, sf_dir, "supplier"), _stores(spark)
    spec = _spec("supplier", FULL_EXTRACT, store_type="Glue_Iceberg_Parquet_File")
    flows.full_extract(rows, spec, first)
    flows.full_extract(rows, spec, _stores(spark, first.run.root, 1))
    flows.full_extract(rows, spec, first)
    return first.appended("pg_supplier").read()


def undo_first_append(spark, sf_dir):
    """The first slice is taken back, the second stays."""
    rows = table(spark, sf_dir, "supplier")
    target = AppendTable(spark, fresh_folder(spark, "appends"), "supplier")
    target.append(rows, slice_key="first")
    target.append(rows.where("s_suppkey % 2 = 0"), slice_key="second")
    target.undo("first")
    return target.read()


def checkpoint_read_bucketed_four(spark, sf_dir):
    """A fourth checkpoint field of a bucketed source is compared like the third."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "*", "year(o_orderdate) AS year", "month(o_orderdate) AS month", "o_orderdate - INTERVAL 30 DAYS AS seen"
    )
    specs = specs_of(
        "year::numeric::>=|month::numeric::>=|o_orderdate::timestamp::>|seen::timestamp::>", "1996-12-15 00:00:00"
    )
    return rows.where(bucketed_checkpoint_predicate(specs)).drop("year", "month", "seen")


def file_log_success_table(spark, sf_dir):
    """A table whose name holds the marker's text is logged; its marker file is not."""
    run, found = Run(RUN_TS, fresh_folder(spark, "log")), None
    orders = table(spark, sf_dir, "orders")
    for status in ("F", "O", "P"):
        name = f"{status}_SUCCESS"
        folder = f"{run.root}/{name}/full_load/2024/05/01/10"
        orders.where(F.col("o_orderstatus") == status).write.parquet(folder)
        logged = to_log_rows(file_inventory(spark, folder), name, run.bucket, run.run_ts)
        files = [f"{run.root}/{r.FILE_WITH_PATH}" for r in logged.select("FILE_WITH_PATH").collect()]
        rows = read_files(spark, files, orders.schema).select(F.lit(name).alias("table_name"), "*")
        found = rows if found is None else found.unionAll(rows)
    return found


def documents_rare_field(spark, sf_dir):
    """A field that one document alone has is in the schema by default."""
    folder = fresh_folder(spark, "documents")
    table(spark, sf_dir, "customer").select(
        "*", F.when(F.col("c_custkey") == 7, F.lit("rare")).alias("note")
    ).write.json(folder)
    return read_documents(spark, folder).select(*COLUMNS["customer"], "note")


def retained_snapshots(spark, sf_dir):
    """After five hourly runs the folders of the three latest are left."""
    root, rows = None, table(spark, sf_dir, "supplier")
    for h in range(5):
        stores = _stores(spark, root, h)
        root = stores.run.root
        flows.full_extract_incr(rows.where(F.col("s_suppkey") % 5 <= h), _spec("supplier", FULL_EXTRACT_INCR), stores)
    data = VersionedTable(spark, root, "supplier").data_path
    files = spark.read.option("recursiveFileLookup", "true").parquet(data)
    taken = F.regexp_extract(F.col("_metadata.file_path"), "snapshot_id=([0-9]+)", 1).cast("long")
    return files.select(taken.alias("snapshot_id"), "s_suppkey", "s_name", "s_nationkey", "s_acctbal")


def row_hash_map(spark, sf_dir):
    """Equal maps stored in different orders hash alike."""
    part = table(spark, sf_dir, "part")
    one = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"))
    two = F.create_map(F.lit("type"), F.col("p_type"), F.lit("brand"), F.col("p_brand"))
    left = with_row_hash(part.select("p_partkey", one.alias("tags"))).select("p_partkey", "hash")
    right = with_row_hash(part.select("p_partkey", two.alias("tags"))).select("p_partkey", F.col("hash").alias("again"))
    return left.join(right, "p_partkey")


_ROW_MAP = (
    "md5('{\"p_partkey\":' || p_partkey || ',\"tags\":{\"brand\":\"' || p_brand || "
    "'\",\"type\":\"' || p_type || '\"}}')"
)
_LANDED = json_sql([*COLUMNS["customer"], "INGEST_EFF_DTIMEUTC"])


def _landed_sql(hours, where="true"):
    return (
        f'SELECT {_LANDED} AS "SRC" FROM (SELECT *, {RUN_HOUR_SQL} + INTERVAL {hours} HOUR '
        f'AS "INGEST_EFF_DTIMEUTC" FROM customer WHERE {where})'
    )


def checks():
    columns = ", ".join(COLUMNS["orders"])
    label = "max(p_brand || '|\\|' || p_type)"
    return {
        "key_incr_reset_keeps_history": (
            key_incr_reset_keeps_history,
            f"SELECT 0 AS hour, {columns} FROM orders WHERE o_orderkey > 0 "
            f"UNION ALL SELECT 2, {columns} FROM orders WHERE o_orderkey > 60",
        ),
        "key_incr_inclusive_repeat": (
            key_incr_inclusive_repeat,
            f"SELECT hour, {columns} FROM orders, (VALUES (0), (1)) h(hour) "
            "WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)",
        ),
        "land_full_extract_backlog": (land_full_extract_backlog, _landed_sql(2)),
        "land_incr_from_value": (land_incr_from_value, _landed_sql(1, "c_custkey % 2 = 1")),
        "two_groups_one_source": (
            two_groups_one_source,
            f"SELECT target, {columns} FROM orders, (VALUES ('of_a'), ('of_b')) t(target) WHERE o_orderkey > 1000",
        ),
        "several_targets": (
            several_targets,
            "SELECT target, customer.* FROM customer, (VALUES ('one'), ('two')) t(target)",
        ),
        "config_after_ingest": (
            config_after_ingest,
            'SELECT \'ran\' AS "TARGET_TABLE_NAME", max(o_orderkey)::VARCHAR AS "CHECKPOINT_TO_VALUE" '
            "FROM orders UNION ALL SELECT 'other', '1000'",
        ),
        "checkpoint_with_separator": (
            checkpoint_with_separator,
            f"SELECT 'label' AS field, {label} AS parsed, {label} AS value FROM part "
            "UNION ALL SELECT 'p_partkey', max(p_partkey)::VARCHAR, max(p_partkey)::VARCHAR FROM part",
        ),
        "advance_numeric": (
            advance_numeric,
            'SELECT \'ran\' AS "TARGET_TABLE_NAME", max(o_orderkey)::VARCHAR AS "CHECKPOINT_TO_VALUE" FROM orders',
        ),
        "append_earlier_hour_repeat": (
            append_earlier_hour_repeat,
            f"SELECT *, {RUN_HOUR_SQL} AS ingest_eff_dtimeutc FROM supplier "
            f"UNION ALL SELECT *, {RUN_HOUR_SQL} + INTERVAL 1 HOUR FROM supplier",
        ),
        "undo_first_append": (undo_first_append, "SELECT * FROM supplier WHERE s_suppkey % 2 = 0"),
        "checkpoint_read_bucketed_four": (
            checkpoint_read_bucketed_four,
            "SELECT * FROM orders WHERE o_orderdate - INTERVAL 30 DAY > TIMESTAMP '1996-12-15'",
        ),
        "file_log_success_table": (
            file_log_success_table,
            "SELECT o_orderstatus || '_SUCCESS' AS table_name, orders.* FROM orders",
        ),
        "documents_rare_field": (
            documents_rare_field,
            "SELECT *, CASE WHEN c_custkey = 7 THEN 'rare' END AS note FROM customer",
        ),
        "retained_snapshots": (
            retained_snapshots,
            "SELECT h + 1 AS snapshot_id, supplier.* FROM supplier, (VALUES (2), (3), (4)) t(h) "
            "WHERE s_suppkey % 5 <= h",
        ),
        "row_hash_map": (row_hash_map, f"SELECT p_partkey, {_ROW_MAP} AS hash, {_ROW_MAP} AS again FROM part"),
    }
