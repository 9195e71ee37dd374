"""Whole flows: what lands where after one or more runs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from checks.changes import HUGE
from checks.derived import (
    COLUMNS,
    PERTURBED_CUSTOMERS_SQL,
    RUN_HOUR_SQL,
    RUN_TS,
    RUN_TS_SQL,
    hash_sql,
    json_sql,
    perturbed_customers,
    table,
)
from tidemark.functions.predicates import checkpoint_predicate
from tidemark.functions.rows import ntz, row_json
from tidemark.model import (
    CASSANDRA,
    FULL_EXTRACT,
    FULL_EXTRACT_INCR,
    FULL_LOAD,
    INCR_LOAD,
    KEY_INCR_EXTRACT,
    KEY_INCR_LOAD,
    MONGODB,
    MYSQL,
    PIPELINE_CONFIG,
    POSTGRESQL,
    ObjectSpec,
    Run,
)
from tidemark.operators.changes import DiffLimits
from tidemark.operators.checkpoint import specs_of
from tidemark.plans import flows
from tidemark.plans.lander import land_pending
from tidemark.session import fresh_folder
from tidemark.sources.readers import json_loader, parquet_loader, read_source
from tidemark.streaming.lander import land_stream, read_landed
from tidemark.tables.checkpoints import CheckpointMoves, latest_moves
from tidemark.tables.hours import read_load
from tidemark.tables.snapshots import VersionedTable


def _stores(spark, root=None, hours=0):
    run = Run(RUN_TS + timedelta(hours=hours), root or fresh_folder(spark, "flow"))
    return flows.Stores.parquet(spark, run)


def _spec(name, method, **more):
    return ObjectSpec("shop", name, name, POSTGRESQL, method, **more)


def full_extract(spark, sf_dir):
    stores = _stores(spark)
    flows.full_extract(table(spark, sf_dir, "orders"), _spec("orders", FULL_EXTRACT), stores)
    return read_load(spark, stores.run, "orders", FULL_LOAD)


def full_extract_append(spark, sf_dir):
    """Lakehouse append; the first hour is run twice, the second once."""
    rows = table(spark, sf_dir, "supplier").toDF("S_SUPPKEY", "S_NAME", "S_NATIONKEY", "S_ACCTBAL")
    spec = _spec("supplier", FULL_EXTRACT, store_type="Glue_Iceberg_Parquet_File")
    first = _stores(spark)
    flows.full_extract(rows, spec, first)
    flows.full_extract(rows, spec, first)
    flows.full_extract(rows, spec, _stores(spark, first.run.root, hours=1))
    return first.appended("pg_supplier").read()


def full_extract_replace(spark, sf_dir):
    spec = _spec("part", FULL_EXTRACT, store_type="glue_iceberg_raw_table")
    stores = _stores(spark)
    part = table(spark, sf_dir, "part")
    flows.full_extract(part.where("p_size > 40"), spec, stores)
    flows.full_extract(part, spec, stores)
    return stores.lakehouse("part").read()


def _two_loads(spark, sf_dir, limits=DiffLimits(), repeat=False):
    """An earlier copy of the customers, then the customers an hour later."""
    spec = _spec("customer", FULL_EXTRACT_INCR)
    first = _stores(spark)
    flows.full_extract_incr(perturbed_customers(spark, sf_dir), spec, first)
    second = _stores(spark, first.run.root, hours=1)
    for _ in range(2 if repeat else 1):
        flows.full_extract_incr(table(spark, sf_dir, "customer"), spec, second, limits)
    return second


def full_extract_incr(spark, sf_dir):
    stores = _two_loads(spark, sf_dir)
    return read_load(spark, stores.run, "customer", INCR_LOAD)


def full_extract_incr_shuffled(spark, sf_dir):
    """Increment of an hour run twice, by the path for large tables."""
    stores = _two_loads(spark, sf_dir, HUGE, repeat=True)
    return read_load(spark, stores.run, "customer", INCR_LOAD)


def full_extract_incr_snapshot(spark, sf_dir):
    stores = _two_loads(spark, sf_dir)
    return VersionedTable(spark, stores.run.root, "customer").read()


def full_extract_incr_first(spark, sf_dir):
    stores = _stores(spark)
    lineitem = table(spark, sf_dir, "lineitem")
    flows.full_extract_incr(lineitem, _spec("lineitem", FULL_EXTRACT_INCR), stores)
    return read_load(spark, stores.run, "lineitem", INCR_LOAD).drop("hash")


_STAMP_2 = f"{RUN_HOUR_SQL} + INTERVAL 1 HOUR"
INCR_SQL = f"""
WITH {PERTURBED_CUSTOMERS_SQL}
SELECT {hash_sql(COLUMNS["customer"])} AS hash, c.*, {_STAMP_2} AS "INGEST_EFF_DTIMEUTC"
FROM customer c WHERE NOT EXISTS (SELECT 1 FROM before b WHERE {
    " AND ".join(f"b.{c} IS NOT DISTINCT FROM c.{c}" for c in COLUMNS["customer"])})"""

_EVENTS = ("ts::timestamp::>", "2024-01-12 00:00:00")


def _key_runs(spark, sf_dir, store_type, runs):
    """Checkpoint extracts one after another; the source grows between them."""
    events = table(spark, sf_dir, "events")
    values, stores = [_EVENTS[1]], _stores(spark)
    for visible in runs:
        specs = specs_of(_EVENTS[0], values[-1])
        spec = _spec("events", KEY_INCR_EXTRACT, store_type=store_type, checkpoints=specs)
        rows = events.where(F.col("event_id") % 10 < visible).where(checkpoint_predicate(specs))
        flows.key_incr_extract(rows, spec, stores, lambda _, value: values.append(value))
    return stores, values


def key_incr_extract(spark, sf_dir):
    stores, _ = _key_runs(spark, sf_dir, "", [10, 10])
    return read_load(spark, stores.run, "events", KEY_INCR_LOAD)


def key_incr_extract_lakehouse(spark, sf_dir):
    stores, _ = _key_runs(spark, sf_dir, "glue_iceberg_raw_table", [10, 10])
    return stores.appended("events").read()


def key_incr_checkpoint(spark, sf_dir):
    stores, values = _key_runs(spark, sf_dir, "", [5, 10, 10])
    rows = read_load(spark, stores.run, "events", KEY_INCR_LOAD)
    return rows.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "checkpoint", F.lit(values[-1])
    ).withColumn("moves", F.lit(len(values) - 1))


KEY_CHECKPOINT_SQL = """
WITH first AS (SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-12' AND event_id % 10 < 5),
second AS (SELECT * FROM events WHERE ts > (SELECT max(ts) FROM first))
SELECT (SELECT count(*) FROM first) + (SELECT count(*) FROM second) AS row_count,
  (SELECT max(ts)::VARCHAR FROM events) AS checkpoint,
  CASE WHEN (SELECT count(*) FROM second) > 0 THEN 2 ELSE 1 END AS moves"""


def key_incr_bucketed(spark, sf_dir):
    """A source in year and month buckets, read three times as it grows.

    Each read starts where the one before ended; together they hold every row once.
    """
    path, stores = fresh_folder(spark, "buckets"), _stores(spark)
    table(spark, sf_dir, "orders").selectExpr(
        "*", "year(o_orderdate) AS year", "month(o_orderdate) AS month"
    ).write.partitionBy("year", "month").parquet(f"{path}/orders")
    stored = parquet_loader(path, "")
    definition = "year::numeric::>=|month::numeric::>=|o_orderdate::timestamp::>"
    values = ["1994-12-31 00:00:00"]
    for limit in ("1997-12-20", "1999-02-10", "2002-01-01"):
        spec = ObjectSpec(
            "ks",
            "orders",
            "orders",
            CASSANDRA,
            KEY_INCR_EXTRACT,
            checkpoints=specs_of(definition, values[-1]),
        )

        def grown(spark, spec, limit=limit):
            return stored(spark, spec).where(F.col("o_orderdate") < ntz(limit))

        rows = read_source(spark, spec, {CASSANDRA: grown}, stores.run)
        flows.key_incr_extract(rows, spec, stores, lambda _, value: values.append(value))
    return read_load(spark, stores.run, "orders", KEY_INCR_LOAD).select(
        *COLUMNS["orders"], F.lit(values[-1]).alias("checkpoint")
    )


def read_source_documents(spark, sf_dir):
    """A document collection: void fields made text, region tag taken from the target."""
    path = fresh_folder(spark, "collections")
    table(spark, sf_dir, "customer").select(
        "*", F.lit(None).cast("string").alias("gap")
    ).write.option("ignoreNullFields", "false").json(f"{path}/customer")
    spec = ObjectSpec("shop", "customer", "customer-EU", MONGODB, FULL_EXTRACT)
    return read_source(spark, spec, {MONGODB: json_loader(path)}, Run(RUN_TS, path))


def read_source_bucketed(spark, sf_dir):
    """A wide-column source stored by year and month; unneeded buckets are not read."""
    path = fresh_folder(spark, "buckets")
    table(spark, sf_dir, "orders").selectExpr(
        "*", "year(o_orderdate) AS year", "month(o_orderdate) AS month"
    ).write.partitionBy("year", "month").parquet(f"{path}/orders")
    specs = specs_of(
        "year::numeric::>=|month::numeric::>=|o_orderdate::timestamp::>", "1998-11-20 00:00:00"
    )
    spec = ObjectSpec("ks", "orders", "orders", CASSANDRA, KEY_INCR_EXTRACT, checkpoints=specs)
    return read_source(spark, spec, {CASSANDRA: parquet_loader(path, "")}, Run(RUN_TS, path))


def read_source_region(spark, sf_dir):
    """Partner tables, limited to the market regions served from one region."""
    path = fresh_folder(spark, "partners")
    table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "element_at(array('NA', 'EU', 'AU'), cast(c_nationkey % 3 + 1 as int)) "
        "AS preference_region"
    ).write.parquet(f"{path}/partners")
    table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "partner_id").write.parquet(
        f"{path}/partner_id_mappings"
    )
    spec = ObjectSpec("shop", "partner_id_mappings", "maps", MYSQL, FULL_EXTRACT)
    run = Run(RUN_TS, path, region="eu-west-1")
    return read_source(spark, spec, {MYSQL: parquet_loader(path, "")}, run)


def ingest(spark, sf_dir):
    """A configured run over three objects: all rows of each, and checkpoint moves."""

    def row(name, method, definition=None, value=None, layer="BRONZE", target=None, mode=None):
        found = dict(
            SOURCE_NAMESPACE="shop",
            SOURCE_TABLE_NAME=name,
            TARGET_TABLE_NAME=target or name,
            LAYER_TYPE=layer,
            SOURCE_SYSTEM=POSTGRESQL,
            EXTRACT_METHOD=method,
            TARGET_STORE_TYPE="parquet",
            PROC_GROUP="A",
            IS_ACTIVE=True,
            CHECKPOINT_FIELD_DEF=definition,
            CHECKPOINT_TO_VALUE=value,
            FLATTEN_MODE=mode,
        )
        return tuple(found.get(c) for c in PIPELINE_CONFIG.names)

    rows = [
        row("customer", FULL_EXTRACT_INCR),
        row("customer", None, layer="LANDER", target="raw_customer", mode="SNOWFLAKE"),
        row("lineitem", FULL_EXTRACT),
        row("orders", KEY_INCR_EXTRACT, "o_orderkey::numeric::>=", "1000"),
    ]
    config = spark.createDataFrame(rows, PIPELINE_CONFIG)
    stores = _stores(spark)
    flows.ingest(config, "shop", "A", {POSTGRESQL: parquet_loader(sf_dir)}, stores)
    parts = [
        read_load(spark, stores.run, name, kind).select(
            F.lit(name).alias("object"), row_json(COLUMNS[name]).alias("row")
        )
        for name, kind in (
            ("customer", INCR_LOAD),
            ("lineitem", FULL_LOAD),
            ("orders", KEY_INCR_LOAD),
        )
    ]
    landed = stores.raw("raw_customer").read()
    parts.append(landed.select(F.lit("landed").alias("object"), F.col("SRC").alias("row")))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionAll(more)
    moves = CheckpointMoves(spark, stores.run.root).read()
    moved = latest_moves(moves).select(F.col("SOURCE_TABLE_NAME").alias("object"), "checkpoint")
    return found.join(moved, "object", "left")


INGEST_SQL = f"""
SELECT 'customer' AS object, {json_sql(COLUMNS["customer"])} AS row, NULL::VARCHAR AS checkpoint FROM customer
UNION ALL SELECT 'landed', {json_sql([*COLUMNS["customer"], "INGEST_EFF_DTIMEUTC"])}, NULL
FROM (SELECT *, {RUN_HOUR_SQL} AS "INGEST_EFF_DTIMEUTC" FROM customer)
UNION ALL SELECT 'lineitem', {json_sql(COLUMNS["lineitem"])}, NULL FROM lineitem
UNION ALL SELECT 'orders', {json_sql(COLUMNS["orders"])}, (SELECT max(o_orderkey)::VARCHAR FROM orders) FROM orders
WHERE o_orderkey >= 1000"""


def _landed_twice(spark, sf_dir):
    """A first load is landed, then only the later increment is pending and landed."""
    stores = _stores(spark)
    spec = _spec("customer", FULL_EXTRACT_INCR)
    target = stores.raw("customer")
    flows.full_extract_incr(perturbed_customers(spark, sf_dir), spec, stores)
    land_pending(spark, stores.log, "customer", target, stores.run)
    later = _stores(spark, stores.run.root, hours=1)
    flows.full_extract_incr(table(spark, sf_dir, "customer"), spec, later)
    land_pending(spark, later.log, "customer", target, later.run)
    assert land_pending(spark, later.log, "customer", target, later.run) == 0
    return target.read()


LANDED_SQL = f"""
WITH {PERTURBED_CUSTOMERS_SQL},
stamped AS (SELECT *, {_STAMP_2} AS "INGEST_EFF_DTIMEUTC" FROM customer)
SELECT {json_sql([*COLUMNS["customer"], "INGEST_EFF_DTIMEUTC"])} AS "SRC"
FROM stamped c WHERE NOT EXISTS (SELECT 1 FROM before b WHERE {
    " AND ".join(f"b.{c} IS NOT DISTINCT FROM c.{c}" for c in COLUMNS["customer"])})"""


def landed_stream(spark, sf_dir):
    """Files arrive in two portions; the stream lands each once."""
    events = table(spark, sf_dir, "events")
    folder = fresh_folder(spark, "arriving")
    target, checkpoint = fresh_folder(spark, "landed"), fresh_folder(spark, "stream")

    def arrive_and_land(part):
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(folder)
        land_stream(spark, folder, events.schema, target, checkpoint, 2).awaitTermination()

    for part in (0, 1, 2):
        arrive_and_land(part)
    return read_landed(spark, target)


def checks():
    return {
        "full_extract": (
            full_extract,
            f'SELECT *, {RUN_HOUR_SQL} AS "INGEST_EFF_DTIMEUTC" FROM orders',
        ),
        "full_extract_append": (
            full_extract_append,
            f"SELECT *, {RUN_HOUR_SQL} AS ingest_eff_dtimeutc FROM supplier "
            f"UNION ALL SELECT *, {_STAMP_2} FROM supplier",
        ),
        "full_extract_replace": (
            full_extract_replace,
            f"SELECT *, {RUN_TS_SQL} AS ingest_eff_dtimeutc FROM part",
        ),
        "full_extract_incr": (full_extract_incr, INCR_SQL),
        "full_extract_incr_shuffled": (full_extract_incr_shuffled, INCR_SQL),
        "full_extract_incr_snapshot": (
            full_extract_incr_snapshot,
            f'SELECT *, {hash_sql(COLUMNS["customer"])} AS hash, '
            f'{_STAMP_2} AS "INGEST_EFF_DTIMEUTC" FROM customer',
        ),
        "full_extract_incr_first": (
            full_extract_incr_first,
            f'SELECT *, {RUN_HOUR_SQL} AS "INGEST_EFF_DTIMEUTC" FROM lineitem',
        ),
        "key_incr_extract": (
            key_incr_extract,
            f"WITH s AS (SELECT *, {RUN_HOUR_SQL} AS \"INGEST_EFF_DTIMEUTC\" FROM events "
            "WHERE ts > TIMESTAMP '2024-01-12') "
            f'SELECT *, {hash_sql([*COLUMNS["events"], "INGEST_EFF_DTIMEUTC"])} AS hash FROM s',
        ),
        "key_incr_extract_lakehouse": (
            key_incr_extract_lakehouse,
            f"SELECT *, {RUN_TS_SQL} AS ingest_eff_dtimeutc FROM events "
            "WHERE ts > TIMESTAMP '2024-01-12'",
        ),
        "key_incr_checkpoint": (key_incr_checkpoint, KEY_CHECKPOINT_SQL),
        "key_incr_bucketed": (
            key_incr_bucketed,
            "SELECT *, (SELECT max(o_orderdate)::VARCHAR FROM orders) "
            "AS checkpoint FROM orders",
        ),
        "read_source_documents": (
            read_source_documents,
            "SELECT *, NULL::VARCHAR AS gap, 'EU' AS \"ITB_DB_REGION\" "
            "FROM customer",
        ),
        "read_source_bucketed": (
            read_source_bucketed,
            "SELECT *, year(o_orderdate)::INT AS year, "
            "month(o_orderdate)::INT AS month FROM orders "
            "WHERE o_orderdate > TIMESTAMP '1998-11-20'",
        ),
        "read_source_region": (
            read_source_region,
            "SELECT * RENAME (o_custkey AS partner_id) FROM orders WHERE o_custkey IN "
            "(SELECT c_custkey FROM customer WHERE c_nationkey % 3 < 2)",
        ),
        "ingest": (ingest, INGEST_SQL),
        "land_pending": (_landed_twice, LANDED_SQL),
        "land_stream": (
            landed_stream,
            f'SELECT {json_sql(COLUMNS["events"])} AS "SRC" FROM events',
        ),
    }
