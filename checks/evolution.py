"""Columns that widen, nested values, instants: what changes between two runs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from checks.derived import COLUMNS, RUN_HOUR_SQL, RUN_TS, json_sql, table
from tidemark.functions.predicates import checkpoint_predicate
from tidemark.model import FULL_EXTRACT, KEY_INCR_EXTRACT, KEY_INCR_LOAD, POSTGRESQL, ObjectSpec, Run
from tidemark.operators.checkpoint import specs_of
from tidemark.operators.transforms import with_row_hash
from tidemark.plans import flows
from tidemark.plans.lander import land_pending
from tidemark.session import fresh_folder, stage
from tidemark.sources.columns import catalogue_of, column_drift, from_frames, store_catalogue
from tidemark.sources.files import read_files
from tidemark.tables.appends import AppendTable


def _stores(spark, root, hour=0):
    return flows.Stores.parquet(spark, Run(RUN_TS + timedelta(hours=hour), root))


def append_widened(spark, sf_dir):
    """A second slice brings wider integers, decimals, doubles, times and a new column."""
    customers, target = table(spark, sf_dir, "customer"), AppendTable(spark, fresh_folder(spark, "appends"), "customer")
    target.append(
        customers.where("c_custkey % 2 = 0").selectExpr(
            "cast(c_custkey AS int) AS c_custkey", "c_name", "cast(c_nationkey AS smallint) AS c_nationkey",
            "cast(c_acctbal AS decimal(12,2)) AS balance", "c_nationkey AS rate", "DATE '2024-01-01' AS seen",
        ),
        slice_key="narrow",
    )
    target.append(
        customers.where("c_custkey % 2 = 1").selectExpr(
            "c_custkey", "c_name", "cast(c_nationkey AS int) AS C_NATIONKEY", "cast(c_acctbal AS decimal(16,4)) AS balance",
            "c_nationkey / 4 AS rate", "TIMESTAMP_NTZ '2024-01-02 10:00:00' AS seen", "c_mktsegment",
        ),
        slice_key="wide",
    )
    rows = target.read()
    assert [f.dataType.simpleString() for f in rows.schema] == [
        "bigint", "string", "int", "decimal(16,4)", "double", "timestamp_ntz", "string",
    ]
    return rows.withColumn("balance", F.col("balance").cast("double"))


def append_nested_drift(spark, sf_dir):
    """Fields are added and widened inside structs, arrays and maps; then a slice is repeated."""
    orders, target = table(spark, sf_dir, "orders"), AppendTable(spark, fresh_folder(spark, "appends"), "orders")
    even, odd = orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 = 1")
    wide = odd.selectExpr(
        "o_orderkey",
        "named_struct('extra', o_orderpriority, 'key', o_custkey, 'tags', array(named_struct('n', o_orderkey, 's', o_orderstatus))) AS info",
        "map('total', o_totalprice) AS sums",
    )
    for _ in range(2):
        target.append(wide, slice_key="odd")
    target.append(
        even.selectExpr(
            "o_orderkey",
            "CASE WHEN o_orderkey % 3 > 0 THEN named_struct('key', cast(o_custkey AS int), "
            "'tags', array(named_struct('n', cast(o_orderkey AS int)))) END AS info",
            "map('total', cast(o_orderkey AS int)) AS sums",
        ),
        slice_key="even",
    )
    return target.read().selectExpr(
        "o_orderkey", "info IS NULL AS empty", "info.key AS key", "info.extra AS extra", "get(info.tags, 0).n AS n",
        "get(info.tags, 0).s AS s", "sums['total'] AS total",
    )


def land_drifted(spark, sf_dir):
    """Loads of two hours wait; in between a column was widened and one added."""
    customers, root = table(spark, sf_dir, "customer"), fresh_folder(spark, "flow")
    spec = ObjectSpec("shop", "customer", "customer", POSTGRESQL, FULL_EXTRACT)
    even = customers.where("c_custkey % 2 = 0").withColumn("c_custkey", F.col("c_custkey").cast("int")).drop("c_mktsegment")
    flows.full_extract(even, spec, _stores(spark, root))
    later = _stores(spark, root, 1)
    flows.full_extract(customers.where("c_custkey % 2 = 1"), spec, later)
    target = later.raw("customer")
    land_pending(spark, later.log, "customer", target, later.run)
    return target.read()


def _hashed_twice(rows, left, right):
    """Hashes of one value stored in two ways."""
    one = with_row_hash(rows.select("p_partkey", left.alias("v"))).select("p_partkey", "hash")
    two = with_row_hash(rows.select("p_partkey", right.alias("v"))).select("p_partkey", F.col("hash").alias("again"))
    return one.join(two, "p_partkey")


def _map(*entries):
    return F.create_map(*[F.lit(x) if isinstance(x, str) else x for e in entries for x in e])


def row_hash_nested_map(spark, sf_dir):
    """Equal maps in different orders inside an array of structs."""
    brand, kind = ("brand", F.col("p_brand")), ("type", F.col("p_type"))

    def value(m):
        return F.array(F.struct(F.col("p_size").alias("size"), m.alias("tags")), F.struct(F.lit(0).alias("size"), m.alias("tags")))

    return _hashed_twice(table(spark, sf_dir, "part"), value(_map(brand, kind)), value(_map(kind, brand)))


def row_hash_map_of_map(spark, sf_dir):
    """Maps whose values are maps, both stored in different orders."""
    one, two = _map(("b", F.col("p_brand")), ("a", F.col("p_type"))), _map(("a", F.col("p_type")), ("b", F.col("p_brand")))
    return _hashed_twice(table(spark, sf_dir, "part"), _map(("x", one), ("w", two)), _map(("w", one), ("x", two)))


def row_hash_embeddings(spark, sf_dir):
    """Rows with an array of floats."""
    return with_row_hash(table(spark, sf_dir, "embeddings"))


def _float_text(x):
    """How a float is written: plain from 0.001 on, with an exponent below."""
    digits = f"regexp_replace(regexp_replace(regexp_replace(abs({x})::VARCHAR, 'e.*', ''), '[.]', ''), '^0+', '')"
    small = (
        f"CASE WHEN {x} < 0 THEN '-' ELSE '' END || left({digits}, 1) || '.' || "
        f"CASE WHEN length({digits}) > 1 THEN substr({digits}, 2) ELSE '0' END || 'E' || floor(log10(abs({x}::DOUBLE)))::INT"
    )
    return f"CASE WHEN {x} <> 0 AND abs({x}) < 0.001 THEN {small} ELSE {x}::VARCHAR END"


EMBEDDINGS_SQL = f"""
SELECT *, md5('{{"vec_id":' || vec_id || ',"embedding":[' ||
    array_to_string(list_transform(embedding, lambda x: {_float_text("x")}), ',') || '],"label":' || label || '}}') AS hash
FROM embeddings"""


def checkpoint_zoned(spark, sf_dir):
    """A maximum taken in a Tokyo session is read in a UTC one: no row is skipped or read twice."""
    events = table(spark, sf_dir, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    rows = stage(events.withColumn("at", F.expr("cast(unix_micros(cast(ts AS timestamp)) AS bigint)")), "events")
    rows = stage(rows.withColumn("at", F.timestamp_micros("at")), "events")
    cut = low + (high - low) / 2
    zone, root, moved, text, found = spark.conf.get("spark.sql.session.timeZone"), fresh_folder(spark, "flow"), [], None, None
    try:
        for hour, (own_zone, part) in enumerate((("Asia/Tokyo", rows.where(F.col("ts") <= F.lit(cut).cast("timestamp_ntz"))), ("UTC", rows))):
            spark.conf.set("spark.sql.session.timeZone", own_zone)
            specs = specs_of("at::timestamp::>", text or "1900-01-01 00:00:00")
            spec = ObjectSpec("shop", "events", "events", POSTGRESQL, KEY_INCR_EXTRACT, checkpoints=specs)
            stores = _stores(spark, root, hour)
            flows.key_incr_extract(part.where(checkpoint_predicate(specs)), spec, stores, lambda _, v: moved.append(v))
            text = moved[-1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    for hour in range(2):
        path = f"{root}/events/{KEY_INCR_LOAD}/{RUN_TS + timedelta(hours=hour):%Y/%m/%d/%H}"
        part = read_files(spark, [path]).select(F.lit(hour).alias("hour"), *COLUMNS["events"])
        found = part if found is None else found.unionAll(part)
    return found


def column_drifts(spark, sf_dir):
    """The catalogue of two runs: columns added, gone and retyped in between."""
    names, root = sorted(COLUMNS), fresh_folder(spark, "catalogue")
    frames = {n: table(spark, sf_dir, n) for n in names}
    readers = {"POSTGRESQL": lambda: from_frames(spark, frames, "lake", "shop")}
    store_catalogue(catalogue_of("postgresql", readers), root, RUN_TS)
    frames["customer"] = frames["customer"].drop("c_mktsegment").withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))
    frames["orders"] = frames["orders"].withColumn("o_clerk", F.lit("x"))
    del frames["region"]
    store_catalogue(catalogue_of("postgresql", readers), root, RUN_TS + timedelta(hours=1))
    return column_drift(spark, root, RUN_TS, RUN_TS + timedelta(hours=1))


_TYPE = (
    "CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
    "ELSE lower(data_type) END"
)
DRIFT_SQL = f"""
WITH before AS (
    SELECT 'lake' AS table_catalog, 'shop' AS table_schema, table_name, column_name, {_TYPE} AS old_type
    FROM information_schema.columns WHERE table_name IN ('customer', 'orders', 'region'))
SELECT *, NULL::VARCHAR AS new_type, 'gone' AS change FROM before WHERE table_name = 'region' OR column_name = 'c_mktsegment'
UNION ALL SELECT *, 'bigint', 'retyped' FROM before WHERE column_name = 'c_nationkey'
UNION ALL SELECT 'lake', 'shop', 'orders', 'o_clerk', NULL, 'string', 'added'"""


def checks():
    nested = '{"size":%s,"tags":{"brand":"\' || p_brand || \'","type":"\' || p_type || \'"}}'
    nested = nested % "' || p_size || '" + "," + nested % "0"
    inner = '{"a":"\' || p_type || \'","b":"\' || p_brand || \'"}'
    in_array = "md5('{\"p_partkey\":' || p_partkey || ',\"v\":[" + nested + "]}')"
    in_map = "md5('{\"p_partkey\":' || p_partkey || ',\"v\":{\"w\":" + inner + ',"x":' + inner + "}}')"
    even = json_sql(["c_custkey", "c_name", "c_nationkey", "c_acctbal", "INGEST_EFF_DTIMEUTC"])
    odd = json_sql([*COLUMNS["customer"], "INGEST_EFF_DTIMEUTC"])
    columns = ", ".join(COLUMNS["events"])
    return {
        "append_widened": (
            append_widened,
            "SELECT c_custkey, c_name, c_nationkey, c_acctbal::DECIMAL(12,2)::DOUBLE AS balance, c_nationkey::DOUBLE AS rate, "
            "TIMESTAMP '2024-01-01' AS seen, NULL::VARCHAR AS c_mktsegment FROM customer WHERE c_custkey % 2 = 0 UNION ALL "
            "SELECT c_custkey, c_name, c_nationkey, c_acctbal::DECIMAL(16,4)::DOUBLE, c_nationkey / 4, "
            "TIMESTAMP '2024-01-02 10:00:00', c_mktsegment FROM customer WHERE c_custkey % 2 = 1",
        ),
        "append_nested_drift": (
            append_nested_drift,
            "SELECT o_orderkey, false AS empty, o_custkey AS key, o_orderpriority AS extra, o_orderkey AS n, o_orderstatus AS s, "
            "o_totalprice AS total FROM orders WHERE o_orderkey % 2 = 1 UNION ALL "
            "SELECT o_orderkey, o_orderkey % 3 = 0, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END, NULL, "
            "CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END, NULL, o_orderkey::DOUBLE FROM orders WHERE o_orderkey % 2 = 0",
        ),
        "land_drifted": (
            land_drifted,
            f'SELECT {even} AS "SRC" FROM (SELECT *, {RUN_HOUR_SQL} AS "INGEST_EFF_DTIMEUTC" FROM customer WHERE c_custkey % 2 = 0) '
            f'UNION ALL SELECT {odd} FROM (SELECT *, {RUN_HOUR_SQL} + INTERVAL 1 HOUR AS "INGEST_EFF_DTIMEUTC" '
            "FROM customer WHERE c_custkey % 2 = 1)",
        ),
        "row_hash_nested_map": (row_hash_nested_map, f"SELECT p_partkey, {in_array} AS hash, {in_array} AS again FROM part"),
        "row_hash_map_of_map": (row_hash_map_of_map, f"SELECT p_partkey, {in_map} AS hash, {in_map} AS again FROM part"),
        "row_hash_embeddings": (row_hash_embeddings, EMBEDDINGS_SQL),
        "checkpoint_zoned": (
            checkpoint_zoned,
            f"SELECT CASE WHEN ts <= middle THEN 0 ELSE 1 END AS hour, {columns} FROM events, "
            "(SELECT min(ts) + (max(ts) - min(ts)) / 2 AS middle FROM events)",
        ),
        "column_drift": (column_drifts, DRIFT_SQL),
    }
