"""Row-wise operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.derived import COLUMNS, RUN_HOUR_SQL, RUN_TS, hash_sql, json_sql, table
from tidemark.operators import transforms as t
from tidemark.sources.columns import (
    discover_columns,
    from_information_schema,
    from_wide_column_schema,
)


def _hash_of(name: str, key: list[str]):
    """(query, SQL) of the row hash of one table, with its key columns."""

    def query(spark, sf_dir):
        return t.with_row_hash(table(spark, sf_dir, name)).select(*key, "hash")

    return query, f"SELECT {', '.join(key)}, {hash_sql(COLUMNS[name])} AS hash FROM {name}"


def row_hash_nulls(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.expr("nullif(c_mktsegment, 'BUILDING')")
    )
    return t.with_row_hash(rows).select("c_custkey", "hash")


_CUSTOMER = COLUMNS["customer"]
ROW_HASH_NULLS_SQL = f"""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN {hash_sql(_CUSTOMER[:-1])}
  ELSE {hash_sql(_CUSTOMER)} END AS hash FROM customer"""


def row_hash_exclude(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return t.with_row_hash(rows, exclude=("o_orderpriority",)).select("o_orderkey", "hash")


def src_json(spark, sf_dir):
    return t.with_src_json(table(spark, sf_dir, "part"))


def src_only(spark, sf_dir):
    return t.to_src(table(spark, sf_dir, "conversations"))


def src_only_events(spark, sf_dir):
    return t.to_src(table(spark, sf_dir, "events"))


def rename_reserved(spark, sf_dir):
    return t.rename_reserved(table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "Hash"))


def ingest_stamp(spark, sf_dir):
    return t.with_ingest_ts(table(spark, sf_dir, "orders"), RUN_TS)


def lowercase_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier")
    return t.lowercase_columns(rows.toDF(*[c.upper() for c in rows.columns]))


def void_to_string(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.lit(None).alias("empty"),
        F.struct(F.col("c_name").alias("name"), F.lit(None).alias("gap")).alias("nested"),
    )
    return t.void_to_string(rows).select(
        "c_custkey",
        "empty",
        F.col("nested.name").alias("nested_name"),
        F.col("nested.gap").alias("nested_gap"),
    )


def region_tag(spark, sf_dir):
    return t.with_region_tag(table(spark, sf_dir, "customer"), "orders-EU")


def normalise_timestamps(spark, sf_dir):
    zoned = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp").alias("ts")
    )
    return t.normalise_timestamps(zoned)


def drop_technical(spark, sf_dir):
    return t.drop_technical(t.with_row_hash(table(spark, sf_dir, "supplier")))


def column_catalogue(spark, sf_dir):
    """Two source catalogues, derived from part and supplier rows, brought together."""
    relational = table(spark, sf_dir, "part").selectExpr(
        "'shop' AS TABLE_CATALOG",
        "p_brand AS TABLE_SCHEMA",
        "p_type AS TABLE_NAME",
        "concat(replace(p_name, ' ', '_'), '_', cast(p_partkey as string)) AS COLUMN_NAME",
        "CASE WHEN p_size > 25 THEN 'int' ELSE 'varchar' END AS DATA_TYPE",
        "p_partkey AS ORDINAL_POSITION",
    )
    wide = table(spark, sf_dir, "supplier").selectExpr(
        "concat('ks', cast(s_nationkey as string)) AS keyspace_name",
        "s_name AS table_name",
        "concat('c', cast(s_suppkey as string)) AS column_name",
        "'text' AS type",
        "'regular' AS kind",
    )
    return discover_columns(
        from_information_schema(relational), from_wide_column_schema(wide, "ring")
    )


COLUMN_CATALOGUE_SQL = """
SELECT 'shop' AS table_catalog, p_brand AS table_schema, p_type AS table_name,
  replace(p_name, ' ', '_') || '_' || p_partkey AS column_name,
  CASE WHEN p_size > 25 THEN 'int' ELSE 'varchar' END AS data_type FROM part
UNION ALL
SELECT 'ring', 'ks' || s_nationkey, s_name, 'c' || s_suppkey, 'text' FROM supplier"""


def checks():
    return {
        "row_hash_customer": _hash_of("customer", ["c_custkey"]),
        "row_hash_orders": _hash_of("orders", ["o_orderkey"]),
        "row_hash_lineitem": _hash_of("lineitem", ["l_orderkey", "l_linenumber"]),
        "row_hash_events": _hash_of("events", ["event_id"]),
        "row_hash_documents": _hash_of("documents", ["doc_id"]),
        "row_hash_pages": _hash_of("pages", ["page_id"]),
        "row_hash_nulls": (row_hash_nulls, ROW_HASH_NULLS_SQL),
        "row_hash_exclude": (
            row_hash_exclude,
            f"SELECT o_orderkey, {hash_sql(COLUMNS['orders'][:-1])} AS hash FROM orders",
        ),
        "src_json": (src_json, f'SELECT *, {json_sql(COLUMNS["part"])} AS "SRC" FROM part'),
        "src_only": (
            src_only,
            f'SELECT {json_sql(COLUMNS["conversations"])} AS "SRC" FROM conversations',
        ),
        "src_only_events": (
            src_only_events,
            f'SELECT {json_sql(COLUMNS["events"])} AS "SRC" FROM events',
        ),
        "rename_reserved": (
            rename_reserved,
            "SELECT * RENAME (l_returnflag AS src_hash) FROM lineitem",
        ),
        "ingest_stamp": (
            ingest_stamp,
            f'SELECT *, {RUN_HOUR_SQL} AS "INGEST_EFF_DTIMEUTC" FROM orders',
        ),
        "lowercase_columns": (lowercase_columns, "SELECT * FROM supplier"),
        "void_to_string": (
            void_to_string,
            "SELECT c_custkey, NULL::VARCHAR AS empty, c_name AS nested_name, "
            "NULL::VARCHAR AS nested_gap FROM customer",
        ),
        "region_tag": (
            region_tag,
            "SELECT *, split_part('orders-EU', '-', 2) AS \"ITB_DB_REGION\" FROM customer",
        ),
        "normalise_timestamps": (normalise_timestamps, "SELECT event_id, ts FROM events"),
        "drop_technical": (drop_technical, "SELECT * FROM supplier"),
        "column_catalogue": (column_catalogue, COLUMN_CATALOGUE_SQL),
    }
