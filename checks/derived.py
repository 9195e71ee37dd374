"""Inputs that Spark derives from the given tables, with the same rule as SQL.

Configuration rows come from ``part`` and file inventory rows from ``events``, so
both grow with the data.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.filelog import to_log_rows

RUN_TS = datetime(2024, 5, 1, 10, 20, 30)
RUN_HOUR_SQL = "TIMESTAMP '2024-05-01 10:00:00'"
RUN_TS_SQL = "TIMESTAMP '2024-05-01 10:20:30'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CONFIG_BRONZE = {
    "SOURCE_NAMESPACE": "concat('ns', cast(p_partkey div 2 % 3 as string))",
    "SOURCE_TABLE_NAME": "concat('obj_', cast(p_partkey div 2 as string))",
    "TARGET_TABLE_NAME": "concat('tgt_', cast(p_partkey as string), "
    "CASE WHEN p_partkey % 2 = 0 THEN '-EU' ELSE '-NA' END)",
    "LAYER_TYPE": "'BRONZE'",
    "SOURCE_SYSTEM": "element_at(array('CASSANDRA','AZURESQL','POSTGRESQL','MYSQL','MONGODB'), "
    "cast(p_partkey % 5 + 1 as int))",
    "EXTRACT_METHOD": "element_at(array('FULL_EXTRACT','FULL_EXTRACT_INCR','KEY_INCR_EXTRACT'), "
    "cast(p_partkey % 3 + 1 as int))",
    "TARGET_STORE_TYPE": "element_at(array('Glue_Iceberg_Parquet_File',"
    "'glue_iceberg_raw_table','parquet'), cast(p_partkey % 3 + 1 as int))",
    "PROC_GROUP": "CASE WHEN p_partkey div 2 % 2 = 0 THEN 'GRP_A' ELSE 'GRP_B' END",
    "IS_ACTIVE": "p_size % 7 <> 0",
    "SOURCE_KEY_FIELDS": """concat('{"partition_key":"', replace(p_type, ' ', '_'), ',id",'
        '"clustering_key":"', CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'ts' END, '"}')""",
    "CHECKPOINT_FIELD_DEF": "CASE p_partkey % 3 WHEN 0 THEN 'updated_at::timestamp::>' WHEN 1 "
    "THEN 'year::numeric::>=|month::numeric::>=|updated_at::timestamp::>' END",
    "CHECKPOINT_TO_VALUE": "CASE p_partkey % 3 WHEN 0 THEN concat('2024-01-0', "
    "cast(1 + p_partkey % 9 as string), ' 00:00:00') WHEN 1 THEN '2024-02-01 00:00:00|x' END",
    "CHECKPOINT_FROM_VALUE": "cast(null as string)",
    "FLATTEN_MODE": "cast(null as string)",
}

_CONFIG_LANDER = {
    **_CONFIG_BRONZE,
    "TARGET_TABLE_NAME": "concat('raw_', cast(p_partkey as string))",
    "LAYER_TYPE": "'LANDER'",
    "CHECKPOINT_FIELD_DEF": "cast(null as string)",
    "CHECKPOINT_TO_VALUE": "cast(null as string)",
    "CHECKPOINT_FROM_VALUE": "concat('2024-02-0', cast(1 + p_partkey % 9 as string))",
    "FLATTEN_MODE": "CASE WHEN p_partkey % 2 = 0 THEN 'SNOWFLAKE' ELSE 'OTHER' END",
}


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    bronze = part.selectExpr(*[f"{e} AS {c}" for c, e in _CONFIG_BRONZE.items()])
    lander = part.where("p_partkey % 6 = 0").selectExpr(
        *[f"{e} AS {c}" for c, e in _CONFIG_LANDER.items()]
    )
    return bronze.unionAll(lander)


CONFIG_SQL = """
config AS (
  SELECT
    'ns' || (p_partkey // 2 % 3) AS SOURCE_NAMESPACE,
    'obj_' || (p_partkey // 2) AS SOURCE_TABLE_NAME,
    CASE layer WHEN 'BRONZE' THEN 'tgt_' || p_partkey ||
      (CASE WHEN p_partkey % 2 = 0 THEN '-EU' ELSE '-NA' END)
      ELSE 'raw_' || p_partkey END AS TARGET_TABLE_NAME,
    layer AS LAYER_TYPE,
    ['CASSANDRA','AZURESQL','POSTGRESQL','MYSQL','MONGODB'][p_partkey % 5 + 1] AS SOURCE_SYSTEM,
    ['FULL_EXTRACT','FULL_EXTRACT_INCR','KEY_INCR_EXTRACT'][p_partkey % 3 + 1]
      AS EXTRACT_METHOD,
    ['Glue_Iceberg_Parquet_File','glue_iceberg_raw_table','parquet'][p_partkey % 3 + 1]
      AS TARGET_STORE_TYPE,
    CASE WHEN p_partkey // 2 % 2 = 0 THEN 'GRP_A' ELSE 'GRP_B' END AS PROC_GROUP,
    p_size % 7 <> 0 AS IS_ACTIVE,
    '{"partition_key":"' || replace(p_type, ' ', '_') || ',id","clustering_key":"' ||
      (CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'ts' END) || '"}' AS SOURCE_KEY_FIELDS,
    CASE WHEN layer = 'LANDER' THEN NULL WHEN p_partkey % 3 = 0 THEN 'updated_at::timestamp::>'
      WHEN p_partkey % 3 = 1
      THEN 'year::numeric::>=|month::numeric::>=|updated_at::timestamp::>' END
      AS CHECKPOINT_FIELD_DEF,
    CASE WHEN layer = 'LANDER' THEN NULL
      WHEN p_partkey % 3 = 0 THEN '2024-01-0' || (1 + p_partkey % 9) || ' 00:00:00'
      WHEN p_partkey % 3 = 1 THEN '2024-02-01 00:00:00|x' END AS CHECKPOINT_TO_VALUE,
    CASE WHEN layer = 'LANDER' THEN '2024-02-0' || (1 + p_partkey % 9) END
      AS CHECKPOINT_FROM_VALUE,
    CASE WHEN layer = 'LANDER' THEN
      (CASE WHEN p_partkey % 2 = 0 THEN 'SNOWFLAKE' ELSE 'OTHER' END) END AS FLATTEN_MODE
  FROM part, (VALUES ('BRONZE'), ('LANDER')) AS l(layer)
  WHERE layer = 'BRONZE' OR p_partkey % 6 = 0
)"""


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per event: path below a bucket, modification time, length."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('tbl_', cast(user_id % 20 as string), "
        "CASE WHEN event_id % 10 = 0 THEN '_archive' ELSE '' END) AS table_name",
        """concat('s3a://lake/tbl_', cast(user_id % 20 as string),
             CASE WHEN event_id % 10 = 0 THEN '_archive' ELSE '' END, '/',
             element_at(array('full_load','incr_load','key_incr_load','tmp'),
                        cast(event_id % 4 + 1 as int)), '/',
             CASE WHEN event_id % 50 = 7 THEN ''
                  ELSE concat(date_format(ts, 'yyyy/MM/dd/HH'), '/') END,
             CASE WHEN event_id % 97 = 5 THEN concat('_SUCCESS_', cast(event_id as string))
                  ELSE concat('part-', cast(event_id as string), '.parquet') END) AS path""",
        "ts AS modified",
        "event_id AS length",
    )


INVENTORY_SQL = """
inventory AS (
  SELECT 'tbl_' || (user_id % 20) || (CASE WHEN event_id % 10 = 0 THEN '_archive' ELSE '' END)
      AS table_name,
    's3a://lake/tbl_' || (user_id % 20) ||
      (CASE WHEN event_id % 10 = 0 THEN '_archive' ELSE '' END) || '/' ||
      ['full_load','incr_load','key_incr_load','tmp'][event_id % 4 + 1] || '/' ||
      (CASE WHEN event_id % 50 = 7 THEN '' ELSE strftime(ts, '%Y/%m/%d/%H') || '/' END) ||
      (CASE WHEN event_id % 97 = 5 THEN '_SUCCESS_' || event_id
            ELSE 'part-' || event_id || '.parquet' END) AS path,
    ts AS modified, event_id AS length
  FROM events
)"""

LOG_SQL = (
    INVENTORY_SQL
    + f""",
file_log AS (
  SELECT substr(path, 12) AS FILE_WITH_PATH, modified AS FILE_MODIFIED_DTIMEUTC,
    length % 3 = 0 AS PROCESSED_FLAG, md5(substr(path, 12)) AS FILE_UID,
    'lake' AS BUCKET_NAME, {RUN_TS_SQL} AS FILE_PROCESSED_DTIMEUTC,
    table_name AS TABLE_NAME, 'NA' AS FILE_ERROR_MSG, 'NA' AS MAP_SRC_TRGT_OBJECT_UID,
    {RUN_TS_SQL} AS CREATED_AT_DTIMEUTC, false AS REPROCESS_FLAG
  FROM inventory WHERE path NOT LIKE '%\\_SUCCESS%' ESCAPE '\\'
)"""
)


def file_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows of the inventory; every third file counts as processed."""
    rows = to_log_rows(inventory(spark, sf_dir), "x", "lake", RUN_TS)
    part = F.regexp_extract("FILE_WITH_PATH", r"part-(\d+)\.parquet$", 1).cast("bigint")
    return rows.withColumn("PROCESSED_FLAG", part % 3 == 0).withColumn(
        "TABLE_NAME", F.substring_index("FILE_WITH_PATH", "/", 1)
    )


def perturbed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier copy: some rows missing, some changed, some deleted since."""
    now = table(spark, sf_dir, "customer")
    kept = now.where("c_custkey % 10 <> 0").withColumn(
        "c_acctbal",
        F.when(F.col("c_custkey") % 7 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")),
    )
    gone = now.where("c_custkey % 13 = 0").withColumn("c_custkey", -1 - F.col("c_custkey"))
    return kept.unionAll(gone)


PERTURBED_CUSTOMERS_SQL = """
before AS (
  SELECT c_custkey, c_name, c_nationkey,
    CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 10 <> 0
  UNION ALL
  SELECT -1 - c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 13 = 0
)"""


COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": [
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    ],
    "lineitem": [
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "pages": ["page_id", "url", "html"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
TIMESTAMPS = {"o_orderdate", "l_shipdate", "ts", "INGEST_EFF_DTIMEUTC"}


def json_sql(columns: list[str]) -> str:
    """The row text in SQL: every column in order, timestamps with microseconds."""
    parts = [
        f"'{c}': strftime({c}, '%Y-%m-%d %H:%M:%S.%f')" if c in TIMESTAMPS else f"'{c}': {c}"
        for c in columns
    ]
    return "to_json({" + ", ".join(parts) + "})::VARCHAR"


def hash_sql(columns: list[str]) -> str:
    return f"md5({json_sql(columns)})"
