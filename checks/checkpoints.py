"""Checkpoint reads, the values that follow them, and configuration operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.derived import CONFIG_SQL, config, table
from tidemark.functions.names import target_name
from tidemark.functions.predicates import bucketed_checkpoint_predicate, checkpoint_predicate
from tidemark.operators import checkpoint as cp, config as cf
from tidemark.operators.checkpoint import specs_of
from tidemark.operators.transforms import lowercase_columns
from tidemark.session import fresh_folder
from tidemark.tables.checkpoints import latest_moves


def _read(name: str, definition: str, values: str):
    def query(spark, sf_dir):
        return table(spark, sf_dir, name).where(checkpoint_predicate(specs_of(definition, values)))

    return query


def checkpoint_read_boolean(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_totalprice") > 200000).alias("large")
    )
    return rows.where(checkpoint_predicate(specs_of("large::boolean::=", "TRUE")))


def checkpoint_read_bucketed(spark, sf_dir):
    """Year and month buckets; the checkpoint lies in a December."""
    rows = table(spark, sf_dir, "orders").select(
        "*",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )
    specs = specs_of(
        "year::numeric::>=|month::numeric::>=|o_orderdate::timestamp::>", "1997-12-05 00:00:00"
    )
    return rows.where(bucketed_checkpoint_predicate(specs))


def next_checkpoint(spark, sf_dir):
    return cp.next_checkpoint(table(spark, sf_dir, "events"), ["ts"])


def next_checkpoint_multi(spark, sf_dir):
    return cp.next_checkpoint(table(spark, sf_dir, "events"), ["event_id", "event_type", "ts"])


def next_checkpoint_seconds(spark, sf_dir):
    return cp.next_checkpoint(table(spark, sf_dir, "events"), ["ts", "value"], "second")


def next_checkpoint_empty(spark, sf_dir):
    return cp.next_checkpoint(table(spark, sf_dir, "orders").where("o_orderkey < 0"), ["o_orderdate"])


def observed_checkpoint(spark, sf_dir):
    """The maximum and count seen while the rows are written somewhere else."""
    specs = specs_of("o_orderdate::timestamp::>|o_orderkey::numeric::>", "1990-01-01 00:00:00|0")
    rows, seen = cp.observe_checkpoint(table(spark, sf_dir, "orders"), specs)
    rows.write.parquet(fresh_folder(spark, "observed"))
    checkpoint, count = cp.observed_value(seen, specs)
    return spark.createDataFrame([(checkpoint, count)], "checkpoint string, row_count bigint")


def checkpoint_parse(spark, sf_dir):
    return cp.parse_checkpoints(config(spark, sf_dir))


CHECKPOINT_PARSE_SQL = f"""
WITH {CONFIG_SQL},
split AS (
  SELECT *, string_split(CHECKPOINT_FIELD_DEF, '|') AS defs,
    string_split(CHECKPOINT_TO_VALUE, '|') AS vals
  FROM config WHERE LAYER_TYPE = 'BRONZE' AND CHECKPOINT_FIELD_DEF IS NOT NULL),
entries AS (SELECT *, unnest(range(len(defs))) AS pos FROM split)
SELECT SOURCE_NAMESPACE, SOURCE_TABLE_NAME, PROC_GROUP, TARGET_TABLE_NAME, pos::INT AS pos,
  split_part(defs[pos + 1], '::', 1) AS field, split_part(defs[pos + 1], '::', 2) AS type,
  split_part(defs[pos + 1], '::', 3) AS op, vals[pos + 1] AS value
FROM entries"""


def checkpoint_fields(spark, sf_dir):
    found = cp.checkpoint_fields(config(spark, sf_dir))
    return found.withColumn("fields", F.array_join("fields", ","))


CHECKPOINT_FIELDS_SQL = f"""
WITH {CONFIG_SQL}
SELECT SOURCE_NAMESPACE, SOURCE_TABLE_NAME, PROC_GROUP, TARGET_TABLE_NAME,
  array_to_string(list_transform(string_split(CHECKPOINT_FIELD_DEF, '|'),
    lambda e: split_part(e, '::', 1)), ',') AS fields
FROM config WHERE LAYER_TYPE = 'BRONZE' AND CHECKPOINT_FIELD_DEF IS NOT NULL"""


def active_objects(spark, sf_dir):
    return cf.active_objects(config(spark, sf_dir), "ns1", "GRP_A")


def config_import(spark, sf_dir):
    """A stored configuration with text flags, lower-case names and a column missing."""
    path = fresh_folder(spark, "config")
    stored = config(spark, sf_dir).drop("SOURCE_KEY_FIELDS").withColumn(
        "IS_ACTIVE", F.when(F.col("IS_ACTIVE"), "True").otherwise("FALSE")
    )
    lowercase_columns(stored).write.parquet(path)
    return cf.read_config(spark, path)


def list_objects(spark, sf_dir):
    return cf.list_objects(config(spark, sf_dir))


def resolve_objects(spark, sf_dir):
    return cf.resolve_objects(config(spark, sf_dir))


RESOLVE_OBJECTS_SQL = f"""
WITH {CONFIG_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY SOURCE_NAMESPACE, SOURCE_TABLE_NAME,
    PROC_GROUP, LAYER_TYPE ORDER BY TARGET_TABLE_NAME) AS rn FROM config)
SELECT b.SOURCE_NAMESPACE, b.SOURCE_TABLE_NAME, b.PROC_GROUP,
  b.EXTRACT_METHOD AS extract_method, b.SOURCE_SYSTEM AS source_system,
  b.TARGET_TABLE_NAME AS target_table, b.TARGET_STORE_TYPE AS store_type,
  b.CHECKPOINT_FIELD_DEF AS checkpoint_def, b.CHECKPOINT_TO_VALUE AS checkpoint_value,
  coalesce(l.FLATTEN_MODE, 'NA') AS flatten_mode,
  coalesce(l.CHECKPOINT_FROM_VALUE, 'NA') AS lander_from,
  coalesce(l.TARGET_TABLE_NAME, 'NA') AS lander_target
FROM ranked b LEFT JOIN ranked l ON l.LAYER_TYPE = 'LANDER' AND l.rn = 1
  AND l.SOURCE_NAMESPACE = b.SOURCE_NAMESPACE AND l.SOURCE_TABLE_NAME = b.SOURCE_TABLE_NAME
  AND l.PROC_GROUP = b.PROC_GROUP
WHERE b.LAYER_TYPE = 'BRONZE' AND b.rn = 1"""


def target_lookup(spark, sf_dir):
    return cf.target_lookup(config(spark, sf_dir))


def target_names(spark, sf_dir):
    return config(spark, sf_dir).select(
        "TARGET_TABLE_NAME",
        "SOURCE_SYSTEM",
        target_name(F.col("TARGET_TABLE_NAME"), F.col("SOURCE_SYSTEM")).alias("lake_name"),
    )


def primary_keys(spark, sf_dir):
    found = cf.primary_keys(config(spark, sf_dir))
    return found.withColumn("primary_key", F.array_join("primary_key", "+"))


PRIMARY_KEYS_SQL = f"""
WITH {CONFIG_SQL}
SELECT SOURCE_NAMESPACE, SOURCE_TABLE_NAME, PROC_GROUP, TARGET_TABLE_NAME, LAYER_TYPE,
  array_to_string(list_filter(string_split(
    (SOURCE_KEY_FIELDS::JSON ->> 'partition_key') || ',' ||
    (SOURCE_KEY_FIELDS::JSON ->> 'clustering_key'), ','), lambda n: n <> ''), '+') AS primary_key
FROM config"""


def advance_checkpoints(spark, sf_dir):
    """New values from the orders of each part's name; some objects had no new rows."""
    new = table(spark, sf_dir, "part").where("p_partkey % 2 = 0").selectExpr(
        "concat('ns', cast(p_partkey div 2 % 3 as string)) AS SOURCE_NAMESPACE",
        "concat('obj_', cast(p_partkey div 2 as string)) AS SOURCE_TABLE_NAME",
        "CASE WHEN p_partkey % 5 <> 0 THEN concat('2024-03-0', "
        "cast(1 + p_partkey % 9 as string), ' 00:00:00') END AS checkpoint",
    )
    moved = cp.advance_checkpoints(config(spark, sf_dir), new)
    return moved.select("TARGET_TABLE_NAME", "LAYER_TYPE", "CHECKPOINT_TO_VALUE")


def carried_checkpoints(spark, sf_dir):
    """Two stored moves per object, some of them from a value configured no longer."""
    resolved = cf.resolve_objects(config(spark, sf_dir))
    moves = resolved.selectExpr(
        "SOURCE_NAMESPACE",
        "SOURCE_TABLE_NAME",
        "CASE WHEN source_system = 'MYSQL' THEN 'edited' ELSE checkpoint_value END AS configured",
        "explode(array(2L, 1L)) AS position",
    ).withColumn("checkpoint", F.concat(F.lit("move-"), F.col("position")))
    return cf.with_moves(resolved, latest_moves(moves)).select(
        "SOURCE_NAMESPACE", "SOURCE_TABLE_NAME", "PROC_GROUP", "checkpoint_value", "configured"
    )


CARRIED_SQL = f"""
WITH {CONFIG_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY SOURCE_NAMESPACE, SOURCE_TABLE_NAME,
    PROC_GROUP ORDER BY TARGET_TABLE_NAME) AS rn FROM config WHERE LAYER_TYPE = 'BRONZE')
SELECT SOURCE_NAMESPACE, SOURCE_TABLE_NAME, PROC_GROUP,
  CASE WHEN SOURCE_SYSTEM = 'MYSQL' THEN CHECKPOINT_TO_VALUE ELSE 'move-2' END
    AS checkpoint_value, CHECKPOINT_TO_VALUE AS configured
FROM ranked WHERE rn = 1"""


ADVANCE_SQL = f"""
WITH {CONFIG_SQL},
new AS (SELECT 'ns' || (p_partkey // 2 % 3) AS ns, 'obj_' || (p_partkey // 2) AS obj,
    CASE WHEN p_partkey % 5 <> 0 THEN '2024-03-0' || (1 + p_partkey % 9) || ' 00:00:00' END AS v
  FROM part WHERE p_partkey % 2 = 0)
SELECT TARGET_TABLE_NAME, LAYER_TYPE, CASE WHEN LAYER_TYPE = 'BRONZE'
  THEN coalesce(v, CHECKPOINT_TO_VALUE) ELSE CHECKPOINT_TO_VALUE END AS CHECKPOINT_TO_VALUE
FROM config LEFT JOIN new ON ns = SOURCE_NAMESPACE AND obj = SOURCE_TABLE_NAME"""


def config_from_catalog(spark, sf_dir):
    """The configuration as a table of the session's catalog, flags kept as text."""
    name = f"pipeline_config_{uuid.uuid4().hex}"
    rows = config(spark, sf_dir).withColumn("IS_ACTIVE", F.initcap(F.col("IS_ACTIVE").cast("string")))
    rows.write.option("path", fresh_folder(spark, "catalog")).saveAsTable(name)
    found = cf.read_config(spark, name)
    spark.sql(f"DROP TABLE {name}")  # the name alone: the files lie outside the warehouse
    return found


def checks():
    return {
        "config_from_catalog": (config_from_catalog, f"WITH {CONFIG_SQL} SELECT * FROM config"),
        "checkpoint_read_ts": (
            _read("events", "ts::timestamp::>", "2024-01-20 12:30:00.5"),
            "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-20 12:30:00.5'",
        ),
        "checkpoint_read_datetime": (
            _read("orders", "o_orderdate::datetime::>=", "1998-06-01"),
            "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01'",
        ),
        "checkpoint_read_numeric": (
            _read("orders", "o_orderkey::numeric::>", "7000"),
            "SELECT * FROM orders WHERE o_orderkey > 7000",
        ),
        "checkpoint_read_decimal": (
            _read("lineitem", "l_extendedprice::numeric::<=", "20000.5"),
            "SELECT * FROM lineitem WHERE l_extendedprice <= 20000.5",
        ),
        "checkpoint_read_string": (
            _read("orders", "o_orderpriority::string::>", "3-MEDIUM"),
            "SELECT * FROM orders WHERE o_orderpriority > '3-MEDIUM'",
        ),
        "checkpoint_read_boolean": (
            checkpoint_read_boolean,
            "SELECT o_orderkey, true AS large FROM orders WHERE o_totalprice > 200000",
        ),
        "checkpoint_read_multi": (
            _read(
                "lineitem",
                "l_shipdate::timestamp::>|l_orderkey::numeric::>=|l_returnflag::string::!=",
                "1997-01-01 00:00:00|5000|R",
            ),
            "SELECT * FROM lineitem WHERE l_shipdate > TIMESTAMP '1997-01-01' "
            "AND l_orderkey >= 5000 AND l_returnflag <> 'R'",
        ),
        "checkpoint_read_bucketed": (
            checkpoint_read_bucketed,
            "SELECT *, year(o_orderdate)::INT AS year, "
            "month(o_orderdate)::INT AS month FROM orders "
            "WHERE o_orderdate > TIMESTAMP '1997-12-05'",
        ),
        "next_checkpoint": (
            next_checkpoint,
            "SELECT max(ts)::VARCHAR AS checkpoint, count(*) AS row_count FROM events",
        ),
        "next_checkpoint_multi": (
            next_checkpoint_multi,
            "SELECT concat_ws('|', max(event_id), max(event_type), max(ts)) AS checkpoint, "
            "count(*) AS row_count FROM events",
        ),
        "next_checkpoint_seconds": (
            next_checkpoint_seconds,
            "SELECT concat_ws('|', date_trunc('second', max(ts)), max(value)) AS checkpoint, "
            "count(*) AS row_count FROM events",
        ),
        "next_checkpoint_empty": (
            next_checkpoint_empty,
            "SELECT NULL::VARCHAR AS checkpoint, count(*) AS row_count FROM orders "
            "WHERE o_orderkey < 0",
        ),
        "observed_checkpoint": (
            observed_checkpoint,
            "SELECT concat_ws('|', max(o_orderdate), max(o_orderkey)) AS checkpoint, "
            "count(*) AS row_count FROM orders",
        ),
        "checkpoint_parse": (checkpoint_parse, CHECKPOINT_PARSE_SQL),
        "checkpoint_fields": (checkpoint_fields, CHECKPOINT_FIELDS_SQL),
        "active_objects": (
            active_objects,
            f"WITH {CONFIG_SQL} SELECT * FROM config WHERE SOURCE_NAMESPACE = 'ns1' "
            "AND PROC_GROUP = 'GRP_A' AND LAYER_TYPE = 'BRONZE' AND IS_ACTIVE",
        ),
        "config_import": (
            config_import,
            f"WITH {CONFIG_SQL} SELECT * REPLACE (NULL::VARCHAR AS SOURCE_KEY_FIELDS) "
            "FROM config",
        ),
        "list_objects": (
            list_objects,
            f"WITH {CONFIG_SQL} SELECT DISTINCT SOURCE_TABLE_NAME FROM config "
            "WHERE LAYER_TYPE = 'BRONZE'",
        ),
        "resolve_objects": (resolve_objects, RESOLVE_OBJECTS_SQL),
        "target_lookup": (
            target_lookup,
            f"WITH {CONFIG_SQL} SELECT SOURCE_NAMESPACE, SOURCE_TABLE_NAME, PROC_GROUP, "
            "min(TARGET_TABLE_NAME) AS target_table FROM config WHERE LAYER_TYPE = 'BRONZE' "
            "GROUP BY ALL",
        ),
        "target_names": (
            target_names,
            f"WITH {CONFIG_SQL} SELECT TARGET_TABLE_NAME, SOURCE_SYSTEM, CASE SOURCE_SYSTEM "
            "WHEN 'CASSANDRA' THEN 'cs_' WHEN 'POSTGRESQL' THEN 'pg_' WHEN 'MYSQL' THEN 'ms_' "
            "WHEN 'AZURESQL' THEN 'sqlsrvr_' ELSE '' END || TARGET_TABLE_NAME AS lake_name "
            "FROM config",
        ),
        "primary_keys": (primary_keys, PRIMARY_KEYS_SQL),
        "carried_checkpoints": (carried_checkpoints, CARRIED_SQL),
        "advance_checkpoints": (advance_checkpoints, ADVANCE_SQL),
    }
