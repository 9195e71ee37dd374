"""The pipeline configuration as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.rows import ref
from tidemark.model import BRONZE, LANDER, NOT_AVAILABLE, PIPELINE_CONFIG, ObjectSpec
from tidemark.operators.checkpoint import OBJECT_KEYS, specs_of


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the types and order of ``schema``, columns matched ignoring case.

    Stores that keep flags as text spell them in several ways; all become boolean.
    Columns the store lacks are null.
    """
    own = {f.name.lower(): f for f in df.schema}

    def typed(field: T.StructField):
        have = own.get(field.name.lower())
        if have is None:
            value = F.lit(None)
        elif isinstance(field.dataType, T.BooleanType) and isinstance(have.dataType, T.StringType):
            value = F.upper(F.trim(ref(have.name))) == "TRUE"
        else:
            value = ref(have.name)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[typed(f) for f in schema])


def read_config(spark: SparkSession, source: str, fmt: str | None = None, **options) -> DataFrame:
    """The configuration, from a catalog table, Parquet files or a connector.

    A missing database or table is an error here, not an empty run later.
    """
    if fmt is not None:
        rows = spark.read.format(fmt).options(dbtable=source, **options).load()
    else:
        rows = spark.read.parquet(source) if "/" in source else spark.table(source)
    return conform(rows, PIPELINE_CONFIG)


def active_objects(
    config: DataFrame, namespace: str, proc_group: str, layers: tuple[str, ...] = (BRONZE,)
) -> DataFrame:
    """Active rows of one namespace and processing group; BRONZE unless told otherwise."""
    return config.where(
        (F.col("SOURCE_NAMESPACE") == namespace)
        & (F.col("PROC_GROUP") == proc_group)
        & F.col("LAYER_TYPE").isin(*layers)
        & F.col("IS_ACTIVE")
    )


def list_objects(config: DataFrame) -> DataFrame:
    """Distinct source names of the BRONZE rows."""
    return config.where(F.col("LAYER_TYPE") == BRONZE).select("SOURCE_TABLE_NAME").distinct()


def _first_row(config: DataFrame, layer: str, fields: dict[str, str]) -> DataFrame:
    """One row per object of a layer, the one with the smallest target name.

    A minimum over structs merges before the shuffle, unlike a window.
    """
    order = ["TARGET_TABLE_NAME"] + [c for c in fields if c != "TARGET_TABLE_NAME"]
    return (
        config.where(F.col("LAYER_TYPE") == layer)
        .groupBy(*OBJECT_KEYS)
        .agg(F.min(F.struct(*order)).alias("row"))
        .select(*OBJECT_KEYS, *[F.col(f"row.{c}").alias(a) for c, a in fields.items()])
    )


def resolve_objects(config: DataFrame) -> DataFrame:
    """BRONZE row and optional LANDER row of every object, side by side.

    Objects that are not landed show ``NA`` in the three lander columns.
    """
    bronze = _first_row(
        config,
        BRONZE,
        {
            "EXTRACT_METHOD": "extract_method",
            "SOURCE_SYSTEM": "source_system",
            "TARGET_TABLE_NAME": "target_table",
            "TARGET_STORE_TYPE": "store_type",
            "CHECKPOINT_FIELD_DEF": "checkpoint_def",
            "CHECKPOINT_TO_VALUE": "checkpoint_value",
        },
    )
    landed = {
        "FLATTEN_MODE": "flatten_mode",
        "CHECKPOINT_FROM_VALUE": "lander_from",
        "TARGET_TABLE_NAME": "lander_target",
    }
    lander = _first_row(config, LANDER, landed)
    joined = bronze.join(lander, list(OBJECT_KEYS), "left")
    return joined.select(
        *bronze.columns,
        *[F.coalesce(c, F.lit(NOT_AVAILABLE)).alias(c) for c in landed.values()],
    )


def resolve_targets(config: DataFrame) -> DataFrame:
    """As ``resolve_objects``, but one row for every target of an object.

    Two rows of one object and target are an error: neither is the right one to run.
    """
    named = [*OBJECT_KEYS, "TARGET_TABLE_NAME"]
    bronze = config.where(F.col("LAYER_TYPE") == BRONZE)
    counted = bronze.groupBy(*named).agg(F.count(F.lit(1)).alias("rows"))
    twice = F.raise_error(F.lit("an object and target are configured twice"))
    once = counted.select(*named, F.when(F.col("rows") > 1, twice.cast("boolean")).otherwise(True).alias("once"))
    own = bronze.join(once.where("once"), named, "left_semi").select(
        *OBJECT_KEYS,
        F.col("EXTRACT_METHOD").alias("extract_method"),
        F.col("SOURCE_SYSTEM").alias("source_system"),
        F.col("TARGET_TABLE_NAME").alias("target_table"),
        F.col("TARGET_STORE_TYPE").alias("store_type"),
        F.col("CHECKPOINT_FIELD_DEF").alias("checkpoint_def"),
        F.col("CHECKPOINT_TO_VALUE").alias("checkpoint_value"),
    )
    landed = resolve_objects(config).select(*OBJECT_KEYS, "flatten_mode", "lander_from", "lander_target")
    return own.join(landed, list(OBJECT_KEYS))


def target_lookup(config: DataFrame) -> DataFrame:
    """Target name of every BRONZE object."""
    return resolve_objects(config).select(*OBJECT_KEYS, "target_table")


def primary_keys(config: DataFrame) -> DataFrame:
    """Partition key names followed by clustering key names, as one array."""
    parsed = F.from_json("SOURCE_KEY_FIELDS", "partition_key string, clustering_key string")
    joined = F.concat_ws(",", F.col("k.partition_key"), F.col("k.clustering_key"))
    return (
        config.where(F.col("SOURCE_KEY_FIELDS").isNotNull())
        .select(*OBJECT_KEYS, "TARGET_TABLE_NAME", "LAYER_TYPE", parsed.alias("k"))
        .select(
            *OBJECT_KEYS,
            "TARGET_TABLE_NAME",
            "LAYER_TYPE",
            F.filter(F.split(joined, ","), lambda n: n != "").alias("primary_key"),
        )
    )


def with_moves(resolved: DataFrame, moves: DataFrame) -> DataFrame:
    """Carry configured checkpoint values forward by the latest stored moves.

    ``moves`` has one row per object and configured value. Adds ``configured``.
    """
    keys = ["SOURCE_NAMESPACE", "SOURCE_TABLE_NAME"]
    named = {"PROC_GROUP": "PROC_GROUP", "TARGET_TABLE_NAME": "target_table"}
    left, right = resolved.alias("r"), moves.alias("m")
    same = [F.col(f"r.{k}") == F.col(f"m.{k}") for k in keys]
    same += [F.col(f"r.{b}").eqNullSafe(F.col(f"m.{a}")) for a, b in named.items() if a in moves.columns]
    same.append(F.col("r.checkpoint_value").eqNullSafe(F.col("m.configured")))
    return left.join(right, same, "left").select(
        *[
            F.coalesce("m.checkpoint", "r.checkpoint_value").alias(c)
            if c == "checkpoint_value"
            else F.col(f"r.{c}")
            for c in resolved.columns
        ],
        F.col("r.checkpoint_value").alias("configured"),
    )


def object_specs(config: DataFrame, moves: DataFrame | None = None) -> list[ObjectSpec]:
    """All objects of a run in one job: one configuration row each."""
    resolved = resolve_targets(config)
    if moves is None:
        resolved = resolved.withColumn("configured", F.col("checkpoint_value"))
    else:
        resolved = with_moves(resolved, moves)
    rows = resolved.collect()
    return sorted(
        (
            ObjectSpec(
                namespace=r.SOURCE_NAMESPACE,
                source_table=r.SOURCE_TABLE_NAME,
                target_table=r.target_table,
                source_system=(r.source_system or "").upper(),
                extract_method=r.extract_method,
                proc_group=r.PROC_GROUP,
                store_type=r.store_type or "",
                flatten_mode=r.flatten_mode,
                lander_from=r.lander_from,
                lander_target=r.lander_target,
                checkpoints=specs_of(r.checkpoint_def, r.checkpoint_value),
                configured_checkpoint=r.configured,
            )
            for r in rows
        ),
        key=lambda s: (s.namespace, s.source_table, s.target_table),
    )
