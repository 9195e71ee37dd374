"""The column catalogue: which columns a source has."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.model import COLUMN_CATALOGUE, SOURCE_SYSTEMS, utc_naive
from tidemark.sources.readers import JdbcSpec, read_connector, read_jdbc

INFORMATION_SCHEMA = "information_schema.columns"


def from_information_schema(rows: DataFrame) -> DataFrame:
    """The five catalogue columns of a relational ``information_schema.columns``."""
    names = {c.lower(): c for c in rows.columns}
    return rows.select(
        *[F.col(names[f.name]).cast("string").alias(f.name) for f in COLUMN_CATALOGUE]
    )


def from_wide_column_schema(rows: DataFrame, catalog: str) -> DataFrame:
    """A wide-column store's ``system_schema.columns`` in catalogue form."""
    return rows.select(
        F.lit(catalog).alias("table_catalog"),
        F.col("keyspace_name").cast("string").alias("table_schema"),
        F.col("table_name").cast("string").alias("table_name"),
        F.col("column_name").cast("string").alias("column_name"),
        F.col("type").cast("string").alias("data_type"),
    )


def from_frames(
    spark: SparkSession, frames: Mapping[str, DataFrame], catalog: str, schema: str
) -> DataFrame:
    """Catalogue rows of frames whose schema Spark knows already, such as files."""
    rows = [
        (catalog, schema, table, f.name, f.dataType.simpleString())
        for table, df in frames.items()
        for f in df.schema
    ]
    return spark.createDataFrame(rows, COLUMN_CATALOGUE)


def read_columns(spark: SparkSession, spec: JdbcSpec) -> DataFrame:
    """Column catalogue of a relational database; only five columns leave it."""
    return from_information_schema(
        read_jdbc(spark, replace(spec, table=INFORMATION_SCHEMA, query=None))
    )


def read_wide_columns(spark: SparkSession, fmt: str, catalog: str, **options: str) -> DataFrame:
    rows = read_connector(spark, fmt, keyspace="system_schema", table="columns", **options)
    return from_wide_column_schema(rows, catalog)


def discover_columns(*catalogues: DataFrame) -> DataFrame:
    """All catalogues in one frame, ready for ``saveAsTable`` or a snapshot."""
    found, *rest = catalogues
    for more in rest:
        found = found.unionByName(more)
    return found


def catalogue_of(source_system: str, readers: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """The catalogue of a source by its system; ``readers`` hold one reader per system.

    A system without a reader is an error. Document stores have no catalogue of their own:
    their reader is one over the frames that were read from them (``from_frames``).
    """
    system = source_system.upper()
    if system not in SOURCE_SYSTEMS:
        raise ValueError(f"unknown source system {source_system!r}")
    if system not in readers:
        raise ValueError(f"no column reader for {system}")
    return discover_columns(readers[system]())


def _run_path(root: str, run_ts: datetime) -> str:
    return f"{root.rstrip('/')}/column_catalogue/run={utc_naive(run_ts):%Y-%m-%dT%H-%M-%S}"


def store_catalogue(catalogue: DataFrame, root: str, run_ts: datetime) -> str:
    """Keep the catalogue of one run in a folder of its own; returns the folder."""
    path = _run_path(root, run_ts)
    catalogue.select(*COLUMN_CATALOGUE.names).write.mode("overwrite").parquet(path)
    return path


def read_catalogue(spark: SparkSession, root: str, run_ts: datetime) -> DataFrame:
    return spark.read.schema(COLUMN_CATALOGUE).parquet(_run_path(root, run_ts))


def compared_catalogues(before: DataFrame, after: DataFrame) -> DataFrame:
    """(table_catalog, table_schema, table_name, column_name, old_type, new_type, change).

    ``change`` is added, gone or retyped; columns that stayed as they were are left out.
    One full outer join by name; names that a catalogue lists twice count once.
    """
    keys = [c for c in COLUMN_CATALOGUE.names if c != "data_type"]

    def typed(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.min("data_type").alias(name))

    left, right = typed(before, "old_type").alias("b"), typed(after, "new_type").alias("a")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}"))
    joined = left.join(right, same, "full_outer")
    change = F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "gone").otherwise("retyped")
    return joined.where(~F.col("old_type").eqNullSafe(F.col("new_type"))).select(
        *[F.coalesce(f"b.{k}", f"a.{k}").alias(k) for k in keys], "old_type", "new_type", change.alias("change")
    )


def column_drift(spark: SparkSession, root: str, earlier: datetime, later: datetime) -> DataFrame:
    """What changed between the stored catalogues of two runs."""
    return compared_catalogues(read_catalogue(spark, root, earlier), read_catalogue(spark, root, later))
