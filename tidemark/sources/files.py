"""File readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.session import few_rows


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf).exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none of one that does not exist."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(conf)
    return [s.getPath().getName() for s in store.listStatus(target)] if store.exists(target) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete one folder; needs a classic session, as ``path_exists`` does."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


def read_files(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Parquet files of an explicit list; an empty list needs ``schema``.

    With a schema no footer is read before the scan; without one the schemas of
    all files are merged.
    """
    if not paths:
        if schema is None:
            raise ValueError("an empty file list needs a schema")
        return few_rows(spark, [], schema)
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", "true")
    return reader.parquet(*paths)


def by_schema(spark: SparkSession, folders: Sequence[str]) -> list[DataFrame]:
    """Parquet folders, those of one schema as one frame.

    A folder is what one write left, so its schema is that of any of its files: one footer
    is opened per folder, whatever the number of files.
    """
    found: dict[str, list[str]] = {}
    schemas: dict[str, T.StructType] = {}
    for folder in folders:
        schema = spark.read.option("recursiveFileLookup", "true").parquet(folder).schema
        found.setdefault(schema.json(), []).append(folder)
        schemas[schema.json()] = schema
    return [read_files(spark, paths, schemas[text]) for text, paths in found.items()]


def read_documents(
    spark: SparkSession,
    location: str,
    sampling_ratio: float = 1.0,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Line-delimited JSON documents, schema inferred from a sample unless given.

    Fields that are null in every sampled document keep the void type here;
    follow with ``void_to_string``. Inference is a pass of its own over the
    sample: give ``schema`` for large, stable collections.
    """
    reader = spark.read.option("samplingRatio", sampling_ratio).option(
        "dropFieldIfAllNull", "false"
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(location)
