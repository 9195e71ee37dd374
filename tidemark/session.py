"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# A side of a join is broadcast only when its row count is known to be at or below
# this bound (a few tens of megabytes of hashes or keys per executor).
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.sparkContext.getCheckpointDir()
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, so far unused path below the shared folder."""
    return f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Later stages then start from stored files: a lost executor re-reads a file
    instead of the whole lineage, and the planner sees a real size.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffle_partitions(spark: SparkSession, number: int) -> Iterator[None]:
    """Joins and aggregations that are planned within are dealt into ``number`` partitions."""
    usual, first = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {name: spark.conf.get(name, None) for name in (usual, first)}
    try:
        spark.conf.set(usual, str(number))
        if before[first] is not None:  # it goes before the other
            spark.conf.set(first, str(number))
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _width(df: DataFrame) -> Column:
    """About how many bytes a row takes: texts count by their length, whatever holds them."""
    width = F.lit(0)
    for f in df.schema:
        value = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + 16 + F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            width = width + 16 + F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
        else:
            width = width + 8
    return width.cast("long")


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint when ``df``, measured first, is within ``limit`` rows and ``size`` bytes.

    Beyond either the frame is returned as it is, and the planner's shuffle join with
    its run-time skew handling applies.
    """
    rows, taken = df.agg(F.count(F.lit(1)), F.sum(_width(df))).first()
    return F.broadcast(df) if rows <= limit and (taken or 0) <= size else df


def few_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A handful of driver-side values (or none) as literals: no Python task runs."""

    def literal(value):
        # As text, a time is not shifted between the Python and the session zone.
        return F.lit(value.isoformat(sep=" ") if isinstance(value, datetime) else value)

    def typed(values: tuple):
        pairs = zip(schema, values, strict=True)
        return F.struct(*[literal(v).cast(f.dataType).alias(f.name) for f, v in pairs])

    rows = list(rows)
    if not rows:
        return spark.range(0).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        )
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*map(typed, rows))))
