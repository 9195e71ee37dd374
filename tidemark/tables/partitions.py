"""Loads of a table as one partitioned Parquet table, by kind and run hour.

The other layout, a folder per load below ``yyyy/mm/dd/hh``, needs a log to tell which
files to read. Here kind and hour are partition columns: a load replaces its own partition,
whatever else is written meanwhile, and the loads after an hour are found by pruning
partitions, without listing or opening the files of others.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.model import FULL_EXTRACT, FULL_LOAD, Run
from tidemark.operators.transforms import drop_technical, to_src

KIND, HOUR = "load_kind", "load_hour"
_KEYS = T.StructType([T.StructField(KIND, T.StringType()), T.StructField(HOUR, T.StringType())])


def hour_text(hour: datetime) -> str:
    """Hours as text that sorts by time."""
    return f"{hour:%Y-%m-%d-%H}"


class PartitionedLoads:
    def __init__(self, spark: SparkSession, root: str, table: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{table}"

    def write(self, df: DataFrame, run: Run, kind: str) -> None:
        """Write one load; repeating it replaces its partition and no other."""
        clash = sorted({KIND, HOUR} & {c.lower() for c in df.columns})
        if clash:
            raise ValueError(f"columns named like the partitions: {clash}")
        keyed = df.withColumns({KIND: F.lit(kind), HOUR: F.lit(hour_text(run.hour))})
        writer = keyed.write.option("maxRecordsPerFile", run.max_records_per_file)
        writer.partitionBy(KIND, HOUR).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(self.path)

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """All loads, kind and hour as columns; without ``schema`` those of all files are merged."""
        if schema is not None:
            return self.spark.read.schema(T.StructType([*schema, *_KEYS])).parquet(self.path)
        # Hours look like dates to the reader's guess; they stay text.
        reader = self.spark.read.option("mergeSchema", "true")
        rows = reader.parquet(self.path)
        return self.read(T.StructType([f for f in rows.schema if f.name not in _KEYS.names]))

    def after(self, kind: str, hour: datetime | None, schema: T.StructType | None = None) -> DataFrame:
        """Rows of the loads of a kind after ``hour``, of all without one."""
        wanted: Column = F.col(KIND) == kind
        if hour is not None:
            wanted = wanted & (F.col(HOUR) > hour_text(hour))
        return self.read(schema).where(wanted)

    def latest(self, kind: str, schema: T.StructType | None = None) -> DataFrame:
        """Rows of the latest load of a kind; the hour is looked up in the partitions' names."""
        rows = self.read(schema).where(F.col(KIND) == kind)
        top = rows.agg(F.max(HOUR)).first()[0]
        return rows.where(F.col(HOUR) == F.lit(top))

    def raw_rows(self, method: str, kind: str, since: datetime | None, schema: T.StructType | None = None) -> DataFrame:
        """JSON rows to land: of full extracts the latest copy, of others what came after ``since``."""
        full = method == FULL_EXTRACT or kind == FULL_LOAD
        rows = self.latest(kind, schema) if full else self.after(kind, since, schema)
        return to_src(drop_technical(rows.drop(KIND, HOUR)))
