"""Lakehouse catalog tables, for clusters whose class path has such a runtime.

Offers what ``VersionedTable`` offers, through the runtime's own commands: every
write is one atomic commit there, so nothing is deleted before an insert.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.transforms import aligned_names


#: The column that tells which slice a row was written with.
SLICE = "ingest_slice"


class LakehouseTable:
    def __init__(self, spark: SparkSession, catalog: str, database: str, name: str):
        for part in (catalog, database, name):
            if not re.fullmatch(r"\w[\w\-]*", part):
                raise ValueError(f"not a plain identifier: {part!r}")
        self.spark, self.catalog, self.name = spark, catalog, name
        self.identifier = self.path = f"{catalog}.{database}.`{name}`"

    def read(self) -> DataFrame:
        return self.spark.table(self.identifier)

    def snapshots(self) -> DataFrame:
        return self.spark.table(f"{self.identifier}.snapshots")

    def append(
        self, df: DataFrame, run_hour: datetime | None = None, slice_key: str | None = None, **_
    ) -> None:
        """Write one slice in the place of its earlier try, as one atomic commit."""
        key = slice_key if slice_key is not None else f"hour@{run_hour}"
        if SLICE not in self.read().columns:
            self.spark.sql(f"ALTER TABLE {self.identifier} ADD COLUMN {SLICE} STRING")
        rows = df.withColumn(SLICE, F.lit(key))
        rows.writeTo(self.identifier).option("mergeSchema", "true").overwrite(F.col(SLICE) == key)

    def undo(self, slice_key: str) -> None:
        """Overwrite a slice with nothing."""
        self.read().limit(0).writeTo(self.identifier).overwrite(F.col(SLICE) == slice_key)

    def replace(self, df: DataFrame, run_hour: datetime | None = None, **_) -> None:
        """Overwrite all rows, matched by name."""
        named = aligned_names(df, self.read().columns)
        named.writeTo(self.identifier).overwrite(F.lit(True))

    def retire(self) -> None:
        """Nothing: the runtime expires snapshots by the table's own properties."""

    def rollback(self, to_empty: bool = False) -> None:
        """Back to the parent of the current snapshot."""
        current = self.snapshots().agg(
            F.max_by("parent_id", F.struct("committed_at", "snapshot_id")).alias("parent_id")
        )
        parent = current.first().parent_id
        if parent is None:
            raise ValueError(f"table {self.identifier} has no earlier snapshot")
        self.spark.sql(
            f"CALL {self.catalog}.system.rollback_to_snapshot("
            f"table => '{self.identifier}', snapshot_id => {int(parent)})"
        )
