"""Append-only Parquet tables that grow by slices and whose columns may widen.

Each try to write a slice gets a folder of its own below ``data``, by schema, and is
published by one row of the slice log. A repeat is seen in the place of the earlier try in
one step, and a try that died is never seen. Slices are read in the schema they were
written with and cast up to the common one, so no footer is opened for planning and a
slice with wider or new columns leaves the others readable. A slice that no common type
would hold is refused before it is written.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.rows import ref
from tidemark.functions.widening import common_schema, merged, widened
from tidemark.session import few_rows
from tidemark.sources.files import delete_folder, folder_names
from tidemark.tables.events import EventLog
from tidemark.tables.snapshots import write_parquet

SLICE, TRY = "__slice", "__try"
SLICES = T.StructType([T.StructField(n, T.StringType()) for n in (SLICE, TRY, "schema_id", "data_schema")])


def _id(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


class AppendTable:
    """One writer at a time is assumed."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name = spark, name
        self.path = f"{root.rstrip('/')}/{name}"
        self.log = EventLog(spark, f"{self.path}/_slices", SLICES, (SLICE,))

    def _schemas(self, name: str | None = None) -> tuple[list[tuple[str, T.StructType]], str | None]:
        """(id, schema) of the published slices, oldest first, and the published try of slice ``name``.

        A few rows, however many slices there are.
        """
        if self.log.is_empty():
            return [], None
        live = self.log.read().where(F.col(TRY).isNotNull())
        own = F.max(F.when(F.col(SLICE) == name, F.col(TRY)))
        rows = live.groupBy("schema_id", "data_schema").agg(F.min("position").alias("first"), own.alias("own")).collect()
        ordered = sorted(rows, key=lambda r: r.first)
        schemas = [(r.schema_id, T.StructType.fromJson(json.loads(r.data_schema))) for r in ordered]
        return schemas, next((r.own for r in rows if r.own), None)

    def _slice_path(self, schema_id: str, name: str) -> str:
        return f"{self.path}/data/schema={schema_id}/{SLICE}={name}"

    def _tries(self, name: str) -> list[str]:
        """Folders of all tries of a slice, in whatever schema."""
        parents = [
            self._slice_path(schema.partition("=")[2], name) for schema in folder_names(self.spark, f"{self.path}/data")
        ]
        return [f"{parent}/{found}" for parent in parents for found in folder_names(self.spark, parent)]

    def append(
        self, df: DataFrame, run_hour: datetime | None = None, slice_key: str | None = None, **write
    ) -> None:
        """Write one slice in the place of its earlier try; new columns are null in the others."""
        name = _id(slice_key if slice_key is not None else f"hour@{run_hour}")
        known, earlier = self._schemas(name)
        if known:
            common_schema(merged([schema for _, schema in known]), df.schema)
        text = df.schema.json()
        folder = f"{self._slice_path(_id(text), name)}/{TRY}={uuid.uuid4().hex}"
        write_parquet(df, folder, **write)
        self.log.note((name, folder.rpartition("=")[2], _id(text), text))
        # A reader may still hold the try before this one; older and dead ones go.
        held = {folder.rpartition("=")[2], earlier}
        for path in self._tries(name):
            if path.rpartition("=")[2] not in held:
                delete_folder(self.spark, path)

    def undo(self, slice_key: str) -> None:
        """Take a slice back; of one that was never published only the leftovers go."""
        name = _id(slice_key)
        if self._schemas(name)[1] is None:
            for path in self._tries(name):
                delete_folder(self.spark, path)
        else:
            self.log.note((name, None, None, None))

    def schema(self) -> T.StructType:
        known, _ = self._schemas()
        if not known:
            raise ValueError(f"table {self.name!r} has no slice")
        return merged([schema for _, schema in known])

    def read(self) -> DataFrame:
        """All published slices in their common schema."""
        known, _ = self._schemas()
        if not known:
            # Every slice was taken back: the columns are those of the last one written.
            return few_rows(self.spark, [], self._last_schema())
        common = merged([schema for _, schema in known])
        live = self.log.read().where(F.col(TRY).isNotNull()).select(SLICE, TRY)
        keys = T.StructType([T.StructField(n, T.StringType()) for n in (SLICE, TRY)])
        keyed, found = T.StructType([*common, *keys]), None
        for schema_id, schema in known:
            files = self.spark.read.schema(T.StructType([*schema, *keys]))
            rows = widened(files.parquet(f"{self.path}/data/schema={schema_id}"), keyed)
            found = rows if found is None else found.unionAll(rows)
        return found.join(live, [SLICE, TRY], "left_semi").select(*[ref(c) for c in common.names])

    def _last_schema(self) -> T.StructType:
        for schema in folder_names(self.spark, f"{self.path}/data"):
            return self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.path}/data/{schema}").schema
        raise ValueError(f"table {self.name!r} has no slice")
