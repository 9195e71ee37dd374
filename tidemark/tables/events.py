"""Small states kept as appended events that are folded from time to time.

An append writes one folder of its own below ``events``. After ``every`` appends the latest
event of each key is written to one file below ``state``, named by the position up to which
it holds; events up to there are never read again. So a read opens one state and fewer than
``every`` events, however many there have been. Folders without the mark of a finished
write are passed over. What a reader may still hold is kept for one more fold.

One writer per log is assumed, any number of readers may work beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import few_rows
from tidemark.sources.files import delete_folder, folder_names, path_exists

POSITION = "position"
FOLD_EVERY = 16


class EventLog:
    """Rows of ``schema``; of rows with equal ``keys`` the last one counts.

    ``gone`` says of a latest row, as an SQL condition, that its key need not be kept.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: tuple[str, ...],
        gone: str = "false",
        every: int = FOLD_EVERY,
    ):
        self.spark, self.path, self.keys, self.gone, self.every = spark, path.rstrip("/"), keys, gone, every
        self.schema = T.StructType([*schema.fields, T.StructField(POSITION, T.LongType())])

    def _positions(self, kind: str) -> list[int]:
        """Positions that were written, finished or not, in order."""
        names = folder_names(self.spark, f"{self.path}/{kind}")
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith("at="))

    def _folder(self, kind: str, position: int) -> str:
        return f"{self.path}/{kind}/at={position:015d}"

    def _finished(self, kind: str, position: int) -> bool:
        return path_exists(self.spark, f"{self._folder(kind, position)}/_SUCCESS")

    def _sources(self) -> tuple[list[str], int]:
        """The folders of a read, and how many of them are events."""
        states = [p for p in self._positions("state") if self._finished("state", p)][-1:]
        events = [p for p in self._positions("events") if not states or p > states[0]]
        events = [p for p in events if self._finished("events", p)]
        folders = [self._folder("state", p) for p in states] + [self._folder("events", p) for p in events]
        return folders, len(events)

    def is_empty(self) -> bool:
        """Whether nothing was ever noted; told by names, without a job."""
        return not self._sources()[0]

    def read(self) -> DataFrame:
        """The latest row of each key, with its position."""
        folders, _ = self._sources()
        if not folders:
            return few_rows(self.spark, [], self.schema)
        rows = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*folders)
        rest = F.struct(POSITION, *[c for c in rows.columns if c not in (*self.keys, POSITION)])
        latest = rows.groupBy(*self.keys).agg(F.max_by(rest, POSITION).alias("last"))
        names = [c if c in self.keys else f"last.{c}" for c in rows.columns]
        return latest.select(*names).where(f"NOT coalesce({self.gone}, false)")

    def append(self, rows: DataFrame) -> int:
        """Add rows of one event, columns as in the schema; returns its position."""
        position = max([0, *self._positions("events"), *self._positions("state")]) + 1
        named = rows.select(*self.schema.names[:-1]).withColumn(POSITION, F.lit(position).cast("long"))
        named.coalesce(1).write.parquet(self._folder("events", position))
        _, events = self._sources()
        if events >= self.every:
            self.fold()
        return position

    def note(self, *rows: tuple) -> int:
        """``append`` of a handful of driver-side rows."""
        return self.append(few_rows(self.spark, rows, T.StructType(self.schema.fields[:-1])))

    def fold(self) -> None:
        """Write the latest rows as one state; drop what the state before already held."""
        events = self._positions("events")
        if not events:
            return
        older = [p for p in self._positions("state") if self._finished("state", p)]
        if older and events[-1] <= older[-1]:
            return
        self.read().coalesce(1).write.mode("overwrite").parquet(self._folder("state", events[-1]))
        if older:
            for position in [p for p in events if p <= older[-1]]:
                delete_folder(self.spark, self._folder("events", position))
            for position in older[:-1]:
                delete_folder(self.spark, self._folder("state", position))
