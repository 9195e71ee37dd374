"""Stored checkpoint moves.

Runs of several groups may work at the same time on one configuration. Instead of
rewriting it, each object's moves are noted in a log of the object's own, and a run starts
from the configured value carried forward by the last move. A move belongs to the
configured value it started from, and only an object's last move counts: editing the
configuration by hand therefore restarts the object from the edited value, also from one
it had before. A configuration that was saved with the moved values ends the moves that
led there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.names import object_path
from tidemark.model import BRONZE, ObjectSpec
from tidemark.session import few_rows
from tidemark.sources.files import path_exists
from tidemark.tables.events import EventLog

CHECKPOINT_MOVES = T.StructType(
    [
        T.StructField("SOURCE_NAMESPACE", T.StringType()),
        T.StructField("SOURCE_TABLE_NAME", T.StringType()),
        T.StructField("PROC_GROUP", T.StringType()),
        T.StructField("TARGET_TABLE_NAME", T.StringType()),
        T.StructField("configured", T.StringType()),
        T.StructField("position", T.LongType()),
        T.StructField("checkpoint", T.StringType()),
        T.StructField("try_id", T.StringType()),
    ]
)


OBJECT = ("SOURCE_NAMESPACE", "SOURCE_TABLE_NAME", "PROC_GROUP", "TARGET_TABLE_NAME")


def latest_moves(moves: DataFrame) -> DataFrame:
    """The last move of every object and configured value."""
    return moves.groupBy(*[c for c in OBJECT if c in moves.columns], "configured").agg(
        F.max_by("checkpoint", "position").alias("checkpoint")
    )


def current_moves(moves: DataFrame) -> DataFrame:
    """The last move of every object, whatever configured value it started from."""
    names = [c for c in ("configured", "checkpoint") if c in moves.columns]
    last = F.max_by(F.struct(*names), "position").alias("last")
    return moves.groupBy(*[c for c in OBJECT if c in moves.columns]).agg(last).select(
        *[c for c in OBJECT if c in moves.columns], *[f"last.{c}" for c in names]
    )


class CheckpointMoves:
    """The moves of all objects, one log per object: the last move of each configured value."""

    def __init__(self, spark: SparkSession, root: str, name: str = "checkpoint_moves"):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{name}"

    def _log(self, spec: ObjectSpec) -> EventLog:
        shape = T.StructType([f for f in CHECKPOINT_MOVES if f.name != "position"])
        return EventLog(self.spark, object_path(self.path, spec), shape, ("configured",))

    def read(self) -> DataFrame:
        """Rows of all objects; of an object and configured value the last move."""
        if not path_exists(self.spark, self.path):
            return few_rows(self.spark, [], CHECKPOINT_MOVES)
        # States and events of all objects at once: older rows of a key lose to newer ones.
        rows = self.spark.read.schema(CHECKPOINT_MOVES).option("recursiveFileLookup", "true").parquet(self.path)
        rest = F.struct("position", "checkpoint", "try_id")
        latest = rows.groupBy(*OBJECT, "configured").agg(F.max_by(rest, "position").alias("last"))
        return latest.select(*[c if c in (*OBJECT, "configured") else f"last.{c}" for c in CHECKPOINT_MOVES.names])

    def made_by(self, spec: ObjectSpec) -> set[str]:
        """Ids of the tries that made the stored moves of an object."""
        return {r[0] for r in self._log(spec).read().select("try_id").where("try_id IS NOT NULL").collect()}

    def _note(self, spec: ObjectSpec, configured: str | None, checkpoint: str, try_id: str | None) -> None:
        names = (spec.namespace, spec.source_table, spec.proc_group, spec.target_table)
        self._log(spec).note((*names, configured, checkpoint, try_id))

    def advance(self, spec: ObjectSpec, checkpoint: str, try_id: str | None = None) -> None:
        """Note one move. One run at a time per object is assumed."""
        self._note(spec, spec.configured_checkpoint, checkpoint, try_id)

    def saved(self, spec: ObjectSpec, configured: str) -> None:
        """The configuration now holds ``configured``: the moves that led there have ended."""
        self._note(spec, configured, configured, None)


def carried_config(config: DataFrame, moves: DataFrame) -> DataFrame:
    """The configuration with stored moves as its checkpoint values, for its one writer.

    Moves that started from another configured value than the present one are not
    applied: the value was edited since.
    """
    last = current_moves(moves).select(
        *[F.col(c).alias(f"of_{c}") for c in OBJECT], F.col("configured").alias("of_value"), "checkpoint"
    )
    same = F.col("CHECKPOINT_TO_VALUE").eqNullSafe(F.col("of_value")) & (F.col("LAYER_TYPE") == BRONZE)
    for c in OBJECT:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    joined = config.join(last, same, "left")
    return joined.select(
        *[
            F.coalesce("checkpoint", c).alias(c) if c == "CHECKPOINT_TO_VALUE" else F.col(c)
            for c in config.columns
        ]
    )
