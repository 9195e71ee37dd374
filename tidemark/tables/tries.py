"""Tries of checkpoint extracts, so that only a failed one is ever replaced.

A try is noted before it writes and closed when its checkpoint has moved. A stored move
names the try that made it; where moves are kept elsewhere, the try is sealed with its next
checkpoint before that is moved. What a run that died has left is settled when the next one
starts. A try whose move is stored, or that was sealed with the checkpoint now in force,
only failed to be closed, and is closed now, before any later move can hide it. A try that
was not moved is replaced. Of moves that name no try that is only known if the checkpoint is
still where the try began: no row that may have been committed is taken back.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.functions.names import object_path
from tidemark.model import CHECKPOINT_SEPARATOR, ObjectSpec
from tidemark.operators.checkpoint import escaped
from tidemark.tables.events import EventLog

OPEN, SEALED, CLOSED = "open", "sealed", "closed"
EVENTS = T.StructType(
    [
        T.StructField("try_id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("written_to", T.StringType()),
        T.StructField("began_at", T.StringType()),
        T.StructField("checkpoint", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Settled:
    """Tries of earlier runs: (try_id, written_to) to be replaced, and ids to be closed."""

    replaced: list[tuple[str, str]] = field(default_factory=list)
    closed: list[str] = field(default_factory=list)


class Tries:
    """The tries of one object. One run at a time per object is assumed."""

    def __init__(self, spark: SparkSession, root: str, spec: ObjectSpec):
        self.spark = spark
        self.log = EventLog(
            spark, object_path(f"{root}/extract_tries", spec), EVENTS, ("try_id",), f"event = '{CLOSED}'"
        )
        self.began_at = stored_text(spec)

    def read(self) -> DataFrame:
        """Tries that are not closed."""
        return self.log.read()

    def start(self, written_to: str, try_id: str) -> None:
        self.log.note((try_id, OPEN, written_to, self.began_at, None))

    def seal(self, try_id: str, written_to: str, checkpoint: str) -> None:
        self.log.note((try_id, SEALED, written_to, self.began_at, checkpoint))

    def close(self, *try_ids: str) -> None:
        if try_ids:
            self.log.note(*[(t, CLOSED, None, None, None) for t in try_ids])

    def settle(self, moved: set[str] | None) -> Settled:
        """What is left of earlier runs.

        ``moved`` are the ids of tries whose move is stored, None where moves have no ids.
        """
        found = Settled()
        for r in sorted(self.read().collect(), key=lambda r: r.position):
            kept = r.event == SEALED and (r.checkpoint == self.began_at or (moved is None and r.began_at != self.began_at))
            if kept or r.try_id in (moved or ()):
                found.closed.append(r.try_id)
            else:
                found.replaced.append((r.try_id, r.written_to))
        return found


def stored_text(spec: ObjectSpec) -> str | None:
    """The checkpoint an object starts from, as one text."""
    known = [c.value for c in spec.checkpoints]
    return None if not known or None in known else join_checkpoint(known)


def join_checkpoint(values: list[str]) -> str:
    """The stored text of several values, as an extract would store it."""
    return values[0] if len(values) == 1 else CHECKPOINT_SEPARATOR.join(map(escaped, values))


def new_try() -> str:
    return uuid.uuid4().hex[:12]
