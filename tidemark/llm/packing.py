"""Best-two-fit packing of tokenised documents into sequences of bounded length.

A sequence is filled greedily, each time with the longest piece that fits. Then, if it
holds several pieces, its shortest one is replaced by the two unpacked pieces that fill
the gap so widened most, if they fill it better than the one did.

What is done next depends only on which lengths are left, so the plan is made from the
number of pieces of each length: a filled sequence is a pattern of lengths, and is repeated
for as long as the pieces of all its lengths last. That is what packing piece after piece
over the whole table gives, and the plan has as many rows as patterns, not documents. Tasks
number the pieces of each length as they encode them; with the counts of the tasks before,
a piece knows its place among those of its length, and from the plan its sequence.
"""

from __future__ import annotations

import base64
import bisect
import functools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.text import whole_text
from tidemark.session import stage

ROOM, END = 1024, 2
_PIECES = "doc_id long, rid long, piece int, start long, length long, ids_crc32 long, task int, nth long"
_PLACED = "doc_id long, rid long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut(n_tokens: int, room: int = ROOM) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be shorter than ``room``."""
    if n_tokens <= room:
        return [(0, n_tokens)]
    first = n_tokens % room or room
    return [(0, first)] + [(at, room) for at in range(first, n_tokens, room)]


class _Lengths:
    """Which lengths are left, in order, and how many of each."""

    def __init__(self, counts: dict[int, int]):
        self.left = {n: k for n, k in counts.items() if k}
        self.order = sorted(self.left)

    def take(self, length: int, n: int = 1) -> None:
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            del self.order[bisect.bisect_left(self.order, length)]

    def give(self, length: int, n: int = 1) -> None:
        if length not in self.left:
            self.left[length] = 0
            bisect.insort(self.order, length)
        self.left[length] += n

    def longest(self, room: int) -> int | None:
        """The longest length left that fits."""
        at = bisect.bisect_right(self.order, room)
        return self.order[at - 1] if at else None

    def best_two(self, room: int) -> tuple[int, int] | None:
        """Two pieces left that fill most of ``room``; of equal sums the one with the longest piece."""
        order, low, best = self.order, 0, None
        high = bisect.bisect_right(order, room) - 1
        while low <= high:
            total = order[low] + order[high]
            if total > room or (low == high and self.left[order[low]] < 2):
                high -= 1
                continue
            if best is None or total > sum(best):
                best = (order[high], order[low])
            low += 1
        return best


def _filled(left: _Lengths, room: int) -> tuple[Counter, Counter]:
    """Lengths of one sequence, taken from ``left``, and those it held at any time."""
    pattern, gap = Counter(), room
    while (length := left.longest(gap)) is not None:
        n = min(gap // length, left.left[length])
        left.take(length, n)
        pattern[length] += n
        gap -= n * length
    shortest, held = min(pattern), Counter(pattern)
    if gap and pattern.total() > 1:
        two = left.best_two(gap + shortest)
        if two and sum(two) > shortest:
            left.give(shortest)
            pattern[shortest] -= 1
            for length in two:
                left.take(length)
                pattern[length] += 1
    return +pattern, held | pattern


def plan_sequences(counts: dict[int, int], room: int = ROOM) -> list[tuple[int, dict[int, int]]]:
    """(number of sequences, {length: pieces in each}) in the order of filling.

    ``counts`` says how many pieces there are of each length from 1 to ``room``.
    """
    left, plan = _Lengths(counts), []
    while left.order:
        pattern, held = _filled(left, room)
        # Once more for as long as all that was held before can be held again.
        more = min((left.left.get(k, 0) - held[k]) // n + 1 for k, n in pattern.items())
        more = max(0, more)
        for length, n in pattern.items() if more else ():
            left.take(length, more * n)
        plan.append((1 + more, dict(pattern)))
    return plan


class Places:
    """Sequence and offset of the nth piece of a length, looked up in the plan."""

    def __init__(self, plan: list[tuple[int, dict[int, int]]]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        used, sequence = Counter(), 0
        for times, pattern in plan:
            offset = 0
            for length in sorted(pattern, reverse=True):
                n = pattern[length]
                rows.setdefault(length, []).append((used[length], n, sequence, offset))
                used[length] += n * times
                offset += n * length
            sequence += times
        self.rows = {length: np.array(found, np.int64).T for length, found in rows.items()}

    def of(self, lengths: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequences, offsets = np.empty(len(nth), np.int64), np.empty(len(nth), np.int64)
        for length in np.unique(lengths):
            here = lengths == length
            first, per, sequence, offset = self.rows[int(length)]
            at = np.searchsorted(first, nth[here], "right") - 1
            bins, slot = np.divmod(nth[here] - first[at], per[at])
            sequences[here] = sequence[at] + bins
            offsets[here] = offset[at] + slot * length
        return sequences, offsets


@functools.lru_cache(maxsize=2)
def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The vocabulary in a file of tokens and ranks, given as its bytes."""
    by_token = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=by_token, special_tokens={})


def _encoded(batches: Iterator[pa.RecordBatch], ranks, pattern, room, end) -> Iterator[pa.RecordBatch]:
    coder, task, seen = encoding(ranks.value, pattern), TaskContext.get().partitionId(), Counter()
    for batch in batches:
        rows = []
        for doc_id, rid, body in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "rid", "body"))):
            ids = np.array([*coder.encode_ordinary(body), end], "<u4")
            for piece, (start, length) in enumerate(cut(len(ids), room)):
                crc = zlib.crc32(ids[start : start + length].tobytes())
                rows.append((doc_id, rid, piece, start, length, crc, task, seen[length]))
                seen[length] += 1
        types = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
        columns = zip(*rows) if rows else [()] * len(types)
        names = [field.split()[0] for field in _PIECES.split(", ")]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _placed(batches: Iterator[pa.RecordBatch], places) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nth = batch.column("nth").to_numpy() + batch.column("before").to_numpy()
        sequences, offsets = places.value.of(batch.column("length").to_numpy(), nth)
        kept = [batch.column(c) for c in ("doc_id", "rid", "piece", "start", "length", "ids_crc32")]
        names = [field.split()[0] for field in _PLACED.split(", ")]
        yield pa.record_batch([*kept, pa.array(sequences), pa.array(offsets)], names=names)


def token_pieces(
    docs: DataFrame, ranks_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text", room: int = ROOM, end: int = END
) -> DataFrame:
    """(doc_id, rid, piece, start, length, ids_crc32, task, nth) of the pieces of every text.

    A text is its ids and then the id ``end``. ``rid`` numbers the rows, ``nth`` the pieces
    of one length within a task.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"), whole_text(text).alias("body")
    )
    with open(ranks_file, "rb") as ranks_bytes:  # under a megabyte for 50,000 tokens
        ranks = docs.sparkSession.sparkContext.broadcast(ranks_bytes.read())
    return rows.mapInArrow(lambda b: _encoded(b, ranks, pattern, room, end), _PIECES)


def pack(
    docs: DataFrame, ranks_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text", room: int = ROOM, end: int = END
) -> DataFrame:
    """(doc_id, rid, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Strings of special tokens within a text are ordinary text. Null text counts as empty: a piece of one
    token, ``end``. Null and repeated ids and repeated rows are packed row by row; ``rid``
    tells their pieces apart. A text of any length is cut whole into pieces of ``room``
    tokens behind one that may be shorter. An empty table gives no pieces. Other columns
    are not read. At most ``room`` counts reach the driver; the plan is at most a few rows
    for each length and token of a sequence, whatever the input.
    """
    pieces = stage(token_pieces(docs, ranks_file, pattern, doc_id, text, room, end), "packing-pieces")
    # Numbers of a task run without a gap, so the last one gives the count.
    counts = stage(pieces.groupBy("task", "length").agg((F.max("nth") + 1).alias("n")), "packing-counts")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(Places(plan_sequences(totals, room)))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(before, ["task", "length"])
    return numbered.mapInArrow(lambda b: _placed(b, places), _PLACED)
