"""Removing repeated passages: a count-min sketch first, exact grouping of the rest.

A window is a run of consecutive words of one document. First every partition sketches
its windows; the merged sketch overestimates how often a window occurs. To keep it
small, a window is counted through its minimiser: the least-hashed short run of words
(gram) inside it, leftmost among equals. Equal windows have equal minimisers at
different places, so a window that occurs twice has a minimiser that occurs twice:
the estimate is never too low and no repeated window is lost. The second pass hashes
only windows estimated repeated to 96 bits, gathers them by hash range and groups them
exactly. Marks go back to their documents as ranges of words.

Copies within a chunk of one task are settled there, so a passage that a third of all
documents share reaches its owner once per chunk. What is broadcast is the merged sketch,
one bit per counter, at most ``2 * 2**MAX_BITS / 8`` bytes (64 MB). Beyond that size the
sketch fills up and lets more windows through; the result stays the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import row_key, whole_text
from tidemark.session import stage

WINDOW, GRAM = 20, 8
MAX_BITS, MIN_BITS, BLOCK_BITS, ROWS = 28, 16, 16, 2
#: Words that a task holds hashed at once.
CHUNK_WORDS = 300_000
#: Rows without an id come after all others.
NO_ID = 2**63 - 1

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_ENTRY = np.dtype([("hi", "<u8"), ("lo", "<u4"), ("id", "<i8"), ("key", "<i8"), ("pos", "<i4")])
_MARK = np.dtype([("id", "<i8"), ("key", "<i8"), ("pos", "<i4")])


def _mixed(x: np.ndarray, times: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(times)
    return x ^ (x >> np.uint64(29))


def _runs(hashes: np.ndarray, length: int, base: int) -> np.ndarray:
    """A hash of every run of ``length`` words, by a polynomial modulo 2**64."""
    n = len(hashes)
    if n < length:
        return np.zeros(0, np.uint64)
    power, inverse = np.full((2, n), 1, np.uint64)
    power[1:] = np.uint64(base)
    inverse[1:] = np.uint64(pow(base, -1, 1 << 64))
    power, inverse = np.cumprod(power), np.cumprod(inverse)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power, dtype=np.uint64)])
    return _mixed((sums[length:] - sums[:-length]) * inverse[: n - length + 1], _ODD[1])


class _Chunk:
    """Some whole documents in the order of their ids, with their words hashed."""

    def __init__(self, docs: list[tuple[int, int, list[bytes]]], window: int, gram: int):
        docs.sort(key=lambda d: d[0])
        lengths = np.array([len(d[2]) for d in docs], np.int64)
        total = int(lengths.sum())
        self.ids = np.array([d[0] for d in docs], np.int64)
        self.keys = np.array([d[1] for d in docs], np.int64)
        self.first = np.cumsum(lengths) - lengths
        digest = xxhash.xxh3_64_intdigest
        self.hashes = np.fromiter((digest(w) for d in docs for w in d[2]), np.uint64, total)
        self.window, self.gram = window, gram
        own = np.repeat(np.arange(len(docs)), lengths)
        starts = np.arange(max(0, total - window + 1))
        inside = own[: len(starts)] == own[window - 1 :] if len(starts) else np.zeros(0, bool)
        self.starts, self.own = starts[inside], own
        self.grams = _runs(self.hashes, gram, _ODD[0])
        if len(starts):
            views = np.lib.stride_tricks.sliding_window_view(self.grams, window - gram + 1)
            self.least = self.starts + views.argmin(axis=1)[self.starts]
        else:
            self.least = self.starts


def _chunks(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[_Chunk]:
    docs, held = [], 0
    for batch in batches:
        for doc_id, key, body in zip(*[batch.column(c) for c in ("id", "key", "body")]):
            found = body.as_py().split()
            if len(found) < window:
                continue
            docs.append((doc_id.as_py(), key.as_py(), found))
            held += len(found)
            if held >= CHUNK_WORDS:
                yield _Chunk(docs, window, gram)
                docs, held = [], 0
    if docs:
        yield _Chunk(docs, window, gram)


def _slots(grams: np.ndarray, bits: int) -> np.ndarray:
    """Counters of the grams, one row of the sketch after the other."""
    rows = [(_mixed(grams, _ODD[r + 1]) >> np.uint64(64 - bits)) + np.uint64(r << bits) for r in range(ROWS)]
    return np.stack(rows)


def _sketches(batches: Iterator[pa.RecordBatch], window: int, gram: int, bits: int):
    """Counters of each chunk as (block, places, repeated places) of its sketch."""
    for chunk in _chunks(batches, window, gram):
        slots = _slots(chunk.grams[np.unique(chunk.least)], bits).ravel()
        places, counts = np.unique(slots, return_counts=True)
        blocks = (places >> np.uint64(BLOCK_BITS)).astype(np.int64)
        inner = (places & np.uint64((1 << BLOCK_BITS) - 1)).astype("<u2")
        names, at = np.unique(blocks, return_index=True)
        ends = [*at[1:], len(blocks)]
        yield pa.record_batch(
            {
                "block": pa.array(names),
                "places": pa.array([inner[a:b].tobytes() for a, b in zip(at, ends)], pa.binary()),
                "repeated": pa.array(
                    [np.packbits(counts[a:b] > 1).tobytes() for a, b in zip(at, ends)], pa.binary()
                ),
            }
        )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of sketches, block by block (rows come sorted): the counters of two or more."""
    current, counter = None, None

    def close():
        return pa.record_batch(
            {"block": pa.array([current], pa.int64()), "bits": pa.array([np.packbits(counter > 1, bitorder="little").tobytes()], pa.binary())}
        )

    for batch in batches:
        for block, places, repeated in zip(*[c.to_pylist() for c in batch.columns]):
            if block != current:
                if current is not None:
                    yield close()
                current, counter = block, np.zeros(1 << BLOCK_BITS, np.uint8)
            at = np.frombuffer(places, "<u2")
            twice = np.unpackbits(np.frombuffer(repeated, np.uint8))[: len(at)]
            counter[at] = np.minimum(counter[at] + 1 + twice, 2)
    if current is not None:
        yield close()


def repeated_counters(texts: DataFrame, window: int, gram: int) -> tuple[np.ndarray, int]:
    """The merged sketch, a bit per counter (set: two or more), and its bits per row."""
    size = texts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    grams = size / 6 / (window - gram + 2) * 2
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(1, 2 * grams)))))
    parts = texts.mapInArrow(
        lambda b: _sketches(b, window, gram, bits), "block long, places binary, repeated binary"
    )
    merged = stage(
        parts.repartition("block").sortWithinPartitions("block").mapInArrow(_merged, "block long, bits binary"),
        "sketch",
    )
    full = np.zeros((ROWS << bits) // 8, np.uint8)
    width = (1 << BLOCK_BITS) // 8
    for row in merged.toLocalIterator():
        full[row["block"] * width : (row["block"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return full, bits


def _dealt(rows: np.ndarray, bucket: np.ndarray, kind: int) -> pa.RecordBatch:
    """Rows as one block of bytes per bucket, their order kept."""
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    names, at = np.unique(bucket, return_index=True)
    ends = [*at[1:], len(bucket)]
    # Field by field, so that runs of one document compress.
    blobs = [b"".join(rows[f][a:b].tobytes() for f in rows.dtype.names) for a, b in zip(at, ends)]
    return pa.record_batch(
        {
            "kind": pa.array(np.full(len(names), kind, np.int32)),
            "bucket": pa.array(names.astype(np.int64)),
            "rows": pa.array(blobs, pa.binary()),
        }
    )


def _rows(blob: bytes, kind: np.dtype) -> np.ndarray:
    out = np.empty(len(blob) // kind.itemsize, kind)
    at = 0
    for name in kind.names:
        size = kind[name].itemsize * len(out)
        out[name] = np.frombuffer(blob[at : at + size], kind[name])
        at += size
    return out


def _home(ids: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    return _mixed(ids.view(np.uint64) ^ keys.view(np.uint64), _ODD[2]) >> np.uint64(64 - bits)


def _marks(entries: np.ndarray) -> np.ndarray:
    """Entries, sorted, that repeat an earlier one."""
    same = np.zeros(len(entries), bool)
    same[1:] = (entries["hi"][1:] == entries["hi"][:-1]) & (entries["lo"][1:] == entries["lo"][:-1])
    run = np.maximum.accumulate(np.where(same, 0, np.arange(len(entries))))
    first = entries[run]
    later = (entries["id"] > first["id"]) | ((entries["id"] == first["id"]) & (entries["pos"] > first["pos"]))
    return same & later


def _candidates(batches: Iterator[pa.RecordBatch], window: int, gram: int, sketch, bits: int, deal: int, kind: int):
    """Marks settled within a chunk (kind 0), or what other chunks must see (kind 1)."""
    flags = sketch.value
    for chunk in _chunks(batches, window, gram):
        slots = _slots(chunk.grams[chunk.least], bits)
        hit = (flags[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1
        starts = chunk.starts[hit.all(axis=0)]
        if not len(starts):
            continue
        entries = np.empty(len(starts), _ENTRY)
        own = chunk.own[starts]
        entries["hi"] = _runs(chunk.hashes, window, _ODD[0])[starts]
        entries["lo"] = _runs(_mixed(chunk.hashes, _ODD[0]), window, _ODD[2])[starts] >> np.uint64(32)
        entries["id"], entries["key"] = chunk.ids[own], chunk.keys[own]
        entries["pos"] = starts - chunk.first[own]
        order = np.argsort(entries["hi"], kind="stable")
        marked = np.zeros(len(entries), bool)
        marked[order] = _marks(entries[order])
        done, rest = entries[marked], entries[~marked]
        if kind == 0 and len(done):
            marks = np.empty(len(done), _MARK)
            for name in _MARK.names:
                marks[name] = done[name]
            yield _dealt(marks, _home(marks["id"], marks["key"], deal), 0)
        elif kind == 1:
            yield _dealt(rest, rest["hi"] >> np.uint64(64 - deal), 1)


def _gathered(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[np.ndarray]:
    """The rows of one bucket after the other; batches come sorted by bucket."""
    current, parts = None, []
    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("rows").to_pylist()):
            if bucket != current and parts:
                yield np.concatenate(parts)
                parts = []
            current = bucket
            parts.append(_rows(blob, kind))
    if parts:
        yield np.concatenate(parts)


def _exact(batches: Iterator[pa.RecordBatch], deal: int) -> Iterator[pa.RecordBatch]:
    """Groups windows by their whole hash; marks all but the earliest."""
    for entries in _gathered(batches, _ENTRY):
        entries = entries[np.lexsort((entries["pos"], entries["id"], entries["lo"], entries["hi"]))]
        done = entries[_marks(entries)]
        if len(done):
            marks = np.empty(len(done), _MARK)
            for name in _MARK.names:
                marks[name] = done[name]
            marks = marks[np.lexsort((marks["pos"], marks["id"]))]
            yield _dealt(marks, _home(marks["id"], marks["key"], deal), 0)


def _ranges(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Marks to the ranges of removed words of each document."""
    for marks in _gathered(batches, _MARK):
        marks = marks[np.lexsort((marks["pos"], marks["key"], marks["id"]))]
        new_doc = np.ones(len(marks), bool)
        new_doc[1:] = (marks["id"][1:] != marks["id"][:-1]) | (marks["key"][1:] != marks["key"][:-1])
        new_range = new_doc.copy()
        new_range[1:] |= marks["pos"][1:] > marks["pos"][:-1] + window
        at = np.flatnonzero(new_range)
        last = np.append(at[1:], len(marks)) - 1
        pairs = np.stack([marks["pos"][at], marks["pos"][last] + window], axis=1).astype("<i4")
        docs = np.flatnonzero(new_doc)
        cut = np.searchsorted(at, docs)
        ends = [*cut[1:], len(at)]
        yield pa.record_batch(
            {
                "id": pa.array(marks["id"][docs]),
                "key": pa.array(marks["key"][docs]),
                "gone": pa.array([pairs[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()),
            }
        )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(k, 1000) for b in batches for k in range(0, b.num_rows, 1000)):
        counts, removed, texts = [], [], []
        for body, gone in zip(batch.column("body"), batch.column("gone")):
            found, lost = body.as_py().split(), 0
            counts.append(len(found))
            for a, b in np.frombuffer(gone.as_py() or b"", "<i4").reshape(-1, 2)[::-1].tolist():
                del found[a:b]
                lost += b - a
            removed.append(lost)
            texts.append(b" ".join(found))
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
            }
        )


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text), one row per row of ``docs``.

    A word goes if a window over it starts earlier too: in a document with a smaller id,
    or earlier in its own. Null text has no words, null ids come last. Rows of one id count
    as one document: windows at the same place of both are not earlier than each other, so
    rows that repeat id and text both stay. An empty table gives an empty result; other
    columns, whatever their names, are not read. A text of any length is read whole, by one
    task.
    """
    if not 0 < gram <= window:
        raise ValueError("a gram is at most as long as a window")
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"),
        row_key(text).alias("key"),
        whole_text(text).cast("binary").alias("body"),
    )
    flags, bits = repeated_counters(texts, window, gram)
    sketch = spark.sparkContext.broadcast(flags)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    deal = max(3, math.ceil(math.log2(2 * parts)))
    dealt = "kind int, bucket long, rows binary"

    def found(kind):
        # Hashing the texts once more takes less than a stored copy of all candidates.
        return texts.mapInArrow(lambda b: _candidates(b, window, gram, sketch, bits, deal, kind), dealt)

    def by_bucket(df):
        return df.select("bucket", "rows").repartition("bucket").sortWithinPartitions("bucket")

    across = by_bucket(found(1)).mapInArrow(lambda b: _exact(b, deal), dealt)
    marks = by_bucket(found(0).unionAll(across))
    ranges = stage(
        marks.mapInArrow(lambda b: _ranges(b, window), "id long, key long, gone binary"), "repeat-ranges"
    )
    named = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"),
        row_key(text).alias("key"),
        whole_text(text).cast("binary").alias("body"),
    )
    joined = named.join(ranges, ["id", "key"], "left").select("doc_id", "body", "gone")
    return joined.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_text string")
