"""Near duplicates by SimHash, with anchor points of a covering code.

The 64 bits of a fingerprint fall into blocks of 23, 23 and 18 bits. For the first two
the anchors are the 4096 words of the perfect binary Golay code: every block lies within
three bits (the covering radius) of exactly one anchor, its home. A fingerprint is copied
to every anchor within radius plus one. For the last block the code is the whole space
(radius 0), so a block is its own anchor. Two fingerprints that differ in four bits or
fewer differ by at most one bit in block one, or at most one in block two, or not at all
in block three; in that block the copy of one meets the other at its home anchor.

Members of an anchor are compared in tiles and joined to classes there, so an anchor
gives fewer links than it has members. Anchors with very many members are dealt out as
pairs of chunks. Equal fingerprints are one node throughout.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import keep_rows, row_key, single_rows, whole_text
from tidemark.session import stage

SHINGLE, SEED, MAX_BITS = 4, 42, 4
BLOCKS = ((0, 23), (23, 23), (46, 18))
#: Members of an anchor that one task compares at once.
CHUNK = 20_000
_TILE = 1 << 20
#: Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
_GOLAY = 0b101011100011


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text; 0 without words."""
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(itertools.accumulate(len(w) + 1 for w in found))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :])),
        np.uint64,
        len(found) - shingle + 1,
    )
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        piece = hashes[part : part + (1 << 16)]
        ones += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _prints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    # Arrow's own pool keeps the room of the largest batches for as long as a worker lives.
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        bodies = batch.column("body")
        prints = np.fromiter((fingerprint(b.as_py(), shingle) for b in bodies), np.uint64, len(bodies))
        yield pa.record_batch(
            {"doc_id": batch.column("doc_id"), "key": batch.column("key"), "print": pa.array(prints.view(np.int64))}
        )


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE):
    """(doc_id, key, print): the fingerprint of each whole text as a long."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        row_key(text).alias("key"),
        whole_text(text).cast("binary").alias("body"),
    )
    return rows.mapInArrow(lambda b: _prints(b, shingle), "doc_id long, key long, print long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where((rest >> bit) & 1, rest ^ (_GOLAY << (bit - 11)), rest)
    return rest


def _patterns() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the way home, and the ways to all further anchors within four bits.

    The second array has five columns; -1 marks no such anchor.
    """

    def of_weight(k):
        return np.array([sum(1 << i for i in c) for c in itertools.combinations(range(23), k)])

    home = np.zeros(2048, np.int64)
    for k in range(4):
        found = of_weight(k)
        home[_syndromes(found)] = found
    further = np.full((2048, 5), -1, np.int64)
    used = np.zeros(2048, np.int64)
    for pattern, s in zip(fours := of_weight(4), _syndromes(fours)):
        further[s, used[s]] = pattern
        used[s] += 1
    return home, further


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint at its home anchors and at the anchors around them."""
    home, further = _patterns()
    for batch in batches:
        prints = batch.column("print").to_numpy()
        bits = prints.view(np.uint64)
        for block, (start, width) in enumerate(BLOCKS):
            part = ((bits >> np.uint64(start)) & np.uint64((1 << width) - 1)).astype(np.int64)
            if width == 23:
                s = _syndromes(part)
                ways = [home[s], *further[s].T]
            else:
                ways = [np.zeros(len(part), np.int64)]
            for k, way in enumerate(ways):
                at = way >= 0
                n = int(at.sum())
                yield pa.record_batch(
                    {
                        "anchor": pa.array((part[at] ^ way[at]) * len(BLOCKS) + block),
                        "print": pa.array(prints[at]),
                        "home": pa.array(np.full(n, k == 0)),
                    }
                )


def _join_members(prints: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold the classes of one anchor together: a member and its class's least."""
    labels = np.arange(len(prints))
    homes = np.flatnonzero(home)
    step = max(1, _TILE // max(1, len(prints)))
    for at in range(0, len(homes), step):
        rows = homes[at : at + step]
        near = np.bitwise_count(prints[rows, None] ^ prints[None, :]) <= max_bits
        for k in np.flatnonzero(near.sum(1) > 1):
            classes = np.unique(labels[near[k]])
            if len(classes) > 1:
                labels[np.isin(labels, classes)] = classes[0]
    moved = np.flatnonzero(labels != np.arange(len(prints)))
    return prints[moved], prints[labels[moved]]


def _compared(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor and chunks to links; one anchor (or pair of chunks) in memory."""

    def links(table: pa.Table) -> pa.RecordBatch:
        columns = [table[c].to_numpy() for c in ("anchor", "i", "j")]
        prints, home = table["print"].to_numpy().view(np.uint64), table["home"].to_numpy()
        change = np.zeros(len(prints), bool)
        change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        bounds = np.concatenate([[0], np.flatnonzero(change), [len(prints)]])
        found = [
            _join_members(prints[a:b], home[a:b], max_bits)
            for a, b in zip(bounds[:-1], bounds[1:])
            if b - a > 1
        ]
        a, b = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.uint64)]) for k in (0, 1))
        return pa.record_batch({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.zeros(batch.num_rows, bool)
        for c in ("anchor", "i", "j"):
            v = batch.column(c).to_numpy()
            ends |= v != v[-1]
        tail = int(ends.sum())  # sorted: rows before the last key
        if rest and any(rest[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in ("anchor", "i", "j")):
            yield links(pa.Table.from_batches(rest))
            rest = []
        if tail:
            yield links(pa.Table.from_batches([*rest, batch.slice(0, tail)]))
            rest = []
        rest.append(batch.slice(tail))
    if rest:
        yield links(pa.Table.from_batches(rest))


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that connect all distinct ``print`` values at ``max_bits`` bits or fewer."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the anchors cover differences of up to four bits")
    copies = stage(prints.mapInArrow(_anchored, "anchor long, print long, home boolean"), "anchors")
    hot = stage(copies.groupBy("anchor").count().where(F.col("count") > chunk), "hot-anchors")
    zero = F.lit(0).cast("long")
    if hot.isEmpty():
        dealt = copies.withColumns({"i": zero, "j": zero})
    else:
        parts = F.coalesce(F.ceil(F.col("count") / chunk), F.lit(1)).cast("long")
        own = F.pmod(F.xxhash64("print"), "parts")
        pairs = copies.join(hot, "anchor", "left").withColumn("parts", parts).withColumn("own", own)
        every = F.explode(F.sequence(zero, F.col("parts") - 1))
        split = pairs.where("parts > 1")
        # Each home row meets every chunk, each copy (a home row too) every home chunk.
        as_home = split.where("home").withColumn("j", every).withColumn("i", F.col("own"))
        as_copy = split.withColumn("i", every).withColumn("j", F.col("own")).withColumn("home", F.lit(False))
        names = ["anchor", "print", "home", "i", "j"]
        single = pairs.where("parts = 1").withColumns({"i": zero, "j": zero})
        dealt = single.select(names).unionAll(as_home.select(names)).unionAll(as_copy.select(names))
    return (
        dealt.repartition("anchor", "i", "j")
        .sortWithinPartitions("anchor", "i", "j")
        .select("anchor", "i", "j", "print", "home")
        .mapInArrow(lambda b: _compared(b, max_bits), "a long, b long")
    )


def classes(links: DataFrame) -> DataFrame:
    """(node, least): the least node reachable from each node of the links (a, b).

    Alternating stars: every node is tied to the least node it knows, first among larger
    neighbours, then among smaller ones, until nothing moves. Each round is a stored table.
    """
    edges = stage(links.where("a <> b").select("a", "b").distinct(), "links")
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.join(least, "a").where("b > a AND b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("least"))
        near = down.join(low, "a")
        small = near.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        tied = low.select("a", F.col("least").alias("b"))
        edges = stage(small.unionAll(tied).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("least"))
        seen = now


def near_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    chunk: int = CHUNK,
) -> DataFrame:
    """(doc_id, print, component_id, first_key, key), one row per row of ``docs``.

    ``component_id`` is the least id reachable over links of at most ``max_bits`` bits,
    ``first_key`` the ``row_key`` of its row. Null text counts as empty; texts without
    words have fingerprint 0 and are linked like others. Null ids are larger than all
    others. Repeated rows share a group. An empty table gives an empty result; other
    columns, whatever their names, are not read.
    """
    prints = stage(fingerprints(docs, doc_id, text, shingle), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")).alias("first")
    nodes = stage(prints.groupBy("print").agg(first), "print-nodes")
    tied = classes(near_links(nodes.select("print"), max_bits, chunk))
    rooted = nodes.join(tied, nodes["print"] == tied["node"], "left").select(
        "print", "first", F.coalesce("least", "print").alias("root")
    )
    rooted = stage(rooted, "print-roots")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("of"))
    named = rooted.select("print", "root").join(firsts, "root").select("print", "of")
    return prints.join(named, "print").select(
        "doc_id", "print", F.col("of.doc_id").alias("component_id"), F.col("of.key").alias("first_key"), "key"
    )


def keep_firsts(docs: DataFrame, groups: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each group of the stored table ``groups``: that with the least id."""
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("key") == F.col("first_key"))
    rest = keep_rows(docs, groups.where(~stays), doc_id, text)
    twins = groups.where(stays).groupBy("doc_id", "key").count().where("count > 1")
    return single_rows(rest, stage(twins.select("doc_id", "key"), "near-twins"), doc_id, text)


def drop_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, one of each group: that with the least id. Columns as they were.

    Null and empty texts have fingerprint zero. Of rows that repeat id and text one stays. An
    empty table gives an empty result.
    """
    return keep_firsts(docs, stage(near_groups(docs, doc_id, text), "near-decisions"), doc_id, text)
