"""Exact duplicates through an extendible-hash index on shared files.

Every text has a 64-bit hash. A directory maps leading hash bits to buckets: it is
doubled until the buckets hold at most ``capacity`` keys, and a bucket that is still
overfull doubles on its own. Index entries (hash, text, largest id, count) are written
to the shared folder, one per text and input batch, so copies are gathered before
anything is shuffled. Owner tasks each take a range of buckets, chain the entries of
one hash and compare bytes along the chain.

Only texts whose hash occurs more than once become entries. They are found with a
bitmap of a bounded size; a false hit costs one entry and changes no result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.text import keep_rows, single_rows, whole_text
from tidemark.session import stage

#: Keys in a bucket before it is split.
CAPACITY = 4096
#: The bitmap that is sent to all tasks has at most 2**MAX_BITS bits (32 MB).
MAX_BITS = 28
BLOCK_BITS = 15


def _cell(depth: int) -> Column:
    """The bucket of a hash in a directory of ``depth`` bits."""
    return F.shiftrightunsigned("h", 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, n_keys: int, capacity: int) -> tuple[int, DataFrame | None]:
    """Depth of the directory over distinct hashes ``h``, and the deeper cells.

    The second value lists (cell, depth) of cells that had to be split further; it is
    None when the common depth is enough. The driver sees counts only.
    """
    depth = max(0, math.ceil(math.log2(max(1, 2 * n_keys / capacity))))
    sized = keys.select("h", _cell(depth).alias("cell"))
    over = sized.groupBy("cell").count().where(F.col("count") > capacity)
    pending, deeper, level = stage(over.select("cell"), "overfull"), None, depth
    while level < 64 and not pending.isEmpty():
        level += 1
        split = sized.join(pending, "cell", "left_semi").groupBy("cell", _cell(level).alias("part"))
        again = split.count().where(F.col("count") > capacity).select("cell").distinct()
        still = stage(again, "overfull")
        done = pending.join(still, "cell", "left_anti").withColumn("depth", F.lit(level))
        deeper = done if deeper is None else deeper.unionAll(done)
        pending = still
    return depth, deeper


def _with_bucket(entries: DataFrame, depth: int, deeper: DataFrame | None) -> DataFrame:
    """The first hash of each entry's bucket, in unsigned order, as ``bucket``."""
    low = F.lit(-(2**63)).cast("long")  # turns unsigned order into signed order
    if deeper is None:
        level = F.lit(depth)
    else:
        entries = entries.withColumn("cell", _cell(depth)).join(deeper, "cell", "left")
        level = F.coalesce("depth", F.lit(depth))
    mask = F.when(level == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftleft", F.lit(-1).cast("long"), F.lit(64) - level)
    )
    bucket = F.col("h").bitwiseAND(mask).bitwiseXOR(low)
    return entries.withColumn("bucket", bucket).select("bucket", "h", "body", "top", "n", "n_top")


def _bitmap(keys: DataFrame, n_keys: int) -> np.ndarray:
    """Bits set for the hashes of ``keys``; the size is bounded by MAX_BITS."""
    bits = min(MAX_BITS, max(BLOCK_BITS, math.ceil(math.log2(max(1, n_keys) * 16))))
    slot = F.col("h").bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    block = F.shiftright(slot, BLOCK_BITS)
    inner = slot.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long"))
    blocks = keys.select(block.alias("block"), inner.alias("inner")).groupBy("block")
    full = np.zeros(1 << bits, dtype=bool)
    for row in blocks.agg(F.bitmap_construct_agg("inner").alias("bits")).toLocalIterator():
        part = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8), bitorder="little")
        start = row["block"] << BLOCK_BITS
        full[start : start + (1 << BLOCK_BITS)] = part[: 1 << BLOCK_BITS]
    return np.packbits(full, bitorder="little")


def _entries(batches: Iterator[pa.RecordBatch], bitmap) -> Iterator[pa.RecordBatch]:
    """One entry per distinct text of a batch whose hash may repeat."""
    bits = bitmap.value
    mask = np.uint64(len(bits) * 8 - 1)
    for batch in batches:
        h = batch.column("h").to_numpy()
        slot = h.view(np.uint64) & mask
        hit = (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
        table = pa.Table.from_batches([batch]).filter(pa.array(hit.astype(bool)))
        if not table.num_rows:
            continue
        # Nulls sort below every id, and a group of nulls keeps null.
        groups = table.group_by(["h", "body"]).aggregate([("doc_id", "max"), ("doc_id", "count")])
        by_id = table.group_by(["h", "body", "doc_id"]).aggregate([([], "count_all")])
        tops = groups.join(
            by_id.filter(pc.is_valid(by_id["doc_id"])),
            keys=["h", "body", "doc_id_max"],
            right_keys=["h", "body", "doc_id"],
        )
        all_rows = table.group_by(["h", "body"]).aggregate([([], "count_all")])
        tops = tops.join(all_rows, keys=["h", "body"], right_suffix="_rows")
        n_rows = tops["count_all_rows"]
        n_top = pc.if_else(pc.is_valid(tops["doc_id_max"]), tops["count_all"], n_rows)
        yield pa.record_batch(
            {
                "h": tops["h"].combine_chunks(),
                "body": tops["body"].combine_chunks().cast(pa.binary()),
                "top": tops["doc_id_max"].combine_chunks(),
                "n": n_rows.combine_chunks().cast(pa.int64()),
                "n_top": pc.cast(n_top, pa.int64()).combine_chunks(),
            }
        ) if tops.num_rows else None


def _merge(chain: list[list], body: bytes, top: int | None, n: int, n_top: int) -> None:
    """Add an entry to the chain of its hash; equal bytes fall together."""
    for link in chain:
        if link[0] == body:
            if top == link[1]:
                link[3] += n_top
            elif link[1] is None or (top is not None and top > link[1]):
                link[1], link[3] = top, n_top
            link[2] += n
            return
    chain.append([body, top, n, n_top])


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by hash to one row per distinct text; one chain in memory."""
    schema = pa.schema(
        [("h", pa.int64()), ("sha", pa.string()), ("top", pa.int64()), ("n", pa.int64()),
         ("n_top", pa.int64()), ("chain", pa.int32())]
    )
    current, chain, out = None, [], []

    def close():
        for k, (body, top, n, n_top) in enumerate(chain):
            out.append((current, hashlib.sha256(body).hexdigest(), top, n, n_top, k))

    def flush():
        columns = list(zip(*out))
        batch = pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types)], schema)
        out.clear()
        return batch

    for batch in batches:
        for h, *entry in zip(*[batch.column(c).to_pylist() for c in ("h", "body", "top", "n", "n_top")]):
            if h != current:
                close()
                current, chain = h, []
            _merge(chain, *entry)
        if len(out) > 5000:
            yield flush()
    close()
    if out:
        yield flush()


def exact_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, key), one row per row of ``docs``.

    The row with the largest id of a group stays; null ids come below all others. Of
    rows that repeat both id and text one stays. Null text counts as empty, empty texts
    are copies of each other. An empty table gives an empty result; other columns of
    ``docs``, whatever their names, are not read. ``key`` is ``row_key`` of the text.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("body"))
    hashed = source.withColumn("h", F.xxhash64("body"))
    rows = stage(
        hashed.select(
            "doc_id", "h", F.sha2("body", 256).alias("sha"), F.monotonically_increasing_id().alias("rid")
        ),
        "exact-rows",
    )
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    repeated = stage(counts.where("n > 1").select("h"), "exact-keys")
    n_keys = repeated.count()
    depth, deeper = directory(repeated, n_keys, capacity)
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(repeated, n_keys))
    entries = hashed.select("h", "doc_id", "body").mapInArrow(
        lambda batches: (b for b in _entries(batches, bitmap) if b is not None),
        "h long, body binary, top long, n long, n_top long",
    )
    index = stage(_with_bucket(entries, depth, deeper), "exact-index")
    owners = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owned = index.repartitionByRange(owners, "bucket").sortWithinPartitions("bucket", "h")
    chained = owned.select("h", "body", "top", "n", "n_top").mapInArrow(
        _chains, "h long, sha string, top long, n long, n_top long, chain int"
    )
    groups = stage(chained, "exact-groups")
    joined = rows.join(groups, ["h", "sha"], "left").withColumns(
        {
            "keep_id": F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("top")),
            "group_size": F.coalesce("n", F.lit(1).cast("long")),
            "is_top": F.col("n").isNull() | F.col("doc_id").eqNullSafe(F.col("top")),
        }
    )
    kept = F.col("is_top")
    if not groups.where("n_top > 1").isEmpty():
        ties = joined.where("is_top AND n_top > 1").groupBy("h", "sha")
        winners = ties.agg(F.max("rid").alias("winner"))
        joined = joined.join(winners, ["h", "sha"], "left")
        kept = kept & (F.col("winner").isNull() | (F.col("winner") == F.col("rid")))
    return joined.select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"),
        F.col("sha").alias("text_sha256"), F.col("h").alias("key"),
    )


def drop_exact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` without exact copies; all columns as they were.

    Null text is an empty text. Of rows that repeat id and text one stays; a null id stays
    only where all copies have none. An empty table gives an empty result.
    """
    groups = stage(exact_groups(docs, doc_id, text), "exact-decisions")
    lost = groups.where("NOT kept AND NOT doc_id <=> keep_id")
    rest = keep_rows(docs, lost, doc_id, text)
    twins = groups.where("NOT kept AND doc_id <=> keep_id").select("doc_id", "key").distinct()
    return single_rows(rest, stage(twins, "exact-twins"), doc_id, text)
