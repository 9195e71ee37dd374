"""Indexes of row hashes: bucketed, sorted tables, one per snapshot.

An index holds each hash of a snapshot once, in buckets by hash. Rows are counted together
before they are shuffled, so a row with very many copies is one entry like any other, and
the shuffle that counts them deals them into the buckets at once. Hashes are hexadecimal
text, which Zstandard halves and Snappy doesn't. Two indexes of one table are bucketed alike, and comparing them moves nothing. Bucket numbers
are powers of two that follow the number of rows; when a table has outgrown its number, the
next comparison deals out the older, smaller index once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.model import HASH
from tidemark.session import shuffle_partitions
from tidemark.sources.files import delete_folder, folder_names

#: Hashes a bucket is meant to hold, a hundred megabytes or so.
BUCKET_ROWS = 4_000_000


class HashIndexes:
    """The indexes of one table's snapshots, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.path, self.bucket_rows = spark, path.rstrip("/"), bucket_rows

    def _folder(self, snapshot_id: int) -> str:
        return f"{self.path}/snapshot_id={snapshot_id}"

    def buckets(self, rows: int) -> int:
        most = int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        needed = 1 << max(0, (max(rows, 1) - 1) // self.bucket_rows).bit_length()
        while needed > most:
            needed //= 2
        return needed

    def write(self, snapshot: DataFrame, snapshot_id: int, rows: int) -> None:
        """Index a snapshot of about ``rows`` rows; a repeat replaces what it left."""
        buckets, name = self.buckets(rows), f"tidemark_index_{uuid.uuid4().hex}"
        delete_folder(self.spark, self._folder(snapshot_id))
        counted = snapshot.groupBy(HASH).agg(F.count(F.lit(1)).alias("copies"))
        writer = counted.repartition(buckets, HASH).write.bucketBy(buckets, HASH).sortBy(HASH).option("compression", "zstd")
        # Counted in as many partitions, they lie as ``repartition`` wants them, and Spark drops it.
        with shuffle_partitions(self.spark, buckets):
            writer.option("path", f"{self._folder(snapshot_id)}/buckets={buckets}").saveAsTable(name)
        # The files are the index; the catalog entry is only needed to write buckets.
        self.spark.sql(f"DROP TABLE {name}")

    def _buckets_of(self, snapshot_id: int) -> int | None:
        names = folder_names(self.spark, self._folder(snapshot_id))
        found = [int(n.partition("=")[2]) for n in names if n.startswith("buckets=")]
        written = [n for n in found if "_SUCCESS" in folder_names(self.spark, f"{self._folder(snapshot_id)}/buckets={n}")]
        return written[0] if written else None

    def has(self, snapshot_id: int) -> bool:
        return self._buckets_of(snapshot_id) is not None

    def read(self, snapshot_id: int) -> DataFrame:
        """(hash, copies) of a snapshot, known to be bucketed and sorted by hash."""
        buckets, name = self._buckets_of(snapshot_id), f"tidemark_index_{uuid.uuid4().hex}"
        if buckets is None:
            raise ValueError(f"snapshot {snapshot_id} has no index")
        place = f"{self._folder(snapshot_id)}/buckets={buckets}".replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {name} ({HASH} STRING, copies BIGINT) USING parquet "
            f"CLUSTERED BY ({HASH}) SORTED BY ({HASH}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        found = self.spark.table(name)
        found.schema  # resolved now: the plan keeps files and buckets, not the name
        self.spark.sql(f"DROP TABLE {name}")
        return found

    def new_hashes(self, snapshot_id: int, base_id: int) -> DataFrame:
        """Hashes of one snapshot that another lacks, each once; no exchange takes place."""
        return self.read(snapshot_id).select(HASH).join(self.read(base_id).select(HASH).hint("merge"), HASH, "left_anti")

    def retire(self, kept: set[int]) -> None:
        """Delete the indexes of all other snapshots."""
        for name in folder_names(self.spark, self.path):
            if name.startswith("snapshot_id=") and int(name.partition("=")[2]) not in kept:
                delete_folder(self.spark, f"{self.path}/{name}")
