"""Landing as a stream: every new bronze file is landed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.model import SRC
from tidemark.operators.transforms import drop_technical, to_src
from tidemark.sources.files import path_exists


def land_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    max_files_per_batch: int = 10_000,
):
    """Land what has arrived below ``path`` since the last call, then stop.

    The stream's checkpoint remembers which files were taken, and Spark's file sink
    lists what each batch wrote, so a batch that is repeated after a failure counts
    once. The two belong together: a target that is filled already is refused for a
    checkpoint that is new. Files are told by name: a bronze hour that is rewritten
    brings new files, which are landed as well; use ``land_pending`` for such tables.
    """
    if path_exists(spark, f"{target}/_spark_metadata") and not path_exists(spark, f"{checkpoint}/commits"):
        raise ValueError(f"{target!r} was filled by a stream with another checkpoint")
    files = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files_per_batch)
        .parquet(path)
    )
    return (
        to_src(drop_technical(files))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """Rows of finished batches: the sink's own list of files is followed."""
    return spark.read.schema(f"{SRC} string").parquet(target)
