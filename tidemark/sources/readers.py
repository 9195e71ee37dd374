"""Connector readers and their dispatch by source system and extract method.

Every reader returns a lazy frame; filters are put on top as typed columns, and
Catalyst hands them to the source.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.functions.predicates import bucketed_checkpoint_predicate, checkpoint_predicate
from tidemark.model import (
    CASSANDRA,
    EXTRACT_METHODS,
    FULL_EXTRACT,
    FULL_EXTRACT_INCR,
    KEY_INCR_EXTRACT,
    MONGODB,
    MYSQL,
    SOURCE_SYSTEMS,
    ObjectSpec,
    Run,
)
from tidemark.operators.changes import region_filter, region_semi_filter
from tidemark.operators.transforms import void_to_string, with_region_tag
from tidemark.sources.files import read_documents
from tidemark.sources.ranges import range_predicates, split_points

# Driver classes and connector names as their makers publish them.
JDBC_DRIVERS = {
    "AZURESQL": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "POSTGRESQL": "org.postgresql.Driver",
    "MYSQL": "com.mysql.cj.jdbc.Driver",
}

CONNECTOR_FORMATS = {
    "CASSANDRA": "org.apache.spark.sql.cassandra",
    "MONGODB": "mongodb",
}

Loader = Callable[[SparkSession, ObjectSpec], DataFrame]


@dataclass(frozen=True)
class JdbcSpec:
    """A relational table (or query) and how to cut its read into tasks.

    With ``partition_column`` and its bounds the read runs as ``num_partitions``
    range queries; rows outside the bounds still fall into the first or last one.
    """

    url: str
    table: str | None = None
    query: str | None = None
    driver: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    partition_column: str | None = None
    lower_bound: str | int | None = None
    upper_bound: str | int | None = None
    num_partitions: int | None = None
    fetch_size: int = 10_000
    options: Mapping[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        if (self.table is None) == (self.query is None):
            raise ValueError("give either a table or a query")
        split = (self.partition_column, self.lower_bound, self.upper_bound, self.num_partitions)
        if any(v is not None for v in split) and any(v is None for v in split):
            raise ValueError("a partitioned read needs column, both bounds and a count")
        if self.query is not None and self.partition_column is not None:
            source = {"dbtable": f"({self.query}) sliced"}
        elif self.query is not None:
            source = {"query": self.query}
        else:
            source = {"dbtable": self.table}
        found = {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
            "partitionColumn": self.partition_column,
            "lowerBound": self.lower_bound,
            "upperBound": self.upper_bound,
            "numPartitions": self.num_partitions,
            "fetchsize": self.fetch_size,
            **source,
            **self.options,
        }
        return {k: str(v) for k, v in found.items() if v is not None}


def read_jdbc(spark: SparkSession, spec: JdbcSpec) -> DataFrame:
    return spark.read.format("jdbc").options(**spec.reader_options()).load()


def read_connector(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Any connector on the class path, such as a wide-column or document store."""
    return spark.read.format(fmt).options(**options).load()


def bounded(spark: SparkSession, spec: JdbcSpec) -> JdbcSpec:
    """Ask the source for the bounds of the partition column; one row comes back.

    An empty table is left unsplit.
    """
    whole = replace(spec, partition_column=None, num_partitions=None)
    column = spec.partition_column
    ask = f"SELECT min({column}) AS low, max({column}) AS high FROM {spec.table}"
    low, high = read_jdbc(spark, replace(whole, table=None, query=ask)).first()
    return whole if low is None else replace(spec, lower_bound=low, upper_bound=high)


def read_ranges(spark: SparkSession, spec: JdbcSpec, where: Column | None = None) -> DataFrame:
    """Read a table by one query per range of its partition column, ranges of equal depth.

    The points are quantiles of the slice ``where``, for which one column of it is read.
    """
    plain = replace(spec, partition_column=None, num_partitions=None)
    points = split_points(read_jdbc(spark, plain), spec.partition_column, spec.num_partitions, where)
    options = {k: v for k, v in plain.reader_options().items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(
        spec.url, spec.table, predicates=range_predicates(spec.partition_column, points), properties=options
    )


def jdbc_loader(base: JdbcSpec, splits: Mapping[str, tuple[str, int]] | None = None) -> Loader:
    """Reads ``source_table`` of an object through ``base``.

    ``splits`` names the column and the number of range queries of the tables to
    be read in parallel; a table without an entry is read by one task. The ranges of a
    checkpoint slice are cut by its own quantiles, those of a whole table by its bounds.
    """

    def load(spark: SparkSession, spec: ObjectSpec) -> DataFrame:
        found = replace(
            base,
            table=spec.source_table,
            query=None,
            driver=base.driver or JDBC_DRIVERS.get(spec.source_system.upper()),
        )
        if splits and spec.source_table in splits:
            column, count = splits[spec.source_table]
            if spec.extract_method == KEY_INCR_EXTRACT and spec.checkpoints:
                slice_of = replace(found, partition_column=column, num_partitions=count)
                return read_ranges(spark, slice_of, checkpoint_predicate(spec.checkpoints))
            found = bounded(spark, replace(found, partition_column=column, num_partitions=count))
        return read_jdbc(spark, found)

    return load


#: Sample size that takes in a whole collection.
ALL_DOCUMENTS = 2**31 - 1


def wide_column_loader(fmt: str = CONNECTOR_FORMATS[CASSANDRA], **options: str) -> Loader:
    def load(spark: SparkSession, spec: ObjectSpec) -> DataFrame:
        return read_connector(
            spark, fmt, keyspace=spec.namespace, table=spec.source_table, **options
        )

    return load


def document_loader(
    fmt: str = CONNECTOR_FORMATS[MONGODB], sample_size: int = ALL_DOCUMENTS, **options: str
) -> Loader:
    """Document collections; the schema is inferred over all documents.

    A smaller ``sample_size`` is quicker and loses, without notice, every field that
    only documents outside the sample have.
    """

    def load(spark: SparkSession, spec: ObjectSpec) -> DataFrame:
        return read_connector(
            spark,
            fmt,
            database=spec.namespace,
            collection=spec.source_table,
            sampleSize=str(sample_size),
            **options,
        )

    return load


def json_loader(root: str, sampling_ratio: float = 1.0) -> Loader:
    def load(spark: SparkSession, spec: ObjectSpec) -> DataFrame:
        path = f"{root}/{spec.source_table}"
        return read_documents(spark, path, sampling_ratio)

    return load


def parquet_loader(root: str, suffix: str = ".parquet") -> Loader:
    """Exported Parquet copies of source tables, one path per table."""

    def load(spark: SparkSession, spec: ObjectSpec) -> DataFrame:
        return spark.read.parquet(f"{root}/{spec.source_table}{suffix}")

    return load


def read_source(
    spark: SparkSession, spec: ObjectSpec, loaders: Mapping[str, Loader], run: Run
) -> DataFrame:
    """The slice of one object that its extract method asks for."""
    system, method = spec.source_system.upper(), spec.extract_method
    if system not in SOURCE_SYSTEMS or system not in loaders:
        raise ValueError(f"no reader for source system {spec.source_system!r}")
    if method not in EXTRACT_METHODS:
        raise ValueError(f"unknown extract method {method!r} of {spec.source_table!r}")
    if system == MONGODB and method == KEY_INCR_EXTRACT:
        raise ValueError("document collections have no checkpoint read")
    rows = loaders[system](spark, spec)
    if method == KEY_INCR_EXTRACT:
        build = bucketed_checkpoint_predicate if system == CASSANDRA else checkpoint_predicate
        return rows.where(build(spec.checkpoints))
    if system == MONGODB:
        return with_region_tag(void_to_string(rows), spec.target_table)
    if system == MYSQL and method in (FULL_EXTRACT, FULL_EXTRACT_INCR):
        return _served_region(spark, spec, rows, loaders[system], run)
    return rows


def _served_region(
    spark: SparkSession, spec: ObjectSpec, rows: DataFrame, load: Loader, run: Run
) -> DataFrame:
    """Partner tables are limited to the market regions served from the run's region."""
    rule = run.region_rule
    if spec.source_table == rule.parent_table:
        return region_filter(rows, rule.column, run.region, rule.regions)
    if spec.source_table in rule.child_tables:
        parents = load(spark, replace(spec, source_table=rule.parent_table))
        return region_semi_filter(
            rows,
            parents,
            rule.child_key,
            rule.parent_key,
            rule.column,
            run.region,
            rule.regions,
        )
    return rows
