"""Shapes shared by every operator: fixed values, table schemas, run identity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import types as T

# Names and words that configuration tables, written files and
# downstream readers already rely on.
HASH = "hash"
RESERVED_RENAME = "src_hash"
INGEST_STAMP = "INGEST_EFF_DTIMEUTC"
SRC = "SRC"
REGION_TAG = "ITB_DB_REGION"
NOT_AVAILABLE = "NA"

BRONZE = "BRONZE"
LANDER = "LANDER"

FULL_EXTRACT = "FULL_EXTRACT"
FULL_EXTRACT_INCR = "FULL_EXTRACT_INCR"
KEY_INCR_EXTRACT = "KEY_INCR_EXTRACT"
EXTRACT_METHODS = (FULL_EXTRACT, FULL_EXTRACT_INCR, KEY_INCR_EXTRACT)

CASSANDRA = "CASSANDRA"
AZURESQL = "AZURESQL"
POSTGRESQL = "POSTGRESQL"
MYSQL = "MYSQL"
MONGODB = "MONGODB"
SOURCE_SYSTEMS = (CASSANDRA, AZURESQL, POSTGRESQL, MYSQL, MONGODB)

STORE_APPEND = "glue_iceberg_parquet_file"
STORE_REPLACE = "glue_iceberg_raw_table"
FLATTEN_LAND = "SNOWFLAKE"

TARGET_PREFIXES = {
    "CASSANDRA": "cs_",
    "POSTGRESQL": "pg_",
    "MYSQL": "ms_",
    "AZURESQL": "sqlsrvr_",
}

MARKET_REGIONS = {
    "us-east-1": ("NA",),
    "eu-west-1": ("NA", "EU"),
    "ap-southeast-2": ("AU",),
}
REGION_PARENT_TABLE = "partners"
REGION_CHILD_TABLES = ("partner_partner_mappings", "partner_id_mappings")
REGION_PARENT_COLUMN = "preference_region"
REGION_PARENT_KEY = "id"
REGION_CHILD_KEY = "partner_id"



@dataclass(frozen=True)
class RegionRule:
    """Which tables are limited to market regions, and by which columns.

    The defaults are those fixed values; another installation gives its own.
    """

    regions: Mapping[str, Sequence[str]] = field(default_factory=lambda: MARKET_REGIONS)
    parent_table: str = REGION_PARENT_TABLE
    child_tables: tuple[str, ...] = REGION_CHILD_TABLES
    column: str = REGION_PARENT_COLUMN
    parent_key: str = REGION_PARENT_KEY
    child_key: str = REGION_CHILD_KEY


FULL_LOAD = "full_load"
INCR_LOAD = "incr_load"
KEY_INCR_LOAD = "key_incr_load"
BACKUP_LOAD = "tmp"

CHECKPOINT_SEPARATOR = "|"
CHECKPOINT_PART_SEPARATOR = "::"

# Text layout of timestamps inside row JSON. Microseconds are kept, so rows that
# differ only below the millisecond still hash differently. A change here must
# raise HASH_VERSION, which makes the next diff start from a first load.
ROW_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
HASH_VERSION = 1


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PIPELINE_CONFIG = _schema(
    ("SOURCE_NAMESPACE", T.StringType()),
    ("SOURCE_TABLE_NAME", T.StringType()),
    ("TARGET_TABLE_NAME", T.StringType()),
    ("LAYER_TYPE", T.StringType()),
    ("SOURCE_SYSTEM", T.StringType()),
    ("EXTRACT_METHOD", T.StringType()),
    ("TARGET_STORE_TYPE", T.StringType()),
    ("PROC_GROUP", T.StringType()),
    ("IS_ACTIVE", T.BooleanType()),
    ("SOURCE_KEY_FIELDS", T.StringType()),
    ("CHECKPOINT_FIELD_DEF", T.StringType()),
    ("CHECKPOINT_TO_VALUE", T.StringType()),
    ("CHECKPOINT_FROM_VALUE", T.StringType()),
    ("FLATTEN_MODE", T.StringType()),
)

FILE_INGEST_LOG = _schema(
    ("FILE_WITH_PATH", T.StringType()),
    ("FILE_MODIFIED_DTIMEUTC", T.TimestampNTZType()),
    ("PROCESSED_FLAG", T.BooleanType()),
    ("FILE_UID", T.StringType()),
    ("BUCKET_NAME", T.StringType()),
    ("FILE_PROCESSED_DTIMEUTC", T.TimestampNTZType()),
    ("TABLE_NAME", T.StringType()),
    ("FILE_ERROR_MSG", T.StringType()),
    ("MAP_SRC_TRGT_OBJECT_UID", T.StringType()),
    ("CREATED_AT_DTIMEUTC", T.TimestampNTZType()),
    ("REPROCESS_FLAG", T.BooleanType()),
)

SNAPSHOT_LOG = _schema(
    ("table_name", T.StringType()),
    ("version", T.LongType()),
    ("snapshot_id", T.LongType()),
    ("parent_id", T.LongType()),
    ("committed_at", T.TimestampNTZType()),
    ("operation", T.StringType()),
    ("run_hour", T.TimestampNTZType()),
    ("slice_key", T.StringType()),
    ("hash_version", T.IntegerType()),
    ("data_schema", T.StringType()),
)

COLUMN_CATALOGUE = _schema(
    ("table_catalog", T.StringType()),
    ("table_schema", T.StringType()),
    ("table_name", T.StringType()),
    ("column_name", T.StringType()),
    ("data_type", T.StringType()),
)


def utc_naive(ts: datetime) -> datetime:
    """The UTC wall clock of ``ts`` without a zone (naive input is taken as UTC)."""
    return ts if ts.tzinfo is None else ts.astimezone(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Run:
    """One ingestion run: a single injected UTC time serves stamps and paths alike.

    ``files`` asks for that many output files per write; without it a write keeps
    the partitioning it already has and needs no shuffle. Of full copies those of the
    ``keep_hours`` latest run hours are kept, with None all of them.
    """

    run_ts: datetime
    root: str
    region: str | None = None
    database: str = "lakehouse"
    files: int | None = None
    max_records_per_file: int = 20_000_000
    keep_hours: int | None = 3
    region_rule: RegionRule = field(default_factory=RegionRule)

    def __post_init__(self):
        object.__setattr__(self, "run_ts", utc_naive(self.run_ts))
        object.__setattr__(self, "root", self.root.rstrip("/"))

    @property
    def hour(self) -> datetime:
        return self.run_ts.replace(minute=0, second=0, microsecond=0)

    @property
    def scheme(self) -> str:
        """``s3a://`` of ``s3a://bucket/x``; empty for a plain path."""
        head, sep, _ = self.root.partition("://")
        return head + sep if sep else ""

    @property
    def bucket(self) -> str:
        return self.root[len(self.scheme):]


@dataclass(frozen=True)
class CheckpointSpec:
    """One ``field::type::operator`` entry with its stored value."""

    field: str
    type: str
    op: str
    value: str | None = None


@dataclass(frozen=True)
class ObjectSpec:
    """Everything a flow needs to know about one configured source object."""

    namespace: str
    source_table: str
    target_table: str
    source_system: str
    extract_method: str
    proc_group: str = ""
    store_type: str = ""
    flatten_mode: str = NOT_AVAILABLE
    lander_from: str = NOT_AVAILABLE
    lander_target: str = NOT_AVAILABLE
    checkpoints: tuple[CheckpointSpec, ...] = field(default=())
    configured_checkpoint: str | None = None
