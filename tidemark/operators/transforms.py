"""Row-wise operators: pure projections, no shuffle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.rows import ntz, ref, row_hash, row_json, utc_wall_clock
from tidemark.model import HASH, INGEST_STAMP, REGION_TAG, RESERVED_RENAME, SRC, utc_naive


def with_row_hash(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Add ``hash``: the md5 of the row's canonical JSON text."""
    columns = [c for c in df.columns if c not in exclude]
    return df.withColumn(HASH, row_hash(columns, df.schema))


def with_src_json(df: DataFrame) -> DataFrame:
    """Add ``SRC``, the whole row as JSON, beside the columns."""
    return df.withColumn(SRC, row_json(df.columns))


def to_src(df: DataFrame) -> DataFrame:
    """Only ``SRC``, the whole row as JSON."""
    return df.select(row_json(df.columns).alias(SRC))


def drop_technical(df: DataFrame) -> DataFrame:
    """Drop the row hash before rows leave the bronze layer."""
    return df.drop(HASH)


def rename_reserved(df: DataFrame) -> DataFrame:
    """Free the name ``hash``: the first source column so called, in any case."""
    taken = [c for c in df.columns if c.lower() == HASH]
    if not taken:
        return df
    if any(c.lower() == RESERVED_RENAME for c in df.columns):
        raise ValueError(f"cannot rename {taken[0]!r}: {RESERVED_RENAME!r} exists already")
    position = df.columns.index(taken[0])
    return df.toDF(*[RESERVED_RENAME if i == position else c for i, c in enumerate(df.columns)])


def with_ingest_ts(df: DataFrame, run_ts: datetime, truncate: bool = True) -> DataFrame:
    """Stamp every row with the run's UTC time, cut to the hour by default."""
    stamp = utc_naive(run_ts)
    if truncate:
        stamp = stamp.replace(minute=0, second=0, microsecond=0)
    return df.withColumn(INGEST_STAMP, ntz(stamp))


def lowercase_columns(df: DataFrame) -> DataFrame:
    names = [c.lower() for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"columns collide once lower-cased: {clash}")
    return df.toDF(*names)


def aligned_names(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` in the column order of ``names``, matched by name ignoring case."""
    own = {c.lower(): c for c in df.columns}
    missing = [n for n in names if n.lower() not in own]
    extra = set(own) - {n.lower() for n in names}
    if missing or extra:
        raise ValueError(f"columns differ: missing {missing}, not in target {sorted(extra)}")
    return df.select(*[ref(own[n.lower()]).alias(n) for n in names])


def _without_void(data_type: T.DataType) -> T.DataType:
    if isinstance(data_type, T.NullType):
        return T.StringType()
    if isinstance(data_type, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _without_void(f.dataType), f.nullable) for f in data_type]
        )
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_without_void(data_type.elementType), data_type.containsNull)
    if isinstance(data_type, T.MapType):
        return T.MapType(
            _without_void(data_type.keyType),
            _without_void(data_type.valueType),
            data_type.valueContainsNull,
        )
    return data_type


def void_to_string(df: DataFrame) -> DataFrame:
    """Give null-typed columns, nested ones too, the type string."""
    return df.select(
        *[
            ref(f.name).cast(_without_void(f.dataType)).alias(f.name)
            if _without_void(f.dataType) != f.dataType
            else ref(f.name)
            for f in df.schema
        ]
    )


def with_region_tag(df: DataFrame, target: str) -> DataFrame:
    """Tag rows with the region, the second dash-separated part of the target name."""
    return df.withColumn(REGION_TAG, F.get(F.split(F.lit(target), "-"), F.lit(1)))


def normalise_timestamps(df: DataFrame) -> DataFrame:
    """Bring zoned timestamp columns to one zone-free UTC form."""
    return df.select(
        *[
            utc_wall_clock(ref(f.name)).alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else ref(f.name)
            for f in df.schema
        ]
    )
