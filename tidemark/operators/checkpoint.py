"""Checkpoint definitions and the values that move them forward."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tidemark.functions.predicates import UTC_MARK
from tidemark.functions.rows import cut_to_second, ref, utc_wall_clock
from tidemark.model import (
    BRONZE,
    CHECKPOINT_PART_SEPARATOR,
    CHECKPOINT_SEPARATOR,
    CheckpointSpec,
)
from tidemark.session import few_rows

OBJECT_KEYS = ("SOURCE_NAMESPACE", "SOURCE_TABLE_NAME", "PROC_GROUP")


def escaped(value: str) -> str:
    """A value beside others: separators behind a backslash, backslashes twice."""
    return value.replace("\\", "\\\\").replace(CHECKPOINT_SEPARATOR, "\\" + CHECKPOINT_SEPARATOR)


def escaped_text(value: Column) -> Column:
    """``escaped`` as a column expression."""
    doubled = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit(CHECKPOINT_SEPARATOR), F.lit("\\" + CHECKPOINT_SEPARATOR))


def split_values(values: str) -> list[str]:
    """The values of a stored checkpoint text, unescaped."""
    parts, current, behind = [], [], False
    for sign in values:
        if behind:
            current.append(sign if sign in ("\\", CHECKPOINT_SEPARATOR) else "\\" + sign)
            behind = False
        elif sign == "\\":
            behind = True
        elif sign == CHECKPOINT_SEPARATOR:
            parts.append("".join(current))
            current = []
        else:
            current.append(sign)
    return [*parts, "".join(current) + ("\\" if behind else "")]


def split_text(values: Column) -> Column:
    """``split_values`` as a column expression: pairs are set aside, then put back."""
    back, bar = "\u0001", "\u0002"
    aside = F.replace(F.replace(values, F.lit("\\\\"), F.lit(back)), F.lit("\\" + CHECKPOINT_SEPARATOR), F.lit(bar))
    return F.transform(
        F.split(aside, "\\" + CHECKPOINT_SEPARATOR),
        lambda v: F.replace(F.replace(v, F.lit(bar), F.lit(CHECKPOINT_SEPARATOR)), F.lit(back), F.lit("\\")),
    )


def parse_checkpoints(config: DataFrame) -> DataFrame:
    """One row per configured checkpoint field of every BRONZE object.

    Columns: the object's keys and target, ``pos`` (0-based), ``field``, ``type``,
    ``op`` and ``value`` (null where the stored values are fewer).
    """
    sep = "\\" + CHECKPOINT_SEPARATOR
    several = F.contains("CHECKPOINT_FIELD_DEF", F.lit(CHECKPOINT_SEPARATOR))
    values = F.when(several, split_text(F.col("CHECKPOINT_TO_VALUE"))).otherwise(F.array("CHECKPOINT_TO_VALUE"))
    return (
        config.where((F.col("LAYER_TYPE") == BRONZE) & F.col("CHECKPOINT_FIELD_DEF").isNotNull())
        .select(
            *OBJECT_KEYS,
            "TARGET_TABLE_NAME",
            values.alias("values"),
            F.posexplode(F.split("CHECKPOINT_FIELD_DEF", sep)).alias("pos", "entry"),
        )
        .where(F.col("entry") != "")
        .withColumn("parts", F.split("entry", CHECKPOINT_PART_SEPARATOR))
        .select(
            *OBJECT_KEYS,
            "TARGET_TABLE_NAME",
            "pos",
            F.get("parts", F.lit(0)).alias("field"),
            F.get("parts", F.lit(1)).alias("type"),
            F.get("parts", F.lit(2)).alias("op"),
            F.get("values", F.col("pos")).alias("value"),
        )
    )


def checkpoint_fields(config: DataFrame) -> DataFrame:
    """The checkpoint field names of every target, as one ordered array.

    An array per configuration row: its size is that of one definition text.
    """
    return config.where(
        (F.col("LAYER_TYPE") == BRONZE) & F.col("CHECKPOINT_FIELD_DEF").isNotNull()
    ).select(
        *OBJECT_KEYS,
        "TARGET_TABLE_NAME",
        F.transform(
            F.split("CHECKPOINT_FIELD_DEF", "\\" + CHECKPOINT_SEPARATOR),
            lambda e: F.substring_index(e, CHECKPOINT_PART_SEPARATOR, 1),
        ).alias("fields"),
    )


def specs_of(definition: str | None, values: str | None) -> tuple[CheckpointSpec, ...]:
    """The checkpoint entries of one object, for building its read predicate."""
    if not definition:
        return ()
    entries = definition.split(CHECKPOINT_SEPARATOR)
    # One value needs no separator, so it is stored as it is.
    stored = [] if values is None else [values] if len(entries) == 1 else split_values(values)
    specs = []
    for i, entry in enumerate(entries):
        parts = entry.split(CHECKPOINT_PART_SEPARATOR)
        if len(parts) != 3:
            raise ValueError(f"checkpoint entry {entry!r} is not field::type::operator")
        specs.append(CheckpointSpec(*parts, stored[i] if i < len(stored) else None))
    return tuple(specs)


def _greatest_text(df: DataFrame, name: str, precision: str | None, marked: bool) -> Column:
    top = F.max(ref(name))
    kind = df.select(ref(name)).schema[0].dataType
    zoned = isinstance(kind, T.TimestampType)
    if zoned:
        # An instant that is marked as UTC is read back alike by any session. Without a mark
        # it is the wall clock of this session, as is the zone-free literal it is compared with.
        top = utc_wall_clock(top) if marked else top.cast("timestamp_ntz")
    if precision == "second" and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        top = cut_to_second(top)
    return F.concat(top.cast("string"), F.lit(UTC_MARK)) if zoned and marked else top.cast("string")


def next_checkpoint(
    df: DataFrame, fields: Sequence[str], precision: str | None = None, marked: bool = False
) -> DataFrame:
    """One row: ``checkpoint`` (maxima joined with ``|``) and ``row_count``.

    ``marked`` writes instants as UTC times with a mark, for sessions of any zone to read;
    what the flows store is always marked.

    All fields share one aggregation. An empty slice, or a field without any
    value, gives a null checkpoint, which moves nothing.
    """
    tops = [_greatest_text(df, f, precision, marked) for f in fields]
    return df.agg(
        F.array(*tops).alias("tops"), F.count(F.lit(1)).alias("row_count")
    ).select(
        F.when(
            F.forall("tops", lambda t: t.isNotNull()),
            F.col("tops")[0] if len(fields) == 1 else F.array_join(F.transform("tops", escaped_text), CHECKPOINT_SEPARATOR),
        ).alias("checkpoint"),
        "row_count",
    )


def observe_checkpoint(
    df: DataFrame,
    specs: Sequence[CheckpointSpec],
    precision: str | None = None,
    bucketed: bool = False,
) -> tuple[DataFrame, Observation]:
    """Collect the next checkpoint while ``df`` is being written: no extra job.

    With ``bucketed`` the first two fields are year and month buckets and what is
    kept is one value: the third field's maximum, or the greatest ``yyyy-mm``
    where there is no third field.
    """
    seen = Observation()
    if bucketed and len(specs) > 1:
        if len(specs) > 2:
            tops = [_greatest_text(df, specs[2].field, precision, True)]
        else:
            year, month = (ref(s.field).cast("string") for s in specs)
            tops = [F.max(F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0")))]
    else:
        tops = [_greatest_text(df, s.field, precision, True) for s in specs]
    metrics = [top.alias(f"top_{i}") for i, top in enumerate(tops)]
    return df.observe(seen, F.count(F.lit(1)).alias("row_count"), *metrics), seen


def observed_value(seen: Observation, specs: Sequence[CheckpointSpec]) -> tuple[str | None, int]:
    """(next checkpoint text or None, rows seen) once the write has run.

    A field whose new values are all null keeps its stored value.
    """
    got = seen.get
    rows = int(got["row_count"])
    if rows == 0:
        return None, 0
    tops = [got[f"top_{i}"] for i in range(len(got) - 1)]
    parts = [s.value if t is None else t for t, s in zip(tops, specs)]
    if any(p is None for p in parts):
        return None, rows
    if len(parts) == 1:
        return parts[0], rows
    return CHECKPOINT_SEPARATOR.join(map(escaped, parts)), rows


def advance_checkpoints(config: DataFrame, new: DataFrame) -> DataFrame:
    """Set ``CHECKPOINT_TO_VALUE`` of the BRONZE rows named in ``new``.

    ``new`` has SOURCE_NAMESPACE, SOURCE_TABLE_NAME and ``checkpoint``, and may have
    PROC_GROUP and TARGET_TABLE_NAME to tell objects of one source apart. A null
    checkpoint changes nothing. Of several rows of one object the one with the greatest
    ``position`` counts; without that column different values are an error, since the
    text of a checkpoint has no order.
    """
    keys = [c for c in (*OBJECT_KEYS, "TARGET_TABLE_NAME") if c in new.columns]
    value = F.col("checkpoint")
    if "position" in new.columns:
        last = F.max_by("checkpoint", "position")
    else:
        message = F.lit("several checkpoints of one object and no position")
        last = F.when(F.count_distinct(value) > 1, F.raise_error(message).cast("string")).otherwise(F.max(value))
    moved = (
        new.where(value.isNotNull())
        .groupBy(*keys)
        .agg(last.alias("checkpoint"))
        .withColumn("LAYER_TYPE", F.lit(BRONZE))
    )
    joined = config.join(moved, [*keys, "LAYER_TYPE"], "left")
    return joined.select(
        *[
            F.coalesce("checkpoint", "CHECKPOINT_TO_VALUE").alias(c)
            if c == "CHECKPOINT_TO_VALUE"
            else F.col(c)
            for c in config.columns
        ]
    )


MOVED = T.StructType(
    [
        T.StructField("SOURCE_NAMESPACE", T.StringType()),
        T.StructField("SOURCE_TABLE_NAME", T.StringType()),
        T.StructField("checkpoint", T.StringType()),
    ]
)


def checkpoint_row(spark, namespace: str, table: str, checkpoint: str | None) -> DataFrame:
    return few_rows(spark, [(namespace, table, checkpoint)], MOVED)
