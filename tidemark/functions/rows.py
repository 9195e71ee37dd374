"""Column expressions over whole rows. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, functions as F, types as T

from tidemark.model import ROW_TIMESTAMP_FORMAT

JSON_OPTIONS = {
    "timestampFormat": ROW_TIMESTAMP_FORMAT,
    "timestampNTZFormat": ROW_TIMESTAMP_FORMAT,
    "timeZone": "UTC",
}


def ref(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_json(
    columns: Iterable[str],
    options: dict[str, str] | None = None,
    schema: T.StructType | None = None,
) -> Column:
    """JSON text of the given columns, in order; null fields are left out.

    With ``schema`` equal maps give equal text, at whatever depth they lie.
    """
    kinds = {f.name: f.dataType for f in schema or ()}
    fields = [canonical(ref(c), kinds.get(c)).alias(c) for c in columns]
    return F.to_json(F.struct(*fields), options or JSON_OPTIONS)


def _holds_map(kind: T.DataType | None) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, T.MapType)


#: Key types whose text is the same wherever it is made; other maps become lists of entries.
_PLAIN_KEYS = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DecimalType)


def canonical(value: Column, kind: T.DataType | None) -> Column:
    """A value in which the entries of every map stand in the order of their keys.

    Equal maps may be stored in different orders and must still hash alike. The expression
    follows the type: only the parts that hold a map are built anew, and maps are sorted by
    key alone, so their values may have no order.
    """
    if not _holds_map(kind):
        return value
    if isinstance(kind, T.StructType):
        fields = [canonical(value.getField(f.name), f.dataType).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: canonical(v, kind.elementType))
    places = F.transform(F.map_keys(value), lambda k, i: F.struct(k.alias("key"), i.alias("at")))
    values = F.map_values(value)

    def entry(place: Column) -> Column:
        held = canonical(F.get(values, place["at"]), kind.valueType)
        return F.struct(place["key"].alias("key"), held.alias("value"))

    entries = F.transform(F.array_sort(places), entry)
    return F.map_from_entries(entries) if isinstance(kind.keyType, _PLAIN_KEYS) else entries


def row_hash(columns: Iterable[str], schema: T.StructType | None = None) -> Column:
    """md5 (32 lowercase hex) of the canonical row text.

    The text of a row is never null. Saying so with ``coalesce`` keeps joins on the
    hash from adding a not-null filter, which would compute every hash twice.
    """
    return F.coalesce(F.md5(row_json(columns, schema=schema)), F.lit(""))


def ntz(ts: datetime | str) -> Column:
    """A zone-free timestamp literal, whatever the session time zone."""
    text = ts if isinstance(ts, str) else ts.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def cut_to_hour(ts: Column) -> Column:
    """The hour of a zone-free time. ``date_trunc`` would pass through the session
    zone and go wrong in its daylight-saving gap."""
    zero = F.lit(0)
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), zero, zero
    )


def cut_to_second(ts: Column) -> Column:
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts)
    )


def utc_wall_clock(ts: Column) -> Column:
    """The zone-free UTC time of an instant, counted from the epoch and therefore
    free of the session zone with its missing and doubled hours."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), ntz("1970-01-01 00:00:00"))
