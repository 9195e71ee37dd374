"""The least type that holds the values of two types exactly, and casts up to it.

Types form a lattice: integers widen to longer ones, to doubles as long as these hold them
exactly, and to decimals; floats to doubles; decimals to more digits on either side; dates
to zone-free times. Structs are joined field by field, arrays and maps by what they hold,
and the type of nothing but nulls goes with any other. Pairs without such a type are an
error that names the field.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.rows import ref

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_FLOATS = (T.FloatType, T.DoubleType)
_MOST_DIGITS = 38


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    digits = _DIGITS.get(type(kind))
    return T.DecimalType(digits, 0) if digits else None


def _common_number(a: T.DataType, b: T.DataType) -> T.DataType | None:
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda k: _INTEGERS.index(type(k)))
    if isinstance(a, _FLOATS) and isinstance(b, _FLOATS):
        return T.DoubleType()
    if isinstance(a, _FLOATS) or isinstance(b, _FLOATS):
        other = b if isinstance(a, _FLOATS) else a
        # 53 bits hold every int, but not every long or decimal.
        return T.DoubleType() if isinstance(other, _INTEGERS[:3]) else None
    one, two = _as_decimal(a), _as_decimal(b)
    if one is None or two is None:
        return None
    scale = max(one.scale, two.scale)
    digits = max(one.precision - one.scale, two.precision - two.scale) + scale
    return T.DecimalType(digits, scale) if digits <= _MOST_DIGITS else None


def common_type(a: T.DataType, b: T.DataType, name: str = "value") -> T.DataType:
    """The least type above both; every field of it may be null."""
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema(a, b, f"{name}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType, f"{name}[]"))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key = common_type(a.keyType, b.keyType, f"{name} (key)")
        return T.MapType(key, common_type(a.valueType, b.valueType, f"{name} (value)"))
    if a == b:
        return a
    days = {T.DateType, T.TimestampNTZType}
    found = T.TimestampNTZType() if {type(a), type(b)} == days else _common_number(a, b)
    if found is None:
        raise ValueError(f"{name!r}: no type holds both {a.simpleString()} and {b.simpleString()} exactly")
    return found


def common_schema(a: T.StructType, b: T.StructType, inside: str = "") -> T.StructType:
    """The fields of ``a``, widened, then those only ``b`` has; names match ignoring case."""
    found = {f.name.lower(): T.StructField(f.name, f.dataType) for f in a}
    for f in b:
        have = found.get(f.name.lower())
        kind = f.dataType if have is None else common_type(have.dataType, f.dataType, inside + f.name)
        found[f.name.lower()] = T.StructField(f.name if have is None else have.name, kind)
    return T.StructType(list(found.values()))


def merged(schemas: list[T.StructType]) -> T.StructType:
    """The common schema of several, the first one's fields first."""
    return reduce(common_schema, schemas)


def cast_up(value: Column, kind: T.DataType, to: T.DataType) -> Column:
    """A value of type ``kind`` as the wider type ``to``; nulls stay nulls at every depth."""
    if isinstance(kind, T.StructType) and isinstance(to, T.StructType):
        own = {f.name.lower(): f for f in kind}

        def part(f: T.StructField) -> Column:
            have = own.get(f.name.lower())
            inner = F.lit(None).cast(f.dataType) if have is None else cast_up(value.getField(have.name), have.dataType, f.dataType)
            return inner.alias(f.name)

        return F.when(value.isNotNull(), F.struct(*map(part, to)))
    if isinstance(kind, T.ArrayType) and isinstance(to, T.ArrayType):
        return F.transform(value, lambda v: cast_up(v, kind.elementType, to.elementType))
    if isinstance(kind, T.MapType) and isinstance(to, T.MapType):
        keyed = F.transform_keys(value, lambda k, _: cast_up(k, kind.keyType, to.keyType))
        return F.transform_values(keyed, lambda _, v: cast_up(v, kind.valueType, to.valueType))
    return value if kind == to else value.cast(to)


def widened(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of a schema above its own; missing columns are null."""
    own = {f.name.lower(): f for f in df.schema}

    def column(f: T.StructField) -> Column:
        have = own.get(f.name.lower())
        if have is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return cast_up(ref(have.name), have.dataType, f.dataType).alias(f.name)

    return df.select(*map(column, schema))
