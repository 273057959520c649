"""Types that take in others: merging schemas without losing a value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
REAL = (T.FloatType, T.DoubleType)
TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both.

    Whole numbers widen up to bigint, then to double, dates to timestamps;
    what has nothing else in common becomes a string.  Structs merge field by
    field (names without regard to case, the first spelling stays), arrays and
    maps by their elements, and void is part of every type.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widest(a.keyType, b.keyType), widest(a.valueType, b.valueType))
    for order in (WHOLE, REAL, TIMES):
        if isinstance(a, order) and isinstance(b, order):
            return max((a, b), key=lambda t: order.index(type(t)))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    if isinstance(a, (*WHOLE, *REAL)) and isinstance(b, (*WHOLE, *REAL)):
        return T.DoubleType()
    return T.StringType()


def _merged(a: T.StructType, b: T.StructType) -> T.StructType:
    later = {f.name.lower(): f for f in b}
    fields = [T.StructField(f.name, widest(f.dataType, later[f.name.lower()].dataType) if f.name.lower() in later else f.dataType) for f in a]
    names = {f.name.lower() for f in a}
    for f in b:
        if f.name.lower() not in names:
            names.add(f.name.lower())
            fields.append(T.StructField(f.name, f.dataType))
    return T.StructType(fields)


def storable(kind: T.DataType) -> T.DataType:
    """The type a file can hold: void and structs without fields are written as strings."""
    if isinstance(kind, T.StructType) and len(kind):
        return T.StructType([T.StructField(f.name, storable(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(storable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, storable(kind.valueType))
    return T.StringType() if isinstance(kind, (T.NullType, T.StructType)) else kind


def reads_as(old: T.DataType, new: T.DataType) -> bool:
    """Whether files of the old type can be read with the new one: fields may have come, no type changed."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return all(f.name in new.names and reads_as(f.dataType, new[f.name].dataType) for f in old)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return reads_as(old.elementType, new.elementType)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return old.keyType == new.keyType and reads_as(old.valueType, new.valueType)
    return old == new


def conform(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A value of the old type as one of a type that is at least as wide.

    A nested value becomes its JSON text where the new type is a string.
    """
    if reads_as(old, new) and reads_as(new, old):
        return value
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        had = {f.name: f.dataType for f in old}
        fields = [(conform(value[f.name], had[f.name], f.dataType) if f.name in had else F.lit(None).cast(f.dataType)).alias(f.name) for f in new]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return F.transform(value, lambda x: conform(x, old.elementType, new.elementType))
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(old, nested) and isinstance(new, T.StringType):
        return F.to_json(value)
    if isinstance(old, T.StringType) and isinstance(new, nested):
        return F.from_json(value, new)  # written while nothing was known of it but that it was empty
    return value.try_cast(new)
