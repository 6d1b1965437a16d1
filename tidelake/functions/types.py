"""What tables can hold, and what keys can be compared."""

from __future__ import annotations

from pyspark.sql import types as T

# Types without a place in a table.
_REFUSED = tuple(getattr(T, n) for n in ("NullType", "CalendarIntervalType", "DayTimeIntervalType", "YearMonthIntervalType", "TimeType", "VariantType") if hasattr(T, n))
_COMPARABLE = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


def writable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(writable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return writable(kind.elementType)
    if isinstance(kind, T.MapType):
        return writable(kind.keyType) and writable(kind.valueType)
    return not isinstance(kind, _REFUSED)


def comparable(kind: T.DataType) -> bool:
    return isinstance(kind, _COMPARABLE)


def describe(kind: T.DataType) -> str:
    return kind.simpleString()
