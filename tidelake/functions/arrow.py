"""Arrow tables at the edge: which of their types can be written, and what becomes of them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .. import errors

# Spellings of a time zone that mean UTC and are rewritten to it.
UTC_SPELLINGS = ["UTC", "+00:00", "-00:00", "+0000", "+00", "Z", "utc"]
_SIGNED = {pa.uint8(): pa.int8(), pa.uint16(): pa.int16(), pa.uint32(): pa.int32(), pa.uint64(): pa.int64()}


def _is(kind: pa.DataType, *names: str) -> bool:
    return any(getattr(pa.types, f"is_{n}", lambda _: False)(kind) for n in names)


def writable(kind: pa.DataType) -> bool:
    if isinstance(kind, pa.BaseExtensionType):
        return writable(kind.storage_type)
    if _is(kind, "null", "float16", "interval", "duration", "time32", "time64", "decimal32", "decimal64", "decimal256", "run_end_encoded", "union", "fixed_size_list"):
        return False
    if _is(kind, "timestamp"):
        return not kind.tz or kind.tz in UTC_SPELLINGS
    if _is(kind, "list"):
        return writable(kind.value_type)
    if _is(kind, "struct"):
        return all(writable(f.type) for f in kind)
    if _is(kind, "map"):
        return writable(kind.key_type) and writable(kind.item_type)
    return True


def stored(kind: pa.DataType) -> pa.DataType:
    """The type that comes back from a table: unsigned becomes signed of the same width, encodings become plain, times count microseconds."""
    if isinstance(kind, pa.BaseExtensionType):
        return stored(kind.storage_type)
    if kind in _SIGNED:
        return _SIGNED[kind]
    if _is(kind, "dictionary"):
        return stored(kind.value_type)
    if _is(kind, "string", "large_string", "string_view"):
        return pa.string()
    if _is(kind, "binary", "large_binary", "binary_view", "fixed_size_binary"):
        return pa.binary()
    if _is(kind, "date"):
        return pa.date32()
    if _is(kind, "timestamp"):
        return pa.timestamp("us", "UTC" if kind.tz else None)
    if _is(kind, "list", "large_list", "list_view", "large_list_view"):
        return pa.list_(stored(kind.value_type))
    if _is(kind, "struct"):
        return pa.struct([pa.field(f.name, stored(f.type), f.nullable) for f in kind])
    if _is(kind, "map"):
        return pa.map_(stored(kind.key_type), stored(kind.item_type))
    return kind


def to_frame(spark: SparkSession, table: pa.Table, partition_by: list[str] | None = None) -> DataFrame:
    """A frame of the stored types. Unwritable columns, dictionary partitions and numbers that do not fit are refused; all such are named."""
    bad = [f"{f.name} ({f.type})" for f in table.schema if not writable(f.type)]
    bad += [f"{f.name} ({f.type}, a partition column)" for f in table.schema if _is(f.type, "dictionary") and f.name in (partition_by or [])]
    if bad:
        raise errors.LakeError(errors.UNWRITABLE_TYPE, f"columns of types that tables cannot hold: {', '.join(bad)}", "cast them before writing")
    cols = []
    for f, column in zip(table.schema, table.columns):
        plain = column.cast(f.type.value_type) if _is(f.type, "dictionary") else column
        try:
            cols.append(plain.cast(stored(f.type)))
        except pa.ArrowInvalid:
            raise errors.LakeError(errors.PARTITION_VALUE, f"column {f.name} holds a value that its stored type cannot", "widen or clean the column") from None
    kept = pa.schema([pa.field(f.name, stored(f.type), f.nullable) for f in table.schema])
    return spark.createDataFrame(pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols], schema=kept))
