"""Partition filters of a merge, derived from the values of the input."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Distinct values of a column beyond which nothing is derived.
MOST_VALUES = 256
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass
class Derived:
    """Literals by partition column, or why there are none; neither where there is nothing to derive from."""

    filters: dict[str, list[str]] | None = None
    reason: str | None = None
    values: dict[str, list] = field(default_factory=dict)


def distinct_values(df: DataFrame, column: str, most: int = MOST_VALUES) -> list | None:
    """The values of a column if there are at most so many; one job, one value more than the limit reaches the driver."""
    rows = df.select(F.col(f"`{column}`").alias("v")).distinct().limit(most + 1).collect()
    return None if len(rows) > most else [r["v"] for r in rows]


def render(value: object, kind: T.DataType) -> str | None:
    if isinstance(kind, _INTEGERS):
        return str(value)
    if isinstance(kind, T.DateType) and isinstance(value, datetime.date):
        return f"'{value.isoformat()}'"
    if isinstance(kind, T.StringType) and "'" not in value and "\\" not in value:
        return f"'{value}'"
    return None


def derive(df: DataFrame, partitions: list[str] | None, keys: list[str], values_of: Callable[[str], list | None] | None = None) -> Derived:
    """IN lists for the partition columns of a merge. They are sound only if every partition column is a key.

    `values_of` gives a column's values where they are known already, or None if there are more than MOST_VALUES.
    """
    values_of = values_of or (lambda p: distinct_values(df, p))
    if not partitions:
        return Derived()
    if outside := [p for p in partitions if p not in keys]:
        return Derived(reason=f"partition columns are not merge keys: {', '.join(outside)}")
    if missing := [p for p in partitions if p not in df.columns]:
        return Derived(reason=f"partition columns are not in the data: {', '.join(missing)}")
    out, values = {}, {}
    for p in partitions:
        kind = df.schema[p].dataType
        if not isinstance(kind, (*_INTEGERS, T.DateType, T.StringType)):
            return Derived(reason=f"partition column {p} is of a type that is not written as a literal")
        try:
            found = values_of(p)
        except (ValueError, OverflowError):  # dates that Python cannot hold
            return Derived(reason=f"partition column {p} holds a value that cannot be written as a literal")
        if found is None:
            return Derived(reason=f"partition column {p} has more than {MOST_VALUES} values")
        if not found:
            return Derived()
        if None in found:
            return Derived(reason=f"partition column {p} holds nulls")
        literals = [render(v, kind) for v in found]
        if None in literals:
            return Derived(reason=f"partition column {p} holds a value that cannot be written as a literal")
        out[p], values[p] = sorted(literals), found
    return Derived(out, None, values)
