"""Whether incoming columns fit a table, and what the table's schema becomes."""

from __future__ import annotations

from pyspark.sql import types as T

from .. import errors
from ..functions.types import comparable, describe, writable
from .options import WriteSpec


def check_incoming(schema: T.StructType, spec: WriteSpec) -> None:
    """What can be refused without the table: types, keys, partition columns, names that differ in case only."""
    if bad := [f"{f.name} ({describe(f.dataType)})" for f in schema.fields if not writable(f.dataType)]:
        raise errors.LakeError(errors.UNWRITABLE_TYPE, f"columns of types that tables cannot hold: {', '.join(bad)}", "cast or leave out the columns")
    lower: dict[str, str] = {}
    for name in schema.names:
        if name.lower() in lower:
            raise errors.LakeError(errors.SCHEMA_MISMATCH, f"columns '{lower[name.lower()]}' and '{name}' differ in case only", "rename one of them")
        lower[name.lower()] = name
    if missing := [k for k in spec.keys if k not in schema.names]:
        raise errors.LakeError(errors.KEY_NOT_IN_SCHEMA, f"keys that are not columns of the data: {', '.join(missing)}", "name columns, in their own case")
    if spec.strategy == "merge":
        if bad := [f"{k} ({describe(schema[k].dataType)})" for k in spec.keys if not comparable(schema[k].dataType)]:
            raise errors.LakeError(errors.KEY_TYPE, f"keys of types without equality: {', '.join(bad)}", "use scalar columns as keys")
        if bad := [n for n in schema.names if '"' in n]:
            raise errors.LakeError(errors.UNQUOTABLE_NAME, f"column names hold a double quote: {', '.join(bad)}", "rename the columns")
    if missing := [p for p in spec.partition_by or [] if p not in schema.names]:
        raise errors.LakeError(errors.WRITE_OPTION, f"partition columns that are not columns of the data: {', '.join(missing)}", "name columns, in their own case")


def reconcile(table: T.StructType, partitions: list[str], incoming: T.StructType, spec: WriteSpec) -> T.StructType:
    """The schema after the write. All problems are told in one error."""
    problems: list[str] = []
    have = {f.name: f for f in table.fields}
    folded = {f.name.lower(): f.name for f in table.fields}
    added = []
    if spec.partition_by is not None and spec.partition_by != partitions:
        problems.append(f"the table is partitioned by ({', '.join(partitions)}) and the write asks for ({', '.join(spec.partition_by)})")
    for f in incoming.fields:
        own = have.get(f.name)
        if own is not None:
            if describe(own.dataType) != describe(f.dataType):
                problems.append(f"column '{f.name}' is {describe(f.dataType)} in the data and {describe(own.dataType)} in the table")
        elif f.name.lower() in folded:
            problems.append(f"column '{f.name}' differs from the table's '{folded[f.name.lower()]}' in case only")
        elif not spec.evolve:
            problems.append(f"column '{f.name}' is not in the table")
        elif not f.nullable and spec.strategy != "replace":
            problems.append(f"column '{f.name}' may not be null, but stored rows would have no value for it")
        else:
            added.append(f)
    for f in table.fields:
        if f.name not in incoming.names:
            if not f.nullable:
                problems.append(f"column '{f.name}' may not be null and is missing from the data")
            elif not spec.evolve:
                problems.append(f"column '{f.name}' is missing from the data")
    if problems:
        raise errors.LakeError(errors.SCHEMA_MISMATCH, "; ".join(problems), "change the data, or set schema_policy to evolve where columns are only added or left out")
    return T.StructType([*table.fields, *added])
