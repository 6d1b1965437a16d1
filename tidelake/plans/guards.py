"""Checks of values, observed while the whole input is written, so that they cost no pass of their own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import errors

#: Bytes that a folder's name may have.
NAME_BYTES = 255


@dataclass(frozen=True)
class Findings:
    rows: int
    values: dict[str, bool]


def _any(condition: Column) -> Column:
    return F.coalesce(F.max(condition), F.lit(False))


def _escaped_bytes(column: str) -> Column:
    """Bytes of `column=value` with the value escaped: three for each ASCII character that a folder's name cannot hold."""
    text = F.col(f"`{column}`").cast("string")
    kept = F.octet_length(F.regexp_replace(text, r"[\x00-\x1F\x7F\"#%'*/:=?\\{\[\]^ ]", ""))
    return F.octet_length(text) + 2 * (F.octet_length(text) - kept) + len(column.encode()) + 1


class Watch:
    """For each rule, whether a row breaks it; known once the frame that `on` returns has been written."""

    def __init__(self, schema: T.StructType, partitions: list[str], keys: list[str]):
        self.schema, self.partitions, self.keys = schema, partitions, keys
        self.seen = Observation()

    def _asked(self, df: DataFrame) -> list[Column]:
        asked: dict[str, Column] = {}
        for p in self.partitions:
            if isinstance(self.schema[p].dataType, (T.StringType, T.BinaryType)):
                asked[f"empty:{p}"] = _any(F.length(f"`{p}`") == 0)
            asked[f"long:{p}"] = _any(_escaped_bytes(p) > NAME_BYTES)
        for k in self.keys:
            asked[f"null:{k}"] = _any(F.col(f"`{k}`").isNull())
            if isinstance(self.schema[k].dataType, (T.FloatType, T.DoubleType)):
                asked[f"nan:{k}"] = _any(F.isnan(f"`{k}`"))
        for f in self.schema.fields:
            if not f.nullable and f.name in df.columns:
                asked[f"required:{f.name}"] = _any(F.col(f"`{f.name}`").isNull())
        self.rules = list(asked)
        return [F.count(F.lit(1)).alias("rows"), *[asked[n].alias(f"g{i}") for i, n in enumerate(self.rules)]]

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *self._asked(df))

    def findings(self) -> Findings:
        return self._found(self.seen.get)

    def ask(self, df: DataFrame) -> Findings:
        """The same by a job of its own: for a write that failed, to tell why."""
        return self._found(df.agg(*self._asked(df)).first().asDict())

    def _found(self, row: dict) -> Findings:
        return Findings(row["rows"], {n: bool(row[f"g{i}"]) for i, n in enumerate(self.rules)})


def enforce(found: Findings) -> None:
    """Refuse what breaks a rule; columns are named, values never."""
    broken = {kind: [n.partition(":")[2] for n, bad in found.values.items() if bad and n.startswith(f"{kind}:")] for kind in ("empty", "long", "null", "nan", "required")}
    if broken["empty"]:
        raise errors.LakeError(errors.PARTITION_VALUE, f"empty values in partition columns: {', '.join(broken['empty'])}; they would read back as null", "write null, or a value")
    if broken["null"] or broken["nan"]:
        what = [f"null in {', '.join(broken['null'])}"] * bool(broken["null"]) + [f"NaN in {', '.join(broken['nan'])}"] * bool(broken["nan"])
        raise errors.LakeError(errors.UNMATCHABLE_KEY, f"merge keys that match nothing: {'; '.join(what)}", "fill the keys, or leave the rows out")
    if broken["required"]:
        raise errors.LakeError(errors.PARTITION_VALUE, f"nulls in columns that may not be null: {', '.join(broken['required'])}", "fill the columns")
    if broken["long"]:
        raise errors.LakeError(errors.PARTITION_VALUE, f"values too long for a folder's name in partition columns: {', '.join(broken['long'])}", "partition by a shorter value")
