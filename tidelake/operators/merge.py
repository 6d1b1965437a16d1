"""Keyed merge: the last incoming row of a key updates every stored row of that key, or is inserted.

Stored files are rewritten only where a row of theirs matches. They are looked for among the files that partition values and key bounds
leave, and the input is written once, or held by the driver if it is small, so that updates and inserts see the same rows whatever happens
to an executor.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import predicate as language
from ..plans.options import WriteSpec
from ..plans.pruning import MOST_VALUES, Derived, derive, distinct_values
from ..sources.snapshot import Snapshot, nullable, spare


def last_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key, that with the greatest value of the column `order`. A key of very many rows is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c != order]
    quoted = [F.col(f"`{k}`") for k in keys]
    if not rest:
        return df.select(*quoted).distinct()
    whole = spare("__whole", df.columns)
    packed = df.select(*quoted, F.col(order), F.struct(*[F.col(f"`{c}`") for c in rest]).alias(whole))
    last = packed.groupBy(*quoted).agg(F.max_by(whole, order).alias(whole))
    return last.select(*quoted, *[F.col(f"{whole}.`{c}`").alias(c) for c in rest])


@dataclass
class MergePlan:
    snapshot: Snapshot
    schema: T.StructType  # of the table after the write
    spec: WriteSpec
    source: DataFrame  # one row per key
    local: pa.Table | None = None  # the same rows, where the driver holds them

    def __post_init__(self):
        prefix = spare("__s", [*self.schema.names, self.snapshot.file_column])
        self.named = {c: f"{prefix}{i}" for i, c in enumerate(self.source.columns)}
        self.incoming = self.source.select(*[F.col(f"`{c}`").alias(n) for c, n in self.named.items()])
        self._values: dict[str, list | None] = {}
        self.parts = language.check(self.spec.merge_predicate, self.schema.names, self.source.columns) if self.spec.merge_predicate is not None else None

    def on(self) -> Column:
        """The keys are equal, and the merge predicate holds."""
        out = F.lit(True)
        for k in self.spec.keys:
            out = out & (F.col(f"`{k}`") == F.col(self.named[k]))
        if self.parts is not None:
            names = {("target", c): c for c in self.schema.names} | {("source", c): n for c, n in self.named.items()}
            out = out & F.expr(f"({language.to_spark(self.parts, names)})")
        return out

    def target(self, files: list[dict], with_file: bool = False) -> DataFrame:
        """Stored rows in the schema after the write."""
        df = self.snapshot.to_df(files, with_file)
        for f in self.schema.fields:
            if f.name not in self.snapshot.schema.names:
                df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
        return df

    def _bounds(self, keys: list[str]) -> dict[str, tuple]:
        """The least and greatest value of each key; none for one without rows."""
        if self.local is not None:
            found = {k: pc.min_max(self.local[k]).as_py() for k in keys}
            return {k: (v["min"], v["max"]) for k, v in found.items() if v["min"] is not None}
        if not keys:
            return {}
        row = self.source.agg(*[f(f"`{k}`").cast("string").alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))]).first()
        return {k: (row[f"lo{i}"], row[f"hi{i}"]) for i, k in enumerate(keys) if row[f"lo{i}"] is not None}

    def values_of(self, column: str, most: int) -> list | None:
        """The incoming values of a column if there are at most so many."""
        if column not in self._values:
            try:
                if self.local is not None:
                    found = pc.unique(self.local[column])
                    self._values[column] = found.to_pylist() if len(found) <= 40 * MOST_VALUES else None
                else:
                    self._values[column] = distinct_values(self.source, column, 40 * MOST_VALUES)
            except (ValueError, OverflowError):  # dates that Python cannot hold
                self._values[column] = None
        found = self._values[column]
        return found if found is not None and len(found) <= most else None

    def derived(self) -> Derived:
        """The partition filter that the merge's statement states, or why it has none."""
        return derive(self.source, self.snapshot.partition_columns, self.spec.keys, lambda p: self.values_of(p, MOST_VALUES))

    def candidates(self) -> list[dict]:
        """Files that may hold a matching row, by the partition values and the least and greatest keys of the input."""
        kinds = {f.name: f.dataType for f in self.snapshot.schema.fields}
        bounded = [k for k in self.spec.keys if k not in self.snapshot.partition_columns and isinstance(kinds[k], (T.IntegralType, T.StringType, T.DateType, T.TimestampNTZType))]
        try:
            bounds = self._bounds(bounded)
        except (ValueError, OverflowError):
            bounds = {}
        predicates = [(k, op, v) for k, (lo, hi) in bounds.items() for op, v in ((">=", lo), ("<=", hi))]
        for p in self.snapshot.partition_columns:
            if p in self.spec.keys and (values := self.values_of(p, 40 * MOST_VALUES)):
                predicates.append((p, "in", values))
        return self.snapshot.select_files(predicates)

    def _only_keys(self) -> bool:
        return set(self.source.columns) <= set(self.spec.keys)

    def touched(self, candidates: list[dict]) -> list[dict]:
        """Files with a row that matches; none need a rewrite where all incoming columns are keys."""
        if not candidates or self._only_keys():
            return []
        found = self.target(candidates, with_file=True).join(self.incoming, self.on(), "left_semi").select(self.snapshot.file_column).distinct().collect()  # at most one row a file
        uris = self.snapshot.uris(candidates)
        return [uris[r[0]] for r in found]

    def result(self, candidates: list[dict], touched: list[dict]) -> DataFrame:
        """The rows of the touched files, updated, and the rows that matched nothing."""
        target_names = self.schema.names
        # A row that matches stands in a touched file, unless no file counts as touched because only keys come in.
        matching = touched or (candidates if self._only_keys() else [])
        fresh = self.incoming if not matching else self.incoming.join(self.target(matching), self.on(), "left_anti")
        inserted = fresh.select(*[(F.col(self.named[c]) if c in self.named else F.lit(None).cast(self.schema[c].dataType)).alias(c) for c in target_names])
        if not touched:
            return inserted
        matched = F.col(self.named[self.spec.keys[0]]).isNotNull()  # keys are never null
        joined = self.target(touched).join(self.incoming, self.on(), "left")
        updated = joined.select(*[(F.when(matched, F.col(self.named[c])).otherwise(F.col(f"`{c}`")) if c in self.named and c not in self.spec.keys else F.col(f"`{c}`")).alias(c) for c in target_names])
        return updated.unionByName(inserted)


def frame_in(schema: T.StructType, df: DataFrame) -> DataFrame:
    """A frame's columns in the table's order, those it lacks null."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)) for f in nullable(schema).fields])
