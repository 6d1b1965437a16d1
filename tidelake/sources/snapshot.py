"""A table at a version: its schema, its live files, and a DataFrame over them."""

from __future__ import annotations

import datetime
import decimal
import json
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import errors
from ..plans.windows import Window, compare
from . import log
from .files import LocalFiles, files_of

Predicate = tuple[str, str, object]


@dataclass
class Snapshot:
    spark: SparkSession
    root: str
    state: log.State

    @classmethod
    def load(cls, spark: SparkSession, root: str, version: int | None = None, name: str | None = None) -> Snapshot:
        state = log.replay(spark, root, files_of(spark, root), version)
        if state is None:
            raise errors.LakeError(errors.READ_FAILED, f"there is no table{f' for {name!r}' if name else ''} at the location", "check the path, or write the table first")
        return cls(spark, root, state)

    @property
    def version(self) -> int:
        return self.state.version

    @property
    def schema(self) -> T.StructType:
        return self.state.schema

    @property
    def partition_columns(self) -> list[str]:
        return self.state.partition_columns

    @property
    def files(self) -> list[dict]:
        return list(self.state.files.values())

    @property
    def file_column(self) -> str:
        """What a scan calls the file of a row."""
        return spare("__file", self.schema.names)

    def num_records(self) -> int | None:
        """Rows by the log alone; None where a file has no statistics."""
        total = 0
        for add in self.files:
            n = stats_of(add).get("numRecords")
            if n is None:
                return None
            total += n
        return total

    def count(self) -> int:
        known = self.num_records()
        return self.to_df().count() if known is None else known

    def select_files(self, predicates: Iterable[Predicate]) -> list[dict]:
        """Files that may hold a row for which all predicates are true; those without usable statistics stay."""
        kinds = {f.name: f.dataType for f in self.schema.fields}
        predicates = list(predicates)
        return [a for a in self.files if all(may_match(a, p, kinds, self.partition_columns) for p in predicates)]

    def scan(self, predicates: Iterable[Predicate] = (), window: Window | None = None) -> DataFrame:
        """The rows for which all (column, comparison, value) hold, and those of the window; files are skipped by the log first."""
        predicates = [*predicates, *(window.bounds() if window else [])]
        for c, _, _ in predicates:
            if c not in self.schema.names:
                raise errors.LakeError(errors.READ_FAILED, "a predicate names no column of the table", "name a column, in its own case")
        df = self.to_df(self.select_files(predicates))
        for c, op, v in predicates:
            kind = self.schema[c].dataType
            if op == "in":
                df = df.where(F.col(f"`{c}`").isin([F.lit(x).cast(kind) for x in v]))
            else:
                df = df.where(compare(F.col(f"`{c}`"), op, F.lit(v).cast(kind)))
        return df

    def to_df(self, files: list[dict] | None = None, with_file: bool = False) -> DataFrame:
        """One scan over the files. Columns that a file lacks are null; partition columns come from the log.

        Partition values are read back from the folders' names where those say what the log does, so that Catalyst prunes by them;
        otherwise each file's values are joined to its rows by a map with one row per file.
        """
        files = self.files if files is None else files
        schema = nullable(self.schema)
        name = self.file_column
        file = [F.col("_metadata.file_path").alias(name)] if with_file else []
        if not files:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn(name, F.lit(None).cast("string")) if with_file else empty
        paths = [f"{self.root.rstrip('/')}/{a['path']}" if "://" not in a["path"] else a["path"] for a in files]
        paths = [_hadoop(unquote(p)) for p in paths]
        if all(folder_says(a, self.partition_columns) for a in files):
            with self._listing():
                df = self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths)
            return df.select(*[F.col(f"`{c}`") for c in schema.names], *file)
        kinds = {f.name: f.dataType for f in schema.fields}
        body = T.StructType([f for f in schema.fields if f.name not in self.partition_columns])
        with self._listing():
            rows = self.spark.read.schema(body).option("recursiveFileLookup", "true").parquet(*paths).select("*", F.col("_metadata.file_path").alias(name))
        keyed = [(uri, *[a["partitionValues"].get(c) for c in self.partition_columns]) for uri, a in self.uris(files).items()]
        part = spare("__p", [*schema.names, name])
        names = [f"{part}u", *[f"{part}{i}" for i in range(len(self.partition_columns))]]
        values = self.spark.createDataFrame(keyed, ", ".join(f"{n} string" for n in names))  # a row for each file
        joined = rows.join(F.broadcast(values), F.col(name) == F.col(names[0]))
        cols = [F.col(names[1 + self.partition_columns.index(c)]).cast(kinds[c]).alias(c) if c in self.partition_columns else F.col(f"`{c}`") for c in schema.names]
        return joined.select(*cols, *([F.col(name)] if with_file else []))

    @contextmanager
    def _listing(self) -> Iterator[None]:
        """While it holds, files on a local disk are looked at by the driver, which takes less than the job that Spark starts from 32 files on."""
        key = "spark.sql.sources.parallelPartitionDiscovery.threshold"
        before = self.spark.conf.get(key)
        if isinstance(files_of(self.spark, self.root), LocalFiles):
            self.spark.conf.set(key, 20_000)
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def uris(self, files: list[dict]) -> dict[str, dict]:
        """Files by the name that a scan's _metadata.file_path gives them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        base = self.root.rstrip("/")
        named = {fs.makeQualified(path(f"{base}/{unquote(a['path'])}")).toUri().toString(): a for a in files}
        return {uri.replace("file:///", "file:/", 1): a for uri, a in named.items()}


def _hadoop(path: str) -> str:
    """A path that Spark does not take for a glob."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def spare(wanted: str, taken: Iterable[str]) -> str:
    """A name that no column begins with, in any case."""
    lower = [t.lower() for t in taken]
    while any(t.startswith(wanted) for t in lower):
        wanted += "_"
    return wanted


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def stats_of(add: dict) -> dict:
    text = add.get("stats")
    return json.loads(text) if isinstance(text, str) and text else {}


def folder_says(add: dict, columns: list[str]) -> bool:
    """Whether the folders of a file, decoded as Spark decodes them, give the partition values of the log."""
    if not columns:
        return True
    parts = unquote(add["path"]).split("/")[:-1]
    if len(parts) != len(columns):
        return False
    for c, part in zip(columns, parts):
        name, eq, value = part.partition("=")
        raw = add["partitionValues"].get(c)
        if not eq or unescape(name) != c or (None if value == "__HIVE_DEFAULT_PARTITION__" else unescape(value)) != raw:
            return False
    return True


def unescape(text: str) -> str:
    """Undo Spark's escaping of folder names, one byte of a code a character."""
    out, i = [], 0
    while i < len(text):
        if text[i] == "%" and i + 2 < len(text) and all(c in "0123456789abcdefABCDEF" for c in text[i + 1 : i + 3]):
            out.append(chr(int(text[i + 1 : i + 3], 16)))
            i += 3
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def escape_path(path: str) -> str:
    """A file's relative path as the log spells it."""
    return quote(path, safe="/=-_.~!$&'()*+,;:@")


def _typed(value: object, kind: T.DataType) -> object:
    """A bound as a Python value that compares as the column's type does; None where that is not certain."""
    if value is None:
        return None
    try:
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return int(value)
        if isinstance(kind, T.DecimalType):
            return decimal.Decimal(str(value))
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return float(value)
        if isinstance(kind, T.DateType):
            return value if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime) else datetime.date.fromisoformat(str(value))
        if isinstance(kind, T.TimestampNTZType):
            return value if isinstance(value, datetime.datetime) else datetime.datetime.fromisoformat(str(value))
        if isinstance(kind, T.BooleanType):
            return value if isinstance(value, bool) else {"true": True, "false": False}[str(value).lower()]
        if isinstance(kind, T.StringType):
            return str(value).encode()
    except (ValueError, KeyError, ArithmeticError):
        return None
    return None


def may_match(add: dict, predicate: Predicate, kinds: dict[str, T.DataType], partitions: list[str]) -> bool:
    """Whether a file may hold a row for which (column, comparison, value) is true."""
    column, op, value = predicate
    kind = kinds[column]
    wanted = [_typed(v, kind) for v in (value if op == "in" else [value])]
    if any(w is None for w in wanted):
        return True
    if column in partitions:
        own = _typed(add["partitionValues"].get(column), kind)
        if own is None:
            return add["partitionValues"].get(column) is not None
        low = high = own
    else:
        stats = stats_of(add)
        if stats.get("numRecords") and (stats.get("nullCount") or {}).get(column) == stats["numRecords"]:
            return False
        low, high = (_typed((stats.get(k) or {}).get(column), kind) for k in ("minValues", "maxValues"))
        if low is None or high is None:
            return True
    test = {">": lambda w: high > w, ">=": lambda w: high >= w, "<": lambda w: low < w, "<=": lambda w: low <= w, "=": lambda w: low <= w <= high, "in": lambda w: low <= w <= high}[op]
    return any(test(w) for w in wanted)
