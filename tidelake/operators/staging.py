"""Writing data files beside a table and describing them for the log."""

from __future__ import annotations

import datetime
import decimal
import json
import math
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import log
from ..sources.files import Entry, HadoopFiles, LocalFiles
from ..sources.snapshot import escape_path, unescape

STAGING = "_staging"
#: Text of a bound that statistics keep.
STATS_TEXT = 32
_MOMENT = re.compile(r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?")
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Staged:
    folder: str
    entries: list[tuple[Entry, dict]]  # files with rows, and their statistics

    @property
    def rows(self) -> int:
        return sum(s["numRecords"] for _, s in self.entries)


def row_bytes(schema: T.StructType) -> int:
    """A rough size of a row, to turn a file's bytes into rows."""
    sizes = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}
    return max(1, sum(sizes.get(type(f.dataType), 8 if isinstance(f.dataType, (T.NumericType, T.TimestampType, T.TimestampNTZType)) else 32) for f in schema.fields))


def stage(df: DataFrame, files: LocalFiles | HadoopFiles, root: str, partitions: list[str], file_bytes: int) -> Staged:
    """Write a frame under the table's staging folder. Partitioned rows are gathered by partition first, and large partitions stay split."""
    folder = f"{STAGING}/{uuid.uuid4().hex}"
    if partitions:
        df = df.hint("rebalance", *[F.col(f"`{p}`") for p in partitions])
    writer = df.write.option("maxRecordsPerFile", max(1, file_bytes // row_bytes(df.schema)))
    try:
        (writer.partitionBy(*partitions) if partitions else writer).parquet(f"{root.rstrip('/')}/{folder}")
    except Exception:
        files.delete(folder)
        raise
    entries = [e for e in files.walk(folder) if e.path.endswith(".parquet")]
    body = [f for f in df.schema.fields if f.name not in partitions]
    if files.local("") is not None:
        with ThreadPoolExecutor(8) as pool:
            stats = list(pool.map(lambda e: footer_stats(files.local(f"{folder}/{e.path}"), body), entries))
    else:
        stats = _counted(df, f"{root.rstrip('/')}/{folder}", entries, body)
    return Staged(folder, [(e, s) for e, s in zip(entries, stats) if s["numRecords"]])


def _counted(df: DataFrame, path: str, entries: list[Entry], body: list[T.StructField]) -> list[dict]:
    """Rows, bounds and null counts of each file, by a job: for stores whose files this process cannot open."""
    read = df.sparkSession.read.schema(T.StructType(body)).option("recursiveFileLookup", "true").parquet(path)
    bounded = [f.name for f in body if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampNTZType, T.StringType))]
    flat = [f.name for f in body if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    asked = [F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(flat)]]
    for i, c in enumerate(bounded):
        v = F.col(f"`{c}`")
        if isinstance(read.schema[c].dataType, (T.FloatType, T.DoubleType)):
            asked.append(F.max(F.isnan(v)).alias(f"odd{i}"))
        text = isinstance(read.schema[c].dataType, (T.DateType, T.TimestampNTZType))  # Python cannot hold all of these
        asked += [(f(v).cast("string") if text else f(v)).alias(f"{n}{i}") for n, f in (("lo", F.min), ("hi", F.max))]
    rows = read.groupBy(F.col("_metadata.file_path").alias("f")).agg(*asked).collect()  # a row for each file that was written
    # Spark names a file by its whole location: what comes after the staging folder is its path there.
    mark = f"/{path.rstrip('/').rpartition('/')[2]}/"
    found = {unquote(r["f"]).rpartition(mark)[2]: r for r in rows}
    return [_stats_of_row(found.get(e.path), bounded, flat) for e in entries]


def _stats_of_row(r: Row | None, bounded: list[str], flat: list[str]) -> dict:
    if r is None:
        return {"numRecords": 0}
    low, high = {}, {}
    for i, c in enumerate(bounded):
        if r[f"odd{i}"] if f"odd{i}" in r else False:
            continue
        for out, value, upper in ((low, r[f"lo{i}"], False), (high, r[f"hi{i}"], True)):
            value = value.replace(" ", "T") if isinstance(value, str) and _MOMENT.fullmatch(value) else value
            if (plain := _plain(value, upper)) is not None:
                out[c] = plain
    return {"numRecords": r["n"], "minValues": low, "maxValues": high, "nullCount": {c: r["n"] - r[f"c{i}"] for i, c in enumerate(flat)}}


def _plain(value: object, upper: bool) -> object:
    """A bound as JSON holds it, or None where it would not be exact."""
    if isinstance(value, bool) or value is None or isinstance(value, (bytes, bytearray)):
        return None
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, decimal.Decimal):
        return float(value) if decimal.Decimal(repr(float(value))) == value else None
    if isinstance(value, datetime.datetime):
        return value.isoformat(timespec="microseconds") if value.tzinfo is None else None
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, str):
        return value if len(value) <= STATS_TEXT else (None if upper else value[:STATS_TEXT])
    return value


def footer_stats(path: str, body: list[T.StructField]) -> dict:
    """Rows, bounds and null counts as the file's footer gives them. Nested columns, booleans and binaries have no bounds."""
    meta = pq.read_metadata(path)
    names = {f.name for f in body if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))}
    floats = {f.name for f in body if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    low: dict[str, list] = {}
    high: dict[str, list] = {}
    nulls: dict[str, int] = {}
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            column = group.column(c)
            name = column.path_in_schema
            if name not in names:
                continue
            s = column.statistics
            if s is None or not s.has_null_count:
                nulls[name] = -1 << 62
            else:
                nulls[name] = nulls.get(name, 0) + s.null_count
            if s is not None and s.has_min_max:
                try:
                    low.setdefault(name, []).append(s.min), high.setdefault(name, []).append(s.max)
                except (ValueError, OverflowError, NotImplementedError):  # dates that Python cannot hold
                    low.setdefault(name, []).append(None), high.setdefault(name, []).append(None)
            elif s is None or not s.has_null_count or s.null_count < group.num_rows:
                low.setdefault(name, []).append(None), high.setdefault(name, []).append(None)
    bounds: tuple[dict, dict] = ({}, {})
    for name in low:
        if None in low[name] or None in high[name] or name in floats and any(isinstance(v, float) and math.isnan(v) for v in low[name] + high[name]):
            continue
        for out, value, upper in ((bounds[0], min(low[name]), False), (bounds[1], max(high[name]), True)):
            if (plain := _plain(value, upper)) is not None:
                out[name] = plain
    return {"numRecords": meta.num_rows, "minValues": bounds[0], "maxValues": bounds[1], "nullCount": {k: v for k, v in nulls.items() if v >= 0}}


def publish(staged: Staged, files: LocalFiles | HadoopFiles, partitions: list[str]) -> list[dict]:
    """Move the files to their places and return the actions that add them. Until a commit names them they are part of no version."""

    def one(item: tuple[Entry, dict]) -> dict:
        entry, stats = item
        files.move(f"{staged.folder}/{entry.path}", entry.path)
        folders = entry.path.split("/")[:-1]
        values = dict(zip(partitions, (None if v == _NULL_FOLDER else unescape(v) for v in (f.partition("=")[2] for f in folders))))
        return {"add": {"path": escape_path(entry.path), "partitionValues": values, "size": entry.size, "modificationTime": entry.modified, "dataChange": True, "stats": json.dumps(stats, separators=(",", ":"))}}

    with ThreadPoolExecutor(8) as pool:
        adds = list(pool.map(one, staged.entries))
    files.delete(staged.folder)
    return adds


def removal(add: dict) -> dict:
    return {"remove": {"path": add["path"], "deletionTimestamp": log.now(), "dataChange": True, "partitionValues": add["partitionValues"], "size": add["size"]}}
