"""What several operators share: scratch tables, Arrow access, word hashing, row numbers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_own_dirs: dict[str, str] = {}
_cleaned: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one of our own only where that is unset and all runs in one process."""
    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster, tables in between need a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="tidelake-scratch-")
        atexit.register(shutil.rmtree, _own_dirs[app], ignore_errors=True)
    return f"file://{_own_dirs[app]}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a table; all such tables of an application go when the driver ends."""
    own = f"{scratch_root(spark)}/tidelake/{spark.sparkContext.applicationId}"
    if own not in _cleaned:
        _cleaned.add(own)
        atexit.register(_clean, spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


def _clean(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the application may be gone already
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Saved:
    """A frame written as Parquet in the shared folder and read again, which cuts its lineage."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, scratch_path(df.sparkSession, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)


def fold(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null where the id is null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def binary_list(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column of an Arrow batch."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """While it holds, what runs hands Python so many rows at once: for rows that carry much."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str, rows_per_bucket: int = 20_000, key_bound: int | None = None) -> DataFrame:
    """Adds a gapless number from 0 within each key, in an order that is fixed but not that of `order`.

    A key may hold most rows: each is dealt into buckets by the hash of `order`, numbered inside its bucket, and shifted by
    what the buckets before it hold. Only the counts of (key, bucket) meet, one row per 20,000 rows or so. They are broadcast
    where `key_bound`, the most keys there can be, holds them under a million rows, and shuffled otherwise.
    Ties in `order` are numbered in any order; null keys form one key. Rows equal in `order` fall into one bucket, so it should tell rows apart.
    """
    n = max(1, -(-df.count() // rows_per_bucket))
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(n)).cast("int"))
    counts = dealt.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__bucket").alias("__b"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    inner = dealt.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys, "__bucket").orderBy(*order)))
    on = F.col("__bucket") == F.col("__b")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    small = key_bound is not None and key_bound * n <= 1_000_000
    joined = inner.join(F.broadcast(shifts) if small else shifts, on, "left")
    return joined.withColumn(out, (F.col("__shift") + F.col("__rank") - 1).cast("long")).drop("__bucket", "__n", "__rank", "__b", "__shift", *[f"__k{i}" for i in range(len(keys))])
