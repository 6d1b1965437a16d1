"""The entry point: a connection to a place, its tables, and Spark SQL over any version of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import errors
from .deploy import ship
from .operators.session import WriteResult, WriteSession
from .operators.telemetry import WriteStats
from .plans import options as write_options
from .plans.windows import Window
from .sources import connection, location, storage
from .sources.snapshot import Predicate, Snapshot


def _refuse(problems: list[str]) -> None:
    """One error for all problems that an offline check has found."""
    if problems:
        raise errors.LakeError(problems[0][:8], "; ".join(p.partition(": ")[2].partition(". Next step: ")[0] for p in problems), problems[0].partition(". Next step: ")[2])


class LakeTable:
    def __init__(self, lake: Lake, name: str, path: str | None = None):
        self.lake, self.name = lake, name
        self.root = lake.place(name, path)

    def snapshot(self, version: object = None) -> Snapshot:
        """The table at a version, the latest by default."""
        wanted = connection.parse_version(version)
        try:
            return Snapshot.load(self.lake.spark, self.root, wanted, self.name)
        except Exception as e:
            raise errors.translate(e, "read", f"read of {self.name}") from e

    def schema(self, version: object = None) -> T.StructType:
        """The schema as the log has it, without a job."""
        return self.snapshot(version).schema

    def read(self, version: object = None, window: Window | None = None, where: list[Predicate] | None = None, union_by_name: bool = True) -> DataFrame:
        """The rows of a version; `where` and `window` skip files by the log before Spark filters rows.

        The log has the columns, and files are matched to them by name, so `union_by_name` changes nothing: columns that a file lacks are null.
        """
        _refuse(connection.check_read({"union_by_name": union_by_name}))
        return self.snapshot(version).scan(where or (), window)

    def view(self, name: str, version: object = None) -> DataFrame:
        """Register a version as a temporary view for Spark SQL."""
        df = self.read(version)
        df.createOrReplaceTempView(name)
        return df

    def count(self, version: object = None) -> int:
        """Rows, from the log alone where every file has statistics."""
        return self.snapshot(version).count()

    def begin(self, schema: T.StructType, strategy: str, keys: list[str] | None = None, options: dict | None = None, schema_policy: str | None = None, order_by: list[str] | None = None, incremental: bool = False, duplicates: str | None = None, keep_concurrent: bool = False) -> WriteSession:
        spec = write_options.parse(strategy, options, keys, schema_policy, incremental, duplicates)
        root = self.lake.place(self.name, spec.path) if spec.path else self.root
        return WriteSession(self.lake.spark, root, spec, schema, order_by, self.lake.stats, self.name, keep_concurrent)

    def write(self, frames: DataFrame | list[DataFrame], strategy: str, keys: list[str] | None = None, **how) -> WriteResult:
        """One session over some frames, in the order given."""
        frames = frames if isinstance(frames, list) else [frames]
        if not frames:
            raise ValueError("without a frame there is no schema; begin a session instead")
        session = self.begin(frames[0].schema, strategy, keys, **how)
        for df in frames:
            session.write(df)
        return session.commit()

    def append(self, frames: DataFrame | list[DataFrame], **how) -> WriteResult:
        return self.write(frames, "append", **how)

    def replace(self, frames: DataFrame | list[DataFrame], **how) -> WriteResult:
        return self.write(frames, "replace", **how)

    def merge(self, frames: DataFrame | list[DataFrame], keys: list[str], **how) -> WriteResult:
        return self.write(frames, "merge", keys, **how)


class Lake:
    """A place with credentials. Options are checked offline, all problems at once; opening a table is the test of the place."""

    def __init__(self, spark: SparkSession, root: str, **options):
        _refuse(connection.check_connection({"root": root, **options}))
        self.spark, self.root, self.stats, self.options = spark, root.rstrip("/") or "/", WriteStats(), {"root": root, **options}
        storage.hadoop_uri(self.root, self.options)
        storage.apply(spark, {"root": root, **options})
        ship(spark)

    def place(self, name: str, path: str | None = None) -> str:
        """Where a table lies, in the scheme under which Hadoop opens it."""
        return storage.hadoop_uri(location.resolve(self.root, name, path), self.options)

    def table(self, name: str, path: str | None = None) -> LakeTable:
        if path is not None:
            _refuse(connection.check_read({"path": path}))
        return LakeTable(self, name, path)

    def check(self) -> bool:
        """Always true: there is nothing to learn before a table is opened."""
        return True
