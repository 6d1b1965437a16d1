"""A write session: begin, hand over frames in order, commit or abort."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import errors
from ..functions.predicate import merge_text
from ..plans import guards
from ..plans.options import WriteSpec
from ..plans.reconcile import check_incoming, reconcile
from ..sources import log
from ..sources.files import files_of
from ..sources.snapshot import Snapshot, spare
from . import merge as merging
from . import staging
from .telemetry import WriteStats


@dataclass(frozen=True)
class WriteResult:
    rows: int  # handed over, before repeats were resolved
    frames: int
    version: int | None
    partition_filter: dict[str, list[str]] | None = None  # of a merge: the values that its files were narrowed to
    filter_skipped: str | None = None  # or why they were not


#: Estimated bytes up to which a merge's input is held by the driver, and rows of it.
LOCAL_BYTES, LOCAL_ROWS = 8 << 20, 50_000


def _estimated(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


class WriteSession:
    """Nothing that is handed over is visible before `commit`, which makes one version, or none where there is nothing to do."""

    def __init__(self, spark: SparkSession, root: str, spec: WriteSpec, schema: T.StructType, order_by: list[str] | None = None, stats: WriteStats | None = None, name: str = "output", keep_concurrent: bool = False):
        self.spark, self.root, self.spec, self.name = spark, root, spec, name
        self.order_by, self.stats, self.keep_concurrent = order_by, stats or WriteStats(), keep_concurrent
        self.frames: list[DataFrame] = []
        self.ended = ""
        check_incoming(schema, spec)
        self.files = files_of(spark, root)
        try:
            self.snapshot = self._open_or_create(schema)
        except Exception as e:
            raise errors.translate(e, "write", f"open of {name}") from e
        log.check_write(self.snapshot.state, removes=spec.strategy == "replace")
        self.schema = reconcile(self.snapshot.schema, self.snapshot.partition_columns, schema, spec)
        self.incoming = schema

    def _open_or_create(self, schema: T.StructType) -> Snapshot:
        """Only the absence of a table leads to its creation; of several creators one wins and the others open what it made."""
        if log.replay(self.spark, self.root, self.files) is None:
            partitions = list(self.spec.partition_by or [])
            actions = [{"protocol": log.protocol_for(schema)}, {"metaData": log.metadata_for(schema, partitions)}, log.commit_info("CREATE TABLE", {"mode": "ErrorIfExists"}, None)]
            self.stats.tried()
            if log.write_commit(self.files, 0, actions):
                self.stats.committed()
        return Snapshot.load(self.spark, self.root)

    def _check_open(self) -> None:
        if self.ended:
            raise RuntimeError(f"the session was {self.ended} already")

    def write(self, df: DataFrame) -> None:
        """Hand over a frame. Its columns must be those the session began with."""
        self._check_open()
        if [(f.name, f.dataType) for f in df.schema.fields] != [(f.name, f.dataType) for f in self.incoming.fields]:
            raise errors.LakeError(errors.SCHEMA_MISMATCH, "a frame differs from the schema that the session began with", "begin a session for it")
        self.frames.append(df)

    def abort(self) -> None:
        self._check_open()
        self.ended, self.frames = "aborted", []

    def commit(self) -> WriteResult:
        self._check_open()
        self.ended = "committed"
        run = {"append": self._append, "replace": self._replace, "merge": self._merge}[self.spec.strategy]
        try:
            return run()
        except Exception as e:
            raise errors.translate(e, "merge" if self.spec.strategy == "merge" else "write", f"{self.spec.strategy} of {self.name}", self.spec.keys, self.spec.merge_predicate is not None) from e

    def _metadata(self) -> list[dict]:
        """The actions that widen the table, in the same commit as the rows."""
        if self.schema == self.snapshot.schema:
            return []
        out = [{"metaData": log.metadata_for(self.schema, self.snapshot.partition_columns, self.snapshot.state.metadata)}]
        wanted = log.protocol_for(self.schema)
        if log.has_ntz(self.schema) and log.NTZ_FEATURE not in (self.snapshot.state.protocol.get("readerFeatures") or []):
            out.insert(0, {"protocol": wanted})
        return out

    def _all(self) -> DataFrame:
        df = self.frames[0]
        for more in self.frames[1:]:
            df = df.unionByName(more)
        return df

    def _staged(self, df: DataFrame) -> staging.Staged:
        return staging.stage(df, self.files, self.root, self.snapshot.partition_columns, self.spec.target_file_bytes)

    def _watched(self, df: DataFrame) -> staging.Staged:
        """Stage a frame and refuse what the guards saw in it; a refusal leaves no file."""
        watch = guards.Watch(self.schema, self.snapshot.partition_columns, [])
        try:
            staged = self._staged(watch.on(df))
        except Exception:
            guards.enforce(watch.ask(df))  # a folder's name may have been too long, which file systems tell in many ways
            raise
        try:
            guards.enforce(watch.findings())
        except errors.LakeError:
            self.files.delete(staged.folder)
            raise
        return staged

    def _publish(self, staged: staging.Staged | None, removed: list[dict], operation: str, parameters: dict, blind: bool) -> int:
        try:
            log.check_write(self.snapshot.state, bool(removed))
        except errors.LakeError:
            if staged:
                self.files.delete(staged.folder)
            raise
        self.stats.tried()
        adds = staging.publish(staged, self.files, self.snapshot.partition_columns) if staged else []
        metrics = {"numFiles": len(adds), "numRemovedFiles": len(removed), "numOutputRows": staged.rows if staged else 0}
        actions = [*self._metadata(), *[staging.removal(a) for a in removed], *adds, log.commit_info(operation, parameters, self.snapshot.version, metrics)]
        version = log.commit(self.files, self.snapshot.version, actions, blind and not self._metadata())
        self.stats.committed(sum(a["add"]["size"] for a in adds))
        return version

    def _append(self) -> WriteResult:
        if not self.frames:
            return WriteResult(0, 0, None)
        staged = self._watched(merging.frame_in(self.schema, self._all()))
        if not staged.entries and not self._metadata():
            self.files.delete(staged.folder)
            return WriteResult(0, len(self.frames), None)
        version = self._publish(staged, [], "WRITE", {"mode": "Append"}, blind=True)
        return WriteResult(staged.rows, len(self.frames), version)

    def _replace(self) -> WriteResult:
        """All files of the version that the session saw go; without a frame nothing takes their place."""
        removed = self.snapshot.files
        if not self.frames:
            version = self._publish(None, removed, "DELETE", {}, blind=self.keep_concurrent)
            return WriteResult(0, 0, version)
        staged = self._watched(merging.frame_in(self.schema, self._all()))
        version = self._publish(staged, removed, "WRITE", {"mode": "Overwrite"}, blind=self.keep_concurrent)
        return WriteResult(staged.rows, len(self.frames), version)

    def _ordered(self, df: DataFrame, ordinal: int, name: str) -> DataFrame:
        """Later frames win; within a frame, order_by if given, else the order in which Spark reads the rows."""
        inner: list[Column] = [F.col(f"`{c}`") for c in self.order_by or []]
        return df.withColumn(name, F.struct(F.lit(ordinal).alias("frame"), *[c.alias(f"o{i}") for i, c in enumerate(inner)], F.monotonically_increasing_id().alias("row")))

    def _merge(self) -> WriteResult:
        if not self.frames:
            return WriteResult(0, 0, None)
        watch = guards.Watch(self.schema, self.snapshot.partition_columns, self.spec.keys)
        order = spare("__order", self.incoming.names)
        numbered = [self._ordered(df, i, order) for i, df in enumerate(self.frames)]
        joined = numbered[0]
        for more in numbered[1:]:
            joined = joined.unionByName(more)
        rows = merging.last_rows(watch.on(joined), self.spec.keys, order).select(*[F.col(f"`{c}`") for c in self.incoming.names])
        once = f"{staging.STAGING}/{uuid.uuid4().hex}"
        path, local = f"{self.root.rstrip('/')}/{once}", None
        try:
            if _estimated(joined) <= LOCAL_BYTES:
                local = rows.limit(LOCAL_ROWS + 1).toArrow()
                local = local if local.num_rows <= LOCAL_ROWS else None
            if local is None:
                rows.write.parquet(path)
                if sum(e.size for e in self.files.walk(once)) <= LOCAL_BYTES // 8:  # the estimate was too high, or there was none
                    local = self.spark.read.schema(self.incoming).parquet(path).select(*[F.col(f"`{c}`") for c in self.incoming.names]).limit(LOCAL_ROWS + 1).toArrow()
                    local = local if local.num_rows <= LOCAL_ROWS else None
            found = watch.findings()
            guards.enforce(found)
            if not found.rows and not self._metadata():
                return WriteResult(0, len(self.frames), None)
            last = self.spark.read.schema(self.incoming).parquet(path) if local is None else self.spark.createDataFrame(local, self.incoming)
            plan = merging.MergePlan(self.snapshot, self.schema, self.spec, last, local)
            candidates = plan.candidates()
            touched = plan.touched(candidates)
            staged = self._staged(plan.result(candidates, touched))
            if not touched and not staged.entries and not self._metadata():
                self.files.delete(staged.folder)
                return WriteResult(found.rows, len(self.frames), None)
            derived = plan.derived()
            parameters = {"keys": self.spec.keys, "statement": merge_text(self.incoming.names, self.spec.keys, self.spec.merge_predicate, self.schema.names, derived.filters)}
            if derived.reason:
                parameters["partitionFilterSkipped"] = derived.reason
            version = self._publish(staged, touched, "MERGE", parameters, blind=False)
            return WriteResult(found.rows, len(self.frames), version, derived.filters, derived.reason)
        finally:
            self.files.delete(once)
