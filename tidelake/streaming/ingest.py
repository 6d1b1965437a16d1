"""A stream written into a table, one version per micro-batch that has rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ..catalog import LakeTable


def into_table(stream: DataFrame, table: LakeTable, keys: list[str], checkpoint: str, **how) -> DataStreamWriter:
    """A writer that merges each micro-batch by keys. A batch that Spark repeats after a failure merges to the same rows, so the
    result is effectively once; an append would not be."""

    def one(batch: DataFrame, _: int) -> None:
        table.merge(batch, keys, **how)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
