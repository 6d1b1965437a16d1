"""Hashed byte n-grams of whole texts, and bounded samples of them for fitting."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Saved, binary_list

_BLOCK = 1 << 20
#: Groups of a draw whose sizes are broadcast, about 4 MB; more are shuffled.
BROADCAST_GROUPS = 100_000


def ngrams(text: bytes | None, table: bytes | None, bins: int) -> np.ndarray:
    """Square roots of the shares of the hashed 1-, 2- and 3-grams of a text's bytes: a vector of length 1, or zero for no text.

    `table` maps bytes first, as bytes.translate does.
    """
    counts = np.zeros(bins, np.int64)
    if text:
        b = np.frombuffer(text.translate(table) if table else text, np.uint8)
        shift = np.uint32(33 - int(bins).bit_length())
        for at in range(0, len(b), _BLOCK):
            x = b[at : at + _BLOCK + 2].astype(np.uint32)
            n = min(_BLOCK, len(x))
            y = x[:n] * np.uint32(0x9E3779B1) + np.uint32(0x7F4A7C15)
            counts += np.bincount((y * np.uint32(0x85EBCA6B)) >> shift, minlength=bins)
            for j in (1, 2):
                m = min(n, len(x) - j)
                if m <= 0:
                    break
                y = (y[:m] ^ (y[:m] >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + x[j : j + m] * np.uint32(0x9E3779B1)
                counts += np.bincount((y * np.uint32(0x85EBCA6B)) >> shift, minlength=bins)
    total = counts.sum()
    return np.sqrt(counts / total).astype(np.float32) if total else counts.astype(np.float32)


def vectors(docs: DataFrame, f: Callable[[bytes | None], np.ndarray]) -> DataFrame:
    """The columns of `docs` but text, its last, and `x`, the bytes of the vector that `f` makes of the text."""
    rest = docs.columns[:-1]
    schema = ", ".join([f"`{c}` {t}" for c, t in docs.dtypes[:-1]] + ["x binary"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = [f(t).tobytes() for t in binary_list(batch.column(len(rest)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(x, pa.binary())], names=[*rest, "x"])

    return docs.mapInArrow(run, schema)


def drawn(docs: DataFrame, group: str, wanted: int, seed: int) -> DataFrame:
    """(group, order, text) of about `wanted` texts of each group, or of all if there are fewer, drawn by hash; `group` is never null.

    Rows that repeat a doc_id and text are one, so a row repeated very often is drawn once or not at all and crowds out none. Slightly
    more than `wanted` come back; those of the least `order` are the draw.
    """
    key = F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text"))
    rows = docs.select(group, key.alias("order"), "text")
    sizes = Saved(rows.groupBy(F.col(group).alias("of")).agg(F.approx_count_distinct("order", 0.02).alias("n")), "sizes").df
    few = sizes.count() <= BROADCAST_GROUPS
    share = F.when(F.col("n") <= wanted, 1.0).otherwise(1.2 * (wanted + 4 * wanted**0.5) / F.col("n"))
    rows = rows.join(F.broadcast(sizes) if few else sizes, F.col(group) == F.col("of"))
    rows = rows.where(F.pmod("order", F.lit(1 << 40)) < share * float(1 << 40))
    return rows.groupBy(group, "order").agg(F.first("text").alias("text"))


def matrix(rows: list, width: int) -> np.ndarray:
    return np.stack([np.frombuffer(r["x"], np.float32) for r in rows]) if rows else np.zeros((0, width), np.float32)
