"""Embedding near-duplicates by tiles in principal-component order.

Equal vectors of a label become one, with its number. The principal axes come from a bounded sample; turning vectors onto them changes
no cosine, so the sample only decides how soon comparisons stop. Within a label, vectors are sorted along the first axis and cut into
sheets, which are sent whole, and these into tiles. Sheets are paired by a range join along the first axis, and two sheets, or two tiles
of theirs, are compared unless their ranges along the leading axes lie further apart than linked vectors can. Within a pair of tiles
the products of the leading dimensions are summed first; a pair of vectors goes on to the next dimensions only while its sum and the
product of the norms of what is left can reach the threshold. Pairs that stay are confirmed on the vectors as given.

A pair of sheets returns a row per linked vector: how many vectors it links to, and one link that keeps its component together. So a crowd of
near copies gives rows in proportion to its sheets, not to its pairs. Where all vectors of a label lie near each other, its sheets meet each
other, so the work is quadratic there, as the method is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..deploy import ship
from .common import Saved, small_batches
from .components import components

TILE, SAMPLE, AXES = 1024, 20_000, 8
#: Bytes of a sheet, which has a tile at least.
SHEET_BYTES = 4 << 20
STEPS = (8, 24)  # dimensions after which products are weighed
ROUNDING = 1e-9


def _axes(vectors: DataFrame, dim: int, sample: int) -> np.ndarray:
    """Principal axes, widest first, of at most `sample` vectors of a length drawn by hash."""
    rows = vectors.where(F.col("dim") == dim).orderBy(F.xxhash64("rep"), "rep").limit(sample).select("x").collect()
    x = np.array([r["x"] for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    _, v = np.linalg.eigh(x.T @ x)
    return v[:, ::-1].copy()


_TILE = "label long, dim int, tile long, n int, lo array<double>, hi array<double>, ids binary, times binary, data binary"


def _sheets(vectors: DataFrame, axes: dict[int, np.ndarray], tile: int, sheet_bytes: int) -> DataFrame:
    """Rows come sorted by label, length and first component within partitions. Vectors of very many components make small sheets."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            label, dim = held[0][:2]
            x = np.array([r[4] for r in held], np.float64)
            y = (x / np.linalg.norm(x, axis=1, keepdims=True) @ axes[dim])[:, :AXES]
            cols = [[label], [dim], [held[0][2]], [len(held)], [y.min(axis=0).tolist()], [y.max(axis=0).tolist()], [np.array([r[2] for r in held], np.int64).tobytes()], [np.array([r[3] for r in held], np.int64).tobytes()], [x.tobytes()]]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["label", "dim", "tile", "n", "lo", "hi", "ids", "times", "data"])

        for batch in it:
            for row in zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "rep", "times", "x"))):
                if held and (row[:2] != held[0][:2] or len(held) >= max(min(tile, max(1, sheet_bytes // (8 * row[1]))), sheet_bytes // (8 * row[1]) // tile * tile)):
                    yield out()
                    held = []
                held.append(row)
        if held:
            yield out()

    return vectors.mapInArrow(run, _TILE)


def linked(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b whose cosine is at least the threshold."""
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    x, y = a / na[:, None] @ axes, b / nb[:, None] @ axes
    edges = [0, *(s for s in STEPS if s < x.shape[1]), x.shape[1]]
    rest = lambda v, k: np.sqrt(np.maximum(0, (v[:, k:] ** 2).sum(axis=1)))
    k = edges[1]
    sums = x[:, :k] @ y[:, :k].T
    i, j = np.nonzero(sums + np.outer(rest(x, k), rest(y, k)) >= threshold - ROUNDING)
    sums = sums[i, j]
    for k, end in zip(edges[1:], edges[2:]):
        rx, ry = rest(x, end), rest(y, end)
        keep_i, keep_j, keep_s = [], [], []
        for at in range(0, len(i), 1 << 18):
            p, q = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
            s = sums[at : at + (1 << 18)] + np.einsum("nd,nd->n", x[p, k:end], y[q, k:end])
            alive = s + rx[p] * ry[q] >= threshold - ROUNDING
            keep_i.append(p[alive]), keep_j.append(q[alive]), keep_s.append(s[alive])
        i, j, sums = (np.concatenate(v) if v else np.zeros(0, t) for v, t in ((keep_i, np.int64), (keep_j, np.int64), (keep_s, np.float64)))
    sure = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 18):
        p, q = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
        sure[at : at + (1 << 18)] = np.einsum("nd,nd->n", a[p], b[q]) / (na[p] * nb[q]) >= threshold
    return i[sure], j[sure]


def _boxes(x: np.ndarray, axes: np.ndarray, tile: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, least, greatest) of each tile along the leading axes."""
    y = x / np.linalg.norm(x, axis=1, keepdims=True) @ axes[:, :AXES]
    return [(at, min(at + tile, len(x)), y[at : at + tile].min(axis=0), y[at : at + tile].max(axis=0)) for at in range(0, len(x), tile)]


def _linked_sheets(a: np.ndarray, b: np.ndarray, same: bool, axes: np.ndarray, threshold: float, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two sheets whose cosine is at least the threshold, tile by tile; of a sheet with itself, each pair once."""
    reach, out = 2 - 2 * threshold + ROUNDING, [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for i0, i1, low_i, high_i in _boxes(a, axes, tile):
        for j0, j1, low_j, high_j in _boxes(b, axes, tile):
            if (same and j0 < i0) or (np.maximum(0, np.maximum(low_i - high_j, low_j - high_i)) ** 2).sum() > reach:
                continue
            i, j = linked(a[i0:i1], b[j0:j1], axes, threshold)
            i, j = i + i0, j + j0
            out.append((i[i < j], j[i < j]) if same else (i, j))
    return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])


def _compared(pairs: DataFrame, axes: dict[int, np.ndarray], threshold: float, tile: int) -> DataFrame:
    """(node, links, other): for each vector of a pair of sheets that has a link there, how many vectors it links to, and a link."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for r in range(batch.num_rows):
                get = lambda name, kind: np.frombuffer(batch.column(name)[r].as_buffer(), kind)  # noqa: E731, B023
                dim, same = batch.column("dim")[r].as_py(), batch.column("a")[r] == batch.column("b")[r]
                ia, ta, ib, tb = get("ids_a", np.int64), get("times_a", np.int64), get("ids_b", np.int64), get("times_b", np.int64)
                a, b = get("data_a", np.float64).reshape(-1, dim), get("data_b", np.float64).reshape(-1, dim)
                i, j = _linked_sheets(a, b, same, axes[dim], threshold, tile)
                if not len(i):
                    continue
                # Vectors of both sheets are numbered together; a sheet paired with itself counts once.
                j = j if same else j + len(ia)
                ids = ia if same else np.concatenate([ia, ib])
                times = ta if same else np.concatenate([ta, tb])
                links = np.bincount(i, times[j], len(ids)) + np.bincount(j, times[i], len(ids))
                least = np.arange(len(ids))
                while True:  # least vector of the component within this pair of sheets
                    low = least.copy()
                    np.minimum.at(low, i, least[j])
                    np.minimum.at(low, j, least[i])
                    low = np.minimum(low, low[low])
                    if (low == least).all():
                        break
                    least = low
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at], pa.int64()), pa.array(links[at].astype(np.int64)), pa.array(ids[least[at]], pa.int64())], names=["node", "links", "other"])

    return pairs.mapInArrow(run, "node long, links long, other long")


def near_vectors(table: DataFrame, threshold: float = 0.93, tile: int = TILE, sample: int = SAMPLE, sheet_bytes: int = SHEET_BYTES) -> DataFrame:
    """Every row of `table` (vec_id, embedding, label) with its links and component.

    Vectors of the same label, and length, are linked at a cosine of `threshold` or more, in double precision. Returns vec_id, n_links (other
    rows linked directly), component_id (smallest vec_id reachable, its own included) and kept (vec_id = component_id).
    A vector that is null, empty or zero, or holds a null, NaN or infinity, or whose label or vec_id is null, links with nothing; its
    component is its own vec_id, and a null vec_id is not kept. Repeated rows are vectors that link, one vec_id with several vectors among
    them: it is then one node. Other columns are ignored; an empty table gives no rows.
    """
    spark = table.sparkSession
    ship(spark)
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & F.exists("x", lambda v: v != 0), F.lit(False))
    rows = rows.withColumn("good", good).withColumn("h", F.struct(F.xxhash64(F.lit(1), "x"), F.xxhash64(F.lit(2), "x")))  # 128 bits stand for a vector
    usable = rows.where("good")
    reps = Saved(usable.groupBy("label", "h").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("times"), F.first("x").alias("x")).select("label", F.size("x").alias("dim"), "rep", "times", "h", "x"), "vectors")
    dims = [r["dim"] for r in reps.df.select("dim").distinct().collect()]
    axes = {d: _axes(reps.df, d, sample) for d in dims}
    first = F.coalesce(*[F.when(F.col("dim") == d, F.aggregate(F.zip_with("x", F.array(*[F.lit(float(v)) for v in axes[d][:, 0]]), lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)) for d in dims], F.lit(0.0))
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    size = reps.df.agg(F.sum(F.col("dim").cast("long")).alias("s")).first()["s"] or 0
    n = max(1, -(-8 * size // (16 * sheet_bytes)))
    sorted_ = reps.df.select("label", "dim", "rep", "times", "x", (first / length).alias("y")).repartitionByRange(n, "label", "dim", "y", "rep").sortWithinPartitions("label", "dim", "y", "rep").drop("y")
    sheets = Saved(_sheets(sorted_, axes, tile, sheet_bytes), "sheets")
    reach = 2 - 2 * threshold + ROUNDING
    # Along the first axis linked vectors lie within sqrt(reach). A sheet meets those that begin in its range or so much above it, so each
    # pair comes once, from the sheet that begins first.
    cell = lambda v: F.floor(v / reach**0.5)
    about = sheets.df.select("label", "dim", "tile", "lo", "hi")
    a = about.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")[0]), cell(F.col("hi")[0]) + 1))).alias("a")
    b = about.withColumn("cell", cell(F.col("lo")[0])).alias("b")
    gap = F.aggregate(
        F.zip_with(F.arrays_zip("a.lo", "a.hi"), F.arrays_zip("b.lo", "b.hi"), lambda p, q: F.greatest(F.lit(0.0), p["lo"] - q["hi"], q["lo"] - p["hi"])),
        F.lit(0.0), lambda s, v: s + v * v,
    )
    after = (F.col("a.lo")[0] < F.col("b.lo")[0]) | ((F.col("a.lo")[0] == F.col("b.lo")[0]) & (F.col("a.tile") <= F.col("b.tile")))
    wanted = a.join(b, (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim")) & (F.col("a.cell") == F.col("b.cell")) & after & (gap <= reach)).select(F.col("a.tile").alias("a"), F.col("b.tile").alias("b"), F.col("a.dim").alias("dim"), F.col("a.label").alias("label"))
    wanted = Saved(wanted, "pairs")
    side = lambda s: sheets.df.select(F.col("label"), F.col("dim"), F.col("tile").alias(s), F.col("ids").alias(f"ids_{s}"), F.col("times").alias(f"times_{s}"), F.col("data").alias(f"data_{s}"))
    joined = wanted.df.join(side("a"), ["label", "dim", "a"]).join(side("b"), ["label", "dim", "b"])
    with small_batches(spark, 2):
        found = Saved(_compared(joined, axes, threshold, tile), "links")
    groups = components(found.df.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.df.groupBy("node").agg(F.sum("links").alias("links"))
    named = reps.df.select("label", "h", "rep", "times").join(counts.withColumnRenamed("node", "rep"), "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select(F.col("label").alias("l"), F.col("h").alias("v"), (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "rep").alias("c"))
    named = Saved(named, "named").df
    for table in (sheets, wanted, found):
        table.drop()
    out = rows.select("vec_id", "label", "good", "h").join(named, F.col("good") & (F.col("label") == F.col("l")) & (F.col("h") == F.col("v")), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
