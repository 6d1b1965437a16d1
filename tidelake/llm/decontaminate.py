"""Benchmark decontamination by an FM-index per shard of the training text.

The alphabet is the vocabulary of the benchmark's items; every other word of a document is a separator. An occurrence of a window
lies within one run of alphabet words, so runs shorter than the shortest window cannot hold one and stay out of the index. The
runs of a shard, those of HELD_BYTES of text until the index has SHARD symbols, are sorted by suffix; a longer run is split into pieces
that overlap by a window less one word. The resulting transform is held as a wavelet matrix. The windows whose words all occur in the
shard are searched backwards at once, each step two rank queries a window; the occurrences are located by stepping back to a
sampled suffix position; their spans are merged for each document.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..deploy import ship
from .common import Saved, binary_list

#: Symbols of an index at most, its separators included, and the distance of sampled suffix positions.
SHARD, SAMPLE = 1_000_000, 16
#: Documents held at most at once, in bytes of text; a longer one is held alone.
HELD_BYTES = 4 << 20
#: Bytes of benchmark text that are broadcast at once, some 30 MB of patterns; a larger benchmark is searched in that many blocks in turn.
BLOCK_BYTES = 8 << 20
#: Rows with a hit that are broadcast when there are several blocks; more are shuffled.
BROADCAST_HITS = 100_000

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_LOWER).split() if text else []


class Patterns:
    """The distinct windows of some items, by length, and the items that each belongs to.

    `text` is the items' words as symbols, item after item; a window is a place there. So some 20 bytes are held for each word.
    """

    def __init__(self, items: list[tuple[object, bytes | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names = [None if item is None else str(item) for item, _ in items]
        each = [np.fromiter((self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)), np.int32) for _, text in items]
        self.text = np.concatenate([np.zeros(0, np.int32), *each])
        ends = np.cumsum([len(x) for x in each], dtype=np.int64)
        by_length: dict[int, list] = defaultdict(list)
        for i, (x, end) in enumerate(zip(each, ends)):
            if len(x):
                n = min(window, len(x))
                by_length[n].append((np.arange(end - len(x), end - n + 1), np.full(len(x) - n + 1, i)))
        #: (length, places of distinct windows, where each one's owners begin, owners as numbers of items)
        self.groups: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for n in sorted(by_length):
            places, owners = (np.concatenate(c) for c in zip(*by_length[n]))
            rows = np.ascontiguousarray(self.text[places[:, None] + np.arange(n)])
            _, first, kind = np.unique(rows.view([("", rows.dtype)] * n).ravel(), return_index=True, return_inverse=True)
            pairs = np.unique(np.column_stack([kind, owners]), axis=0)
            self.groups.append((n, places[first].astype(np.int32), np.searchsorted(pairs[:, 0], np.arange(len(first) + 1)), pairs[:, 1].astype(np.int32)))
        self.shortest = self.groups[0][0] if self.groups else 0

    def possible(self, symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(length, which windows) whose words are all among these symbols."""
        there = np.zeros(len(self.vocabulary) + 1, bool)
        there[symbols] = True
        missing = np.concatenate([[0], np.cumsum(~there[self.text])])
        for n, places, _, _ in self.groups:
            yield n, np.flatnonzero(missing[places + n] == missing[places])


class FMIndex:
    """Over a sequence of symbols 1..sigma with separators 0; the first symbol is a separator."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = SAMPLE):
        n = len(text)
        separators = np.flatnonzero(text == 0)
        order = text + len(separators)
        order[separators] = np.arange(len(separators))  # each separator its own symbol, so no comparison passes one
        suffixes = _suffix_array(order)
        last = text[suffixes - 1]  # the transform; the suffix at 0 is preceded by the last symbol
        self.levels = max(1, int(sigma).bit_length())
        self.starts = np.zeros(sigma + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=sigma + 1), out=self.starts[1:])
        self.ones, self.zeros = [], []
        rest = last
        for level in range(self.levels - 1, -1, -1):
            bit = (rest >> level) & 1
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(n - int(ones[-1]))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])
        self.begin = self._mapped(np.arange(sigma + 1), np.zeros(sigma + 1, np.int64))
        sampled = (suffixes % sample == 0) | (text[suffixes - 1] == 0)  # and the first word of each run, so no walk leaves its run
        self.marked = sampled
        self.marks = np.cumsum(sampled) - 1
        self.positions = suffixes[sampled]

    def _mapped(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        for depth, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            r = ones[at]
            at = np.where((c >> (self.levels - 1 - depth)) & 1, zeros + r, at - r)
        return at

    def rank(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of c in the transform before a row."""
        return self._mapped(c, at) - self.begin[c]

    def symbol(self, at: np.ndarray) -> np.ndarray:
        c = np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            r = ones[at]
            bit = ones[at + 1] - r
            c = 2 * c + bit
            at = np.where(bit, zeros + r, at - r)
        return c

    def search(self, text: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, first row, row after the last) of each pattern that occurs; a pattern is n symbols of `text` from its place on."""
        which = np.arange(len(places))
        lo, hi = np.zeros(len(places), np.int64), np.full(len(places), len(self.marked), np.int64)
        for j in range(n - 1, -1, -1):
            c = text[places[which] + j].astype(np.int64)
            lo, hi = self.starts[c] + self.rank(c, lo), self.starts[c] + self.rank(c, hi)
            alive = lo < hi
            which, lo, hi = which[alive], lo[alive], hi[alive]
        return which, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, steps = np.empty(len(rows), np.int64), 0
        open_, at = np.arange(len(rows)), rows
        while len(open_):
            found = self.marked[at]
            out[open_[found]] = self.positions[self.marks[at[found]]] + steps
            open_, at = open_[~found], at[~found]
            c = self.symbol(at)
            at = self.starts[c] + self.rank(c, at)
            steps += 1
        return out


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; only ranks that are still shared are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    sorted_ = text[order]
    first = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(first)[np.cumsum(first) - 1]  # rank: the first row of its group
    step = 1
    while True:
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, n))
        shared = np.repeat(sizes > 1, sizes)
        rows = np.flatnonzero(shared)
        if not len(rows):
            return order
        suffix = order[rows]
        follow = suffix + step
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)], -1)
        group = rank[suffix]
        inner = np.lexsort((second, group))
        order[rows] = suffix[inner]
        g, s = group[inner], second[inner]
        first[rows] = np.concatenate([[True], (g[1:] != g[:-1]) | (s[1:] != s[:-1])])
        at = np.flatnonzero(first)
        rank[order] = at[np.cumsum(first) - 1]
        step *= 2


def hits(texts: list[bytes | None], patterns: Patterns) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
    """For each text: its words, the merged spans of words inside occurrences, and the items that occur."""
    get, counts, parts = patterns.vocabulary.get, [], []
    for text in texts:
        w = words(text)
        counts.append(len(w))
        parts.append(np.fromiter(map(get, w, repeat(0)), np.int64, len(w)))
        parts.append(np.zeros(1, np.int64))
    found: list[tuple[int, list, set]] = [(n, [], set()) for n in counts]
    if not patterns.groups or not texts:
        return found
    ids = np.concatenate([np.zeros(1, np.int64), *parts])
    edges = np.diff((ids > 0).astype(np.int8))
    begin, end = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
    long_ = end - begin >= patterns.shortest
    begin, end = begin[long_], end[long_]
    if not len(begin):
        return found
    doc_starts = 1 + np.concatenate([[0], np.cumsum(np.array(counts) + 1)])
    for first, after in _filled(*(runs := _split(begin, end, patterns.groups[-1][0]))):
        _search(ids, runs[0][first:after], runs[1][first:after], doc_starts, patterns, found)
    return [(n, merged(spans), items) for n, spans, items in found]


def _split(begin: np.ndarray, end: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs, those that do not fit an index in pieces; each window up to the longest lies whole in one of them."""
    held = max(SHARD, longest + 1) - 1  # a separator goes before each run
    step = held - longest + 1
    n = np.maximum(1, -(-(end - begin - longest + 1) // step))
    begin = np.repeat(begin, n) + step * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    return begin, np.minimum(np.repeat(end, n), begin + held)


def _filled(begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of runs that an index each holds, of SHARD symbols at most."""
    offsets = np.concatenate([[0], np.cumsum(end - begin + 1)])
    first = 0
    while first < len(begin):
        after = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SHARD, "right")) - 1)
        yield first, after
        first = after


def _search(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, doc_starts: np.ndarray, patterns: Patterns, found: list[tuple[int, list, set]]) -> None:
    """Adds to `found` what occurs in these runs."""
    # The index holds a separator and the run, run after run; `at` says where each symbol stood.
    sizes = end - begin + 1
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - (begin - 1), sizes)
    text = ids[at].copy()
    text[offsets[:-1]] = 0
    index = FMIndex(text, len(patterns.vocabulary))
    for (n, could), (_, places, begins, owners) in zip(patterns.possible(text), patterns.groups):
        which, lo, hi = index.search(patterns.text, places[could], n)
        if not len(which):
            continue
        which = could[which]
        times = hi - lo
        rows = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - lo, times)
        where = at[index.locate(rows)]
        doc = np.searchsorted(doc_starts, where, "right") - 1
        pattern = np.repeat(which, times)
        for k in np.lexsort((where, doc)):
            d, p = int(doc[k]), int(pattern[k])
            start = int(where[k] - doc_starts[d])
            found[d][1].append((start, start + n))
            found[d][2].update(name for i in owners[begins[p] : begins[p + 1]] if (name := patterns.names[i]) is not None)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text less the spans of words; what stood between a removed span's words goes too."""
    where = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : where[a][0]])
        at = where[b - 1][1]
    out.append(text[at:])
    return b"".join(out)


_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Patterns]:
    """Items are read in blocks of a bounded size, one at a time."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = _block_count(benchmark, block_bytes)
    for i in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) if n > 1 else rows
        yield Patterns([(r["item"], r["text"].encode()) for r in part.collect()], window)


def _block_count(benchmark: DataFrame, block_bytes: int) -> int:
    return max(1, -(-(benchmark.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0) // block_bytes))


def _shards(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], list[bytes | None]]]:
    """Rows in turn, across batches, and their texts, until HELD_BYTES are reached; one row at least."""
    held: list[pa.RecordBatch] = []
    texts: list[bytes | None] = []
    size = 0
    for batch in it:
        first = 0
        for i, text in enumerate(binary_list(batch.column("text"))):
            if texts and size + len(text or b"") > HELD_BYTES:
                yield [*held, batch.slice(first, i - first)], texts
                held, texts, first, size = [], [], i, 0
            texts.append(text)
            size += len(text or b"")
        held.append(batch.slice(first))
    if texts:
        yield held, texts


def _by_batch(held: list[pa.RecordBatch], values: list) -> Iterator[tuple[pa.RecordBatch, list]]:
    at = 0
    for batch in held:
        if batch.num_rows:
            yield batch, values[at : at + batch.num_rows]
        at += batch.num_rows


_FOUND = ("n_words", "n_hit", "items", "spans")


def _with_found(batch: pa.RecordBatch, found: list[tuple[int, list, set]]) -> pa.RecordBatch:
    """The columns of a batch that are no results, and the results."""
    keep = [i for i, name in enumerate(batch.schema.names) if name not in _FOUND]
    cols = [pa.array([n for n, _, _ in found], pa.int64()), pa.array([sum(b - a for a, b in s) for _, s, _ in found], pa.int64()), pa.array([sorted(i) for _, _, i in found], pa.list_(pa.string())), pa.array([[{"first": a, "after": b} for a, b in s] for _, s, _ in found], _SPANS)]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *cols], names=[*(batch.schema.names[i] for i in keep), *_FOUND])


def _searched(df: DataFrame, held, only_hits: bool = False) -> DataFrame:
    """The columns of `df`, one of which is text, and what a block of patterns finds."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batches, texts in _shards(it):
            for batch, found in _by_batch(batches, hits(texts, held.value)):
                out = _with_found(batch, found)
                yield out.filter(pa.array([bool(s) for _, s, _ in found], pa.bool_())) if only_hits else out

    return df.mapInArrow(run, T.StructType([*(f for f in df.schema.fields if f.name not in _FOUND), *_found_type().fields]))


def _hits_by_row(rows: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> Saved:
    """(__of, many_spans, many_items) of the rows (__row, text) in which some block finds something. Blocks are broadcast one after another."""
    out: DataFrame | None = None
    sc = rows.sparkSession.sparkContext
    for patterns in _blocks(benchmark, window, block_bytes):
        held = sc.broadcast(patterns)
        part = Saved(_searched(rows.select("__row", "text"), held, only_hits=True).select("__row", "spans", "items"), "hits").df
        held.destroy()
        out = part if out is None else out.unionByName(part)
    return Saved(out.groupBy(F.col("__row").alias("__of")).agg(F.flatten(F.collect_list("spans")).alias("many_spans"), F.flatten(F.collect_list("items")).alias("many_items")), "hits")


def _joined(rows: DataFrame, found: Saved, how: str) -> DataFrame:
    few = found.df.count() <= BROADCAST_HITS
    return rows.join(F.broadcast(found.df) if few else found.df, F.col("__row") == F.col("__of"), how)


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The columns of `docs` with, in their place if such columns exist, n_words, spans, items, n_hit.

    `spans` are the merged ranges of words (first, after) inside occurrences of windows of `benchmark` (item_id, text), `items` the
    sorted ids of items with an occurring window, `n_hit` the words in spans. A window is `window` consecutive words of an item, or
    all words of a shorter one. Words are runs of 0-9, a-z and non-ASCII characters, A-Z lower-cased. Null and empty texts have no
    words; null or empty items have no window; items with a null id mark words but are not listed. Repeated rows stay. An empty table
    gives no rows, and an empty benchmark finds nothing.
    """
    spark = docs.sparkSession
    ship(spark)
    base = docs.drop(*_FOUND).withColumn("text", F.col("text").cast("string"))
    if _block_count(benchmark, block_bytes) == 1:
        return _searched(base, spark.sparkContext.broadcast(next(_blocks(benchmark, window, block_bytes))))
    rows = Saved(base.withColumn("__row", F.monotonically_increasing_id()), "rows").df
    found = _hits_by_row(rows, benchmark, window, block_bytes)
    joined = _joined(rows, found, "left").drop("__of", "__row")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            n = [len(words(t)) for t in binary_list(batch.column("text"))]
            spans = [merged([(x["first"], x["after"]) for x in s or []]) for s in batch.column("many_spans").to_pylist()]
            yield _with_found(batch.drop_columns(["many_spans", "many_items"]), list(zip(n, spans, [set(i or []) for i in batch.column("many_items").to_pylist()])))

    return joined.mapInArrow(run, T.StructType([*base.schema.fields, *_found_type().fields]))


def _found_type() -> T.StructType:
    span = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("after", T.IntegerType())])
    return T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(span))])


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, items and spans of every row of `docs`; see `find`."""
    return find(docs.select("doc_id", "text"), benchmark, window)


def _cut(texts: list[bytes | None], patterns: Patterns) -> tuple[list[bytes | None], list[bool]]:
    """The texts without any occurrence, and which of them changed. Cutting may bring words together: cut texts are searched again."""
    out, changed = list(texts), [False] * len(texts)
    todo = list(range(len(out)))
    while todo:
        found = hits([out[i] for i in todo], patterns)
        todo = [i for i, (_, spans, _) in zip(todo, found) if spans]
        for i, spans in zip(todo, [spans for _, spans, _ in found if spans]):
            out[i], changed[i] = without(out[i], spans), True
    return out, changed


def _with_texts(batch: pa.RecordBatch, new: list[bytes | None], changed: list[bool]) -> pa.RecordBatch:
    """A batch with other texts and its __cut raised where they changed, without the rows of which no word is left."""
    flags = pa.array([a or b for a, b in zip(batch.column("__cut").to_pylist(), changed)], pa.bool_())
    keep = [not c or bool(_WORD.search(t)) for t, c in zip(new, changed)]
    batch = batch.set_column(batch.schema.names.index("text"), "text", pa.array(new, pa.binary()).cast(pa.string()))
    return batch.set_column(batch.schema.names.index("__cut"), "__cut", flags).filter(pa.array(keep, pa.bool_()))


def _cut_by_blocks(rows: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """Rows (__row, text, __cut, ...) less what any block finds. A cut may complete a window of another block, so rows that were cut are searched
    again, and only these, until nothing is found."""

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            spans = [merged([(x["first"], x["after"]) for x in s]) for s in batch.column("many_spans").to_pylist()]
            new = [without(t, s) for t, s in zip(binary_list(batch.column("text")), spans)]
            yield _with_texts(batch.drop_columns(["many_spans"]), new, [True] * len(new))

    done: list[DataFrame] = []
    left = Saved(rows, "rows")
    while True:
        found = _hits_by_row(left.df, benchmark, window, block_bytes)
        if not found.df.limit(1).count():
            break
        done.append(Saved(_joined(left.df, found, "left_anti"), "clean").df)
        changed = _joined(left.df, found, "inner").drop("__of", "many_items")
        again = Saved(changed.mapInArrow(cut, rows.schema), "cut")
        left.drop()
        found.drop()
        left = again
    out = left.df
    for df in done:
        out = out.unionByName(df)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` with all occurrences of windows cut from the texts; see `find` for what a window is.

    Texts without an occurrence, null and empty ones among them, keep every byte, and their rows every value. Of a text that was cut,
    n_chars, if there is such a column, becomes the new length, and the row goes if no word is left. All columns of `docs` are returned.
    Repeated rows, and rows without doc_id, are each cut for themselves. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    flagged = docs.withColumn("text", F.col("text").cast("string")).withColumn("__cut", F.lit(False))
    if _block_count(benchmark, block_bytes) == 1:
        held = spark.sparkContext.broadcast(next(_blocks(benchmark, window, block_bytes)))

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batches, texts in _shards(it):
                new, changed = _cut(texts, held.value)
                for batch, part in _by_batch(batches, list(zip(new, changed))):
                    yield _with_texts(batch, [t for t, _ in part], [c for _, c in part])

        out = flagged.mapInArrow(run, flagged.schema)
    else:
        out = _cut_by_blocks(flagged.withColumn("__row", F.monotonically_increasing_id()), benchmark, window, block_bytes)
    if kind is not None:
        out = out.withColumn("n_chars", F.when(F.col("__cut"), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
