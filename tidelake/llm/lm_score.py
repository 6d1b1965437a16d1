"""Language-model scores from a log-frequency Bloom filter.

Counting: each task merges the hashes of its tokens and of its pairs of neighbouring tokens and sends them, packed by hash range, to
the slice of that range, so a frequent n-gram arrives once a task. A slice adds up the counts, keeps those of single tokens exactly, and
puts the pairs' quantised counts into its part of the filter: one entry for each step up to the count, of one up to EXACT and of doublings
beyond, and MANTISSA bits within the last doubling, so that a count is read back exactly or to 1/128. The slices follow the text, so each
holds a bounded number of n-grams however many there are.

The model is a pair model under a Dirichlet prior of MASS draws from the token model p1:

    p(w | v) = (count(v, w) + MASS * p1(w)) / (count(v) + false + MASS),    p1(w) = (count(w) + 1) / (N + V + 1)

count(v) is exact and is what the counts of its pairs sum to. `false` is what the filter's false positives are expected to add over the
vocabulary, V times their rate; the rate falls as V grows (a first entry has log2(V / FALSE) probes), so `false` stays within some FALSE.
Over the vocabulary and one unknown word p sums to 1, give or take under a hundredth: the spread of the false positives beside MASS, and the 1/128.

Scoring: the filter of up to BROADCAST_TEXT bytes of text is broadcast and probed where the texts are. A larger one stays where it is
built: blocks of texts send the distinct n-grams they need to the slices that own them, and the answers meet the block's texts, which are
read once more. That is one pass for counting and two for scoring, however large the model. Both ways give the same scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..deploy import ship
from .common import Saved, binary_list, mix, small_batches, word_hashes

#: Bytes of text a slice stands for, and tokens a task holds before it merges them.
SLICE_BYTES, FLUSH_TOKENS = 16 << 20, 2_000_000
#: Bytes of training text up to which the filter is broadcast: a token has two bytes at least and takes the model some 20 at most, so ten
#: times as much; prose takes about as much as its text. And bytes of text in a block that asks the slices of a larger model.
BROADCAST_TEXT, BLOCK_BYTES = 32 << 20, 4 << 20
#: Draws of the token model that stand beside a context's own pairs, and false pairs of a context that the filter may show.
MASS, FALSE = 1000.0, 64
#: Counts that have an entry for each step, bits within a doubling beyond, and probes of entries other than a pair's first.
EXACT, MANTISSA, PROBES = 8, 6, 10
#: Bits of a pair's hash that tell it from others of its slice, and most bits that name the slice.
KEY_BITS, MOST_SLICE_BITS = 40, 24

END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))  # no word holds a line break
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_KEY = np.uint64((1 << KEY_BITS) - 1)


def tokens(text: bytes | None) -> np.ndarray:
    """Hashes of the words and of the end."""
    words = text.lower().split() if text else []
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = word_hashes(words)
    out[-1] = END
    return out


def pairs(t: np.ndarray, bits: int) -> np.ndarray:
    """The slice and key, in one number, of each token with the one before it; before the first there is an end."""
    return mix(np.concatenate([[END], t[:-1]]) * _PAIR + t) >> np.uint64(MOST_SLICE_BITS - bits)


def _token_slice(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def _pair_slice(p: np.ndarray) -> np.ndarray:
    return (p >> np.uint64(KEY_BITS)).astype(np.int64)


def _merged(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def pack_keys(keys: np.ndarray) -> bytes:
    """Keys in order, byte plane by byte plane, of which the upper ones hardly change and compress."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].T).tobytes()


def unpack_keys(data) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(KEY_BITS // 8, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : KEY_BITS // 8] = planes.T
    return out.view("<u8").ravel().astype(np.uint64)


def _batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, schema)], names=[n for n, _ in schema])


_COUNTED = [("slice", pa.int32()), ("tokens", pa.binary()), ("token_counts", pa.binary()), ("pairs", pa.binary()), ("pair_counts", pa.binary())]


def _counted(docs: DataFrame, bits: int) -> DataFrame:
    """What each task has merged, a row for each slice."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            p, d = np.unique(np.concatenate([pairs(t, bits) for t in held]), return_counts=True)
            times = -(-d // 255)  # a count goes in a byte; a larger one is sent in pieces
            d = np.where(np.arange(times.sum()) == np.repeat(np.cumsum(times) - 1, times), np.repeat(d - 255 * (times - 1), times), 255)
            p = np.repeat(p, times)
            ranges = np.arange((1 << bits) + 1)
            at, of = np.searchsorted(_token_slice(h, bits), ranges), np.searchsorted(_pair_slice(p), ranges)
            for s in np.flatnonzero((at[1:] > at[:-1]) | (of[1:] > of[:-1])):
                t, q = slice(at[s], at[s + 1]), slice(of[s], of[s + 1])
                yield _batch(_COUNTED, [(int(s), h[t].tobytes(), c[t].astype(np.uint32).tobytes(), pack_keys(p[q] & _KEY), d[q].astype(np.uint8).tobytes())])

        size = 0
        for batch in it:
            for text in binary_list(batch.column(0)):
                t = tokens(text)
                held.append(t)
                size += len(t)
                if size >= FLUSH_TOKENS:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "slice int, tokens binary, token_counts binary, pairs binary, pair_counts binary")


class Slice:
    """The n-grams of a hash range: exact counts of tokens, and a Bloom filter of the pairs' quantised counts."""

    def __init__(self, uni: np.ndarray, counts: np.ndarray, bits: np.ndarray, size: int, probes: int):
        self.uni, self.counts, self.bits, self.size, self.probes = uni, counts, bits, size, probes

    @classmethod
    def build(cls, uni: np.ndarray, counts: np.ndarray, keys: np.ndarray, pair_counts: np.ndarray, vocabulary: float) -> Slice:
        """`vocabulary` is V, or what this slice lets expect of it."""
        probes = max(PROBES, ceil(log2(max(2.0, vocabulary / FALSE))))
        entries = list(_entries(pair_counts))
        size = max(64, ceil(sum((probes if entry == 1 else PROBES) * n for entry, n in ((e, len(at)) for e, at in entries)) / log(2)))
        out = cls(uni, counts, np.zeros(0, np.uint8), size, probes)
        flags = np.zeros(size, bool)
        for entry, at in entries:
            for place in out._places(keys[at], entry):
                flags[place] = True
        out.bits = np.packbits(flags)
        return out

    @staticmethod
    def _start(keys: np.ndarray, entry: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the probes of (pair, entry) begin, and by how much each goes on."""
        at = mix(keys + np.asarray(entry, np.uint64) * np.uint64(0xD1342543DE82EF95))
        return at, mix(at) | np.uint64(1)

    def _place(self, at: np.ndarray) -> np.ndarray:
        return (((at >> np.uint64(32)) * np.uint64(self.size)) >> np.uint64(32)).astype(np.int64)

    def _places(self, keys: np.ndarray, entry: int) -> Iterator[np.ndarray]:
        at, step = self._start(keys, entry)
        for _ in range(self.probes if entry == 1 else PROBES):
            yield self._place(at)
            at = at + step

    def holds(self, keys: np.ndarray, entry: int | np.ndarray, probes: int = PROBES) -> np.ndarray:
        """Which of the pairs have this entry, or each its own, by probing until a bit is missing."""
        out = np.arange(len(keys))
        at, step = self._start(keys, entry)
        for _ in range(probes):
            place = self._place(at)
            hit = (self.bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
            if not hit.all():
                out, at, step = out[hit], at[hit], step[hit]
                if not len(out):
                    break
            at = at + step
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts as the filter tells them; zero for pairs it has not."""
        out = np.zeros(len(keys), np.float32)
        which, step = np.arange(len(keys)), 1
        while len(which) and step < 64:
            which = which[self.holds(keys[which], step, self.probes if step == 1 else PROBES)]
            out[which] = float(step) if step <= EXACT else float(EXACT << (step - EXACT))
            step += 1
        large = np.flatnonzero(out >= EXACT)
        base = out[large].astype(np.float64)
        part = np.zeros(len(large))
        for j in range(MANTISSA):
            part[self.holds(keys[large], _mantissa_entry(base.astype(np.int64), j))] += 1 << j
        value = base + part * base / (1 << MANTISSA)
        out[large] = np.where(base > 1 << MANTISSA, value + base / (2 << MANTISSA), np.round(value))
        return out

    def token_counts(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.uni):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.uni, hashes), len(self.uni) - 1)
        return np.where(self.uni[at] == hashes, self.counts[at], 0)

    def false_rate(self) -> float:
        """The chance that the filter shows a pair it has not."""
        full = int(np.bitwise_count(self.bits).sum()) / self.size
        return full**self.probes


def _mantissa_entry(octave: int | np.ndarray, j: int) -> int | np.ndarray:
    """Octaves are powers of two."""
    return 64 + np.bitwise_count(np.asarray(octave, np.int64) - 1).astype(np.int64) * MANTISSA + j


def _entries(counts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(entry, places of the pairs that have it) for the steps up to each count and the bits within its last doubling."""
    step = 1
    while True:
        least = step if step <= EXACT else EXACT << (step - EXACT)
        at = np.flatnonzero(counts >= least)
        if not len(at):
            break
        yield step, at
        step += 1
    large = np.flatnonzero(counts >= EXACT)
    octave = EXACT << np.floor(np.log2(counts[large] / EXACT)).astype(np.int64)
    part = ((counts[large] - octave) << MANTISSA) // octave
    for o in np.unique(octave):
        for j in range(MANTISSA):
            at = large[(octave == o) & ((part >> j) & 1 == 1)]
            if len(at):
                yield int(_mantissa_entry(int(o), j)), at


def _built(table: pa.Table, bits: int) -> Slice:
    """A slice from all that was counted of it."""
    whole = lambda name, read: np.concatenate([np.zeros(0, read(b"").dtype), *(read(x.as_buffer()) for x in table[name])])
    uni, counts = _merged(whole("tokens", lambda x: np.frombuffer(x, np.uint64)), whole("token_counts", lambda x: np.frombuffer(x, np.uint32)).astype(np.int64))
    keys, pair_counts = _merged(whole("pairs", unpack_keys), whole("pair_counts", lambda x: np.frombuffer(x, np.uint8)).astype(np.int64))
    return Slice.build(uni, counts, keys, pair_counts, len(uni) * 2.0**bits)


_SLICE = "slice int, uni binary, counts binary, bits binary, size long, probes int, kinds long, total long, false double"


def _reduced(counted: DataFrame, bits: int) -> DataFrame:
    """A row for each slice that has n-grams."""

    def run(table: pa.Table) -> pa.Table:
        s = _built(table, bits)
        row = (table["slice"][0].as_py(), s.uni.tobytes(), s.counts.tobytes(), s.bits.tobytes(), s.size, s.probes, len(s.uni), int(s.counts.sum()), s.false_rate())
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array([v], t) for v, t in zip(row, kinds)], names=["slice", "uni", "counts", "bits", "size", "probes", "kinds", "total", "false"])

    return counted.groupBy("slice").applyInArrow(run, _SLICE)


def _slice_of(row) -> Slice:
    """A slice from a row's values by name."""
    return Slice(np.frombuffer(row["uni"], np.uint64), np.frombuffer(row["counts"], np.int64), np.frombuffer(row["bits"], np.uint8), row["size"], row["probes"])


class Block:
    """Some texts as the distinct tokens and pairs they ask for, both in the order of their slices."""

    def __init__(self, texts: list[bytes | None], bits: int):
        each = [tokens(t) for t in texts]
        self.lengths = np.array([len(t) for t in each])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.kinds, self.kind = np.unique(np.concatenate(each), return_inverse=True)
        self.pairs, self.pair = np.unique(np.concatenate([pairs(t, bits) for t in each]), return_inverse=True)
        ranges = np.arange((1 << bits) + 1)
        self.kind_at, self.pair_at = np.searchsorted(_token_slice(self.kinds, bits), ranges), np.searchsorted(_pair_slice(self.pairs), ranges)

    def asked(self) -> Iterator[tuple[int, slice, slice]]:
        """(slice, its tokens, its pairs) for each slice that is asked."""
        for s in np.flatnonzero((self.kind_at[1:] > self.kind_at[:-1]) | (self.pair_at[1:] > self.pair_at[:-1])):
            yield int(s), slice(self.kind_at[s], self.kind_at[s + 1]), slice(self.pair_at[s], self.pair_at[s + 1])

    def scored(self, ids: list, counts: np.ndarray, pair_counts: np.ndarray, about: About) -> pa.RecordBatch:
        """Scores, from the counts of `kinds` and of `pairs`."""
        log_p1 = np.log10(counts + 1.0) - np.log10(about.total + about.kinds + 1.0)
        known = np.add.reduceat((counts > 0).astype(np.int64)[self.kind], self.starts)
        base = np.add.reduceat(np.log10(counts + 1.0)[self.kind], self.starts) - self.lengths * np.log10(about.total + 1.0 * (about.kinds + 1))
        count = counts[self.kind].astype(np.float64)
        before = np.concatenate([[0.0], count[:-1]])
        before[self.starts] = count[self.starts + self.lengths - 1]  # a text begins after an end, and ends with one
        p = about.probability(pair_counts[self.pair].astype(np.float64), before, 10.0 ** log_p1[self.kind])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(self.lengths, pa.int64()), pa.array(known), pa.array(base), pa.array(np.add.reduceat(np.log10(p), self.starts))], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])


class About:
    """What all slices add up to."""

    def __init__(self, slices: DataFrame, bits: int, mass: float):
        r = slices.agg(F.sum("total").alias("total"), F.sum("kinds").alias("kinds"), F.sum("false").alias("false")).first()
        self.total, self.kinds, self.mass = int(r["total"] or 0), int(r["kinds"] or 0), mass
        self.false = (r["false"] or 0.0) / (1 << bits) * (self.kinds + 1)

    def probability(self, pair: np.ndarray, before: np.ndarray, alone: np.ndarray) -> np.ndarray:
        return (pair + self.mass * alone) / (before + self.false + self.mass)


_SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _blocks(it: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[bytes | None]]]:
    """(ids, texts) of rows in turn, cut where `most` bytes of text are reached."""
    ids, texts, size = [], [], 0
    for batch in it:
        for i, text in zip(batch.column(0).to_pylist(), binary_list(batch.column(1))):
            ids.append(i)
            texts.append(text)
            size += len(text or b"") + 1
            if size >= most:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _by_broadcast(docs: DataFrame, training: DataFrame, bits: int, mass: float) -> tuple[DataFrame, About]:
    """Every worker probes the whole filter."""
    slices = Saved(_reduced(_counted(training, bits), bits), "filter")
    about = About(slices.df, bits, mass)
    held = docs.sparkSession.sparkContext.broadcast({r["slice"]: _slice_of(r) for r in slices.df.collect()})  # bounded by BROADCAST_TEXT

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for ids, texts in _blocks(it, 1 << 20):
            block = Block(texts, bits)
            counts, pair_counts = np.zeros(len(block.kinds), np.int64), np.zeros(len(block.pairs), np.float32)
            for s, t, p in block.asked():
                if s in model:
                    counts[t], pair_counts[p] = model[s].token_counts(block.kinds[t]), model[s].pair_counts(block.pairs[p] & _KEY)
            yield block.scored(ids, counts, pair_counts, about)

    scored = Saved(docs.mapInArrow(run, _SCORED), "scored")
    held.destroy()
    slices.drop()
    return scored.df, about


_ASKED = [("block", pa.string()), ("slice", pa.int32()), ("tokens", pa.binary()), ("pairs", pa.binary())]
_ANSWER = [("block", pa.string()), ("slice", pa.int32()), ("counts", pa.binary()), ("pair_counts", pa.binary()), ("kinds", pa.int64()), ("total", pa.int64()), ("false", pa.float64())]
_TEXTS = [("block", pa.string()), ("ids", pa.list_(pa.int64())), ("texts", pa.binary())]


def _rereadable(df: DataFrame) -> bool:
    """Whether the rows are a file scan's, which gives a task the same rows in the same order again."""
    plan = df._jdf.queryExecution().optimizedPlan()
    nodes = {line.lstrip(" +-:").split(" ")[0].split("[")[0] for line in plan.toString().splitlines() if line.strip()}
    return bool(plan.deterministic()) and nodes <= {"Project", "Filter", "Relation", "LocalRelation"}


def _name(at: int, ids: list, texts: list[bytes | None]) -> str:
    """A block's name: its task, its place there, and what it holds, so that blocks that were not read alike do not meet."""
    digest = xxhash.xxh3_128()
    for i, t in zip(ids, texts):
        digest.update(f"{i} {-1 if t is None else len(t)} ".encode())
        digest.update(t or b"")
    return f"{TaskContext.get().partitionId()}-{at}-{digest.hexdigest()}"


@contextmanager
def _same_splits(spark: SparkSession) -> Iterator[None]:
    """While it holds, a scan cuts files alike however many executors there are: Spark derives splits from their number otherwise, and one
    may be lost between two scans."""
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, before or spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


MISREAD = "a block of texts was read otherwise the second time"


def _by_routing(docs: DataFrame, training: DataFrame, bits: int, mass: float) -> tuple[DataFrame, About]:
    """Blocks of texts ask the slices, and the answers come back to them.

    The texts are read twice, which has to give the same blocks. Those of a file scan are not written for that; should its files be read
    otherwise after all, which the blocks' names show, or should they come from elsewhere, they are written first.
    """
    with _same_splits(docs.sparkSession):
        if _rereadable(docs):
            try:
                return _routed(docs, training, bits, mass)
            except Exception as e:
                if MISREAD not in str(e):
                    raise
        texts = Saved(docs, "texts")
        out = _routed(texts.df, training, bits, mass)
        texts.drop()
        return out


def _routed(docs: DataFrame, training: DataFrame, bits: int, mass: float) -> tuple[DataFrame, About]:
    """A slice is built where it is asked, and kept nowhere."""
    spark = docs.sparkSession

    def ask(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, (ids, texts) in enumerate(_blocks(it, BLOCK_BYTES)):
            block, name = Block(texts, bits), _name(at, ids, texts)
            rows = [(name, s, block.kinds[t].tobytes(), pack_keys(block.pairs[p] & _KEY)) for s, t, p in block.asked()]
            for first in range(0, len(rows), 64):
                yield _batch(_ASKED, rows[first : first + 64])

    def answer(counted: pa.Table, asked: pa.Table) -> pa.Table:
        own = _built(counted, bits)
        # All blocks' n-grams at once: each is looked up once, and no time goes into small arrays.
        each = [(np.frombuffer(t.as_buffer(), np.uint64), unpack_keys(p.as_buffer())) for t, p in zip(asked["tokens"], asked["pairs"])]
        none = np.zeros(0, np.uint64)
        kinds, kind = np.unique(np.concatenate([none, *(t for t, _ in each)]), return_inverse=True)
        keys, key = np.unique(np.concatenate([none, *(p for _, p in each)]), return_inverse=True)
        counts, pair_counts = own.token_counts(kinds)[kind], own.pair_counts(keys)[key]
        rows, at, of = [], 0, 0
        for block, s, (t, p) in zip(asked["block"], asked["slice"], each):
            rows.append((block.as_py(), s.as_py(), counts[at : at + len(t)].tobytes(), pair_counts[of : of + len(p)].tobytes(), None, None, None))
            at, of = at + len(t), of + len(p)
        rows.append((None, None, None, None, len(own.uni), int(own.counts.sum()), own.false_rate()))
        return pa.Table.from_batches([_batch(_ANSWER, rows)])

    def keep(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for at, (ids, texts) in enumerate(_blocks(it, BLOCK_BYTES)):
            whole = pa.BufferOutputStream()
            batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_binary())], names=["text"])
            with pa.ipc.new_stream(whole, batch.schema) as out:
                out.write_batch(batch)
            yield _batch(_TEXTS, [(_name(at, ids, texts), ids, pack.compress(whole.getvalue()))])

    def score_block(kept: pa.Table, answers: pa.Table) -> pa.Table:
        if kept.num_rows != 1 or not answers.num_rows:
            raise RuntimeError(MISREAD)
        texts = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(kept["texts"][0].as_py())).read_all()["text"].to_pylist()
        block = Block(texts, bits)
        answers = answers.sort_by("slice")
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in answers["counts"]])
        pair_counts = np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in answers["pair_counts"]])
        return pa.Table.from_batches([block.scored(kept["ids"][0].as_py(), counts, pair_counts, about)])

    asked = docs.mapInArrow(ask, "block string, slice int, tokens binary, pairs binary")
    with small_batches(spark, 64):
        both = _counted(training, bits).groupBy("slice").cogroup(asked.groupBy("slice"))
        answers = Saved(both.applyInArrow(answer, "block string, slice int, counts binary, pair_counts binary, kinds long, total long, false double"), "answers")
        about = About(answers.df, bits, mass)
        texts = docs.mapInArrow(keep, "block string, ids array<long>, texts binary")
        found = answers.df.where("block is not null").select("block", "slice", "counts", "pair_counts")
        scored = Saved(texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score_block, _SCORED), "scored")
    answers.drop()
    return scored.df, about


def score(docs: DataFrame, training: DataFrame, mass: float = MASS, slice_bytes: int = SLICE_BYTES, broadcast_text: int = BROADCAST_TEXT) -> DataFrame:
    """Score every row of `docs` (doc_id, text) by a model of `training` (text).

    Tokens are runs of bytes other than space and \\x09-\\x0D, A-Z lower-cased, and one end per text. Returns doc_id, n_tokens, n_known
    (tokens that occur in training), train_tokens, base_score (log10 of add-one probabilities of tokens, from exact counts), score (log10 of
    the model's probability of the text). Null and empty texts are one end. Repeated rows count and are scored each; null doc_ids stay
    null. With nothing to learn from, all counts are zero; an empty table gives no rows. Other columns are ignored; whole texts are read.
    """
    spark = docs.sparkSession
    ship(spark)
    size = training.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    bits = min(MOST_SLICE_BITS, max(0, (-(-size // slice_bytes) - 1).bit_length()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored, about = (_by_broadcast if size <= broadcast_text else _by_routing)(rows, training, bits, mass)
    return scored.withColumn("train_tokens", F.lit(about.total).cast("long"))
