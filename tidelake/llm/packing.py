"""Packing of tokenised documents into windows by non-negative least squares over the histogram of piece lengths.

1. One pass tokenises each whole text and cuts it into full windows and a rest, each with the checksum of its ids.
2. The histogram of piece lengths, at most one row per length up to the window, reaches the driver.
3. There, lengths are taken together in BINS bins, and the shallow combinations that fill a window, of up to KINDS bins, are
   enumerated; their repeat counts are the non-negative least squares solution against the pieces of each bin, rounded. Each is spent
   on lengths of its bins that fill the window best.
4. The pieces that are left are packed greedily, longest first, again by length: each step repeats its combination until one of
   its lengths runs out, so the steps are bounded by the number of lengths and not by that of documents.
5. The plan, which length goes where and how often, is broadcast, and every piece finds its place by its rank in its length.

Work on the driver depends on the window only. Nothing is cut but documents longer than a window.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..deploy import ship
from .common import Saved, binary_list, numbered

#: Bins that lengths are taken together in, bins that a combination has at most, and repeats of a bin in it at most, but of its last,
#: which fills the window. They bound what is enumerated and bar no piece: each bin can be a combination's last.
BINS, KINDS, MOST_TIMES = 64, 3, 64
#: Rounds of solving, each by the share of a window that its sequences may leave empty; a combination that leaves more waits for a later
#: round, or for the greedy step.
SLACKS = [1 / 1024] * 4 + [1 / 256] * 2


# 1: ASCII small letters and digits, 2: other ASCII characters than white space and the apostrophe. Pre-tokenisation cuts between the
# two in any case, and a space put there changes nothing.
_KIND = np.array([1 if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 2 if 0x21 <= b <= 0x7E and b != 0x27 else 0 for b in range(256)], np.uint8)
_SPECIAL = re.compile(rb"<\|")


def parts(text: bytes) -> list[bytes]:
    """Lower-case pieces of a text, cut at ASCII white space and between ASCII letters or digits and other characters."""
    low = np.frombuffer(text.lower(), np.uint8)
    kind = _KIND[low]
    cut = np.flatnonzero(kind[1:] * kind[:-1] == 2)
    return (np.insert(low, cut + 1, 0x20) if len(cut) else low).tobytes().split()


# Small letters that normalising and lower-casing leave alone; and the byte-level alphabet: printable Latin-1 stands for itself, other
# bytes in turn for the characters from 256 on.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_LEVEL = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - _PRINTABLE))}


# How a tokenizer's file says that it lower-cases, and takes letters, single digits and other characters apart.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _cuts_at_white_space(spec: dict) -> bool:
    """Whether a tokenizer of this file gives a text the ids of its parts, one after another."""
    normalizer, pre = spec.get("normalizer") or {}, (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    split, level = pre[0], pre[-1]
    return (
        normalizer.get("normalizers") == _NORMALIZERS and len(pre) == 2 and split.get("pattern") == {"Regex": _SPLIT} and split.get("behavior") == "Removed" and split.get("invert") is True
        and level.get("type") == "ByteLevel" and not level.get("add_prefix_space") and not level.get("use_regex") and spec.get("post_processor") is None and spec["model"].get("type") == "BPE"
        and not spec.get("truncation") and all(t["content"].startswith("<|") for t in spec.get("added_tokens") or [])
    )


class PartIds(dict):
    """Part of a text -> its ids as little-endian unsigned 32-bit bytes.

    For tokenizers that lower case, drop white space and part letters, digits and other characters, as `word_bpe_49k.json` does; `cuts`
    is false for any other, whose texts are encoded whole. Up to LIMIT parts are remembered: the first ones stay until far more others have come than would fit.
    """

    LIMIT = 200_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        tokenizer = Tokenizer.from_file(path)
        self.encode, self.word = tokenizer.encode, tokenizer.model.tokenize
        with open(path, encoding="utf-8") as f:
            self.cuts = _cuts_at_white_space(json.load(f))
        self.missed = 0

    def plain(self, text: bytes) -> bytes:
        return np.array(self.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, part: bytes) -> bytes:
        if part.isalpha() or _PLAIN.fullmatch(part.decode("utf-8", "replace")):  # one word to the model, whatever comes before it
            value = np.array([t.id for t in self.word(part.decode("latin-1").translate(_LEVEL))], "<u4").tobytes()
        else:
            value = self.plain(part)
        self.missed += 1
        if self.missed > 5 * self.LIMIT:
            self.clear()
            self.missed = 0
        if len(self) < self.LIMIT:
            self[part] = value
        return value


@lru_cache(maxsize=2)
def part_ids(path: str) -> PartIds:
    return PartIds(path)


def encode(text: bytes | None, path: str, end: int) -> bytes:
    """Ids of a whole text and the end id, as little-endian unsigned 32-bit bytes."""
    known = part_ids(path)
    if text and (not known.cuts or _SPECIAL.search(text)):  # may hold a special token's own spelling, which is matched before lower-casing
        ids = known.plain(text)
    else:
        ids = b"".join(map(known.__getitem__, parts(text) if text else []))
    return ids + int(end).to_bytes(4, "little")


def pieces(docs: DataFrame, path: str, end: int, window: int) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, place): each document's full windows and its rest; `place` tells equal rows apart."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "place")])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        for batch in it:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), binary_list(batch.column(1))):
                ids = encode(text, path, end)
                for at in range(0, len(ids), 4 * window):
                    part = ids[at : at + 4 * window]
                    out.append((doc_id, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, place))
                    place += 1
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, place long")


@dataclass(frozen=True)
class Combination:
    """Bins of lengths, longest first, and how many pieces of each fill a window."""

    bins: tuple[int, ...]
    times: tuple[int, ...]


def bin_width(window: int) -> int:
    """Lengths a bin holds: bin k has those from (k - 1) * width + 1 to k * width."""
    return -(-window // BINS)


def combinations(have: np.ndarray, width: int, window: int) -> list[Combination]:
    """Every choice of up to KINDS bins of `have` whose middle lengths, repeated, fill a window to half a bin's width."""
    bins = np.flatnonzero(have)[::-1]
    middle = width * bins - (width - 1) / 2
    # Heads are rows of the places and repeats of the bins chosen so far and of the room left; each gets another bin in turn.
    places, times, room = np.zeros((1, 0), np.int64), np.zeros((1, 0), np.int64), np.array([float(window)])
    out: list[Combination] = []
    for kind in range(KINDS):
        heads, place = np.nonzero((places.max(axis=1, initial=-1)[:, None] < np.arange(len(bins))) & (room[:, None] >= middle - width / 2))
        fill = np.floor(room[heads] / middle[place] + 0.5).astype(np.int64)
        full = (fill > 0) & (np.abs(room[heads] - fill * middle[place]) <= width / 2)
        h, i = heads[full], place[full]
        for k, n in zip(bins[np.column_stack([places[h], i])].tolist(), np.column_stack([times[h], fill[full]]).tolist()):
            out.append(Combination(tuple(k), tuple(n)))
        if kind + 1 < KINDS:
            most = np.minimum((room[heads] / middle[place]).astype(np.int64), MOST_TIMES)
            h, i = np.repeat(heads, most), np.repeat(place, most)
            n = np.arange(most.sum()) - np.repeat(np.cumsum(most) - most, most) + 1
            places, times, room = np.column_stack([places[h], i]), np.column_stack([times[h], n]), room[h] - n * middle[i]
    return out


def nonnegative_least_squares(columns: list[Combination], wanted: np.ndarray) -> np.ndarray:
    """x >= 0 that brings the sum of x times each combination closest to the pieces of each bin.

    By active sets: the column along which the squares fall fastest joins those in use, the squares are solved over these, and columns that
    would go below zero leave. At most as many are in use as there are bins, so repeat counts are large and rounding loses little.
    """
    x = np.zeros(len(columns))
    if not columns:
        return x
    sizes = [len(c.bins) for c in columns]
    column = np.repeat(np.arange(len(columns)), sizes)
    row = np.concatenate([np.array(c.bins) for c in columns])
    times = np.concatenate([np.array(c.times, float) for c in columns])
    norm = np.sqrt(np.bincount(column, times * times))
    used: list[int] = []
    dense = lambda k: np.bincount(np.array(columns[k].bins), np.array(columns[k].times, float), len(wanted))
    a = np.zeros((len(wanted), 0))
    for _ in range(6 * len(wanted)):
        left = wanted - (a @ x[used] if used else 0)
        gain = np.bincount(column, times * left[row]) / norm
        gain[used] = 0
        best = int(gain.argmax())
        if gain[best] <= 1e-7 * max(1.0, wanted.max()):
            break
        used.append(best)
        a = np.column_stack([a, dense(best)])
        while True:
            y = np.linalg.lstsq(a, wanted, rcond=None)[0]
            if (y > 0).all():
                x[used] = y
                break
            old = x[used]
            low = y <= 0
            step = np.min(old[low] / np.maximum(old[low] - y[low], 1e-300))
            new = old + step * (y - old)
            stay = ~(low & (new <= 1e-9 * max(1.0, new.max())))
            if stay.all():
                stay[np.flatnonzero(low)[np.argmin(new[low])]] = False
            x[used] = np.where(stay, np.maximum(new, 0), 0)
            gone = used[-1] == best and not stay[-1]
            used, a = [k for k, s in zip(used, stay) if s], a[:, stay]
            if not used or (gone and best not in used):
                break
        if best not in used:
            break  # rounding keeps it from entering: no better is to be had
    return x


def _pair(have: list[np.ndarray], twice: np.ndarray | None, room: int) -> tuple[int, ...]:
    """The two lengths, one of each side, or the one length, that fill the room best; none if none fit. `twice` marks those of a common side
    of which there are two."""
    if len(have) == 1:
        fit = have[0][have[0] <= room]
        return (int(fit[-1]),) if len(fit) else ()
    both = np.add.outer(have[0], have[1])
    if twice is not None:
        both[np.diag(~twice)] = room + 1
    both[both > room] = 0
    i, j = np.unravel_index(both.argmax(), both.shape)
    return (int(have[0][i]), int(have[1][j])) if both[i, j] else ()


def _realised(c: Combination, left: np.ndarray, width: int, window: int) -> list[int] | None:
    """Lengths that are left, of the bins of a combination, that fill a window best; None if a bin runs out or they are too long.

    All but three are taken near their bins' middles, each making good for those before; of the third last all are tried, nearest
    first, with the best pair for each, until a window is full.
    """
    slots = [k for k, n in zip(c.bins, c.times) for _ in range(n)]
    out: list[int] = []
    taken: dict[int, int] = {}
    drift = 0.0

    def there(k: int) -> np.ndarray:
        lengths = np.arange((k - 1) * width + 1, min(k * width, window) + 1)
        free = left[lengths]
        if taken:
            free = free - np.array([taken.get(int(x), 0) for x in lengths])
        return lengths[free > 0]

    def nearest(k: int) -> np.ndarray:
        have, middle = there(k), width * k - (width - 1) / 2
        return have[np.argsort(np.abs(have - (middle - drift)), kind="stable")]

    for k in slots[:-3]:
        have = nearest(k)
        if not len(have):
            return None
        out.append(int(have[0]))
        drift += out[-1] - (width * k - (width - 1) / 2)
        taken[out[-1]] = taken.get(out[-1], 0) + 1
    best: list[int] | None = None
    for x in nearest(slots[-3]) if len(slots) > 2 else [None]:
        if x is not None:
            taken[int(x)] = taken.get(int(x), 0) + 1
        have = [there(k) for k in slots[-2:]]
        if all(map(len, have)):
            twice = np.array([left[y] - taken.get(int(y), 0) > 1 for y in have[0]]) if len(have) == 2 and slots[-1] == slots[-2] else None
            first = out if x is None else [*out, int(x)]
            pair = _pair(have, twice, window - sum(first))
            if pair and (best is None or sum(first) + sum(pair) > sum(best)):
                best = [*first, *pair]
        if x is not None:
            taken[int(x)] -= 1
        if best and sum(best) == window:
            break
    return best


@dataclass(frozen=True)
class Layout:
    """A sequence's lengths in order, how many such sequences there are, and the step that made them."""

    lengths: tuple[int, ...]
    times: int
    step: str


def _most(lengths: list[int], left: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    used, counts = np.unique(lengths, return_counts=True)
    return used, counts, int((left[used] // counts).min())


def plan(hist: np.ndarray, window: int) -> list[Layout]:
    """Every piece of the histogram is used exactly once.

    Each solved count is rounded to the nearest number, the largest first, and spent on the lengths that are there: one choice of
    lengths is repeated until it or the count runs out, so the steps follow the lengths and not the pieces. What is left is solved for
    again, a round for each of SLACKS, and then packed longest first.
    """
    left, out = hist.astype(np.int64).copy(), []
    if left[window]:
        out.append(Layout((window,), int(left[window]), "full"))
        left[window] = 0
    width = bin_width(window)
    for slack in SLACKS:
        wanted = np.bincount(-(-np.arange(len(left)) // width), left, -(-window // width) + 1).astype(float)
        columns = combinations(wanted > 0, width, window)
        solved = nonnegative_least_squares(columns, wanted)
        for k in np.argsort(-solved, kind="stable"):
            todo = int(solved[k] + 0.5)
            if not todo:
                break
            while todo and (lengths := _realised(columns[k], left, width, window)) and window - sum(lengths) <= slack * window:
                used, counts, n = _most(lengths, left)
                n = min(n, todo)
                left[used] -= n * counts
                todo -= n
                out.append(Layout(tuple(lengths), n, "solved"))
    while left.any():
        lengths: list[int] = []
        used = np.zeros_like(left)
        room = window
        while room and (fit := np.flatnonzero(left[1 : room + 1] > used[1 : room + 1])).size:
            best = int(fit[-1]) + 1
            times = min(room // best, int(left[best] - used[best]))
            lengths += [best] * times
            used[best] += times
            room -= best * times
        at = np.flatnonzero(used)
        n = int((left[at] // used[at]).min())
        left[at] -= n * used[at]
        out.append(Layout(tuple(lengths), n, "greedy"))
    return out


def pack(docs: DataFrame, path: str, end: int = 2, window: int = 4096) -> DataFrame:
    """Every id of every row of `docs` (doc_id, text) placed in a sequence of at most `window` ids.

    Returns a row per piece: doc_id, start (ids of its document before it), length, ids_crc32 (of its ids as little-endian unsigned
    32-bit numbers), doc_tokens (ids of its document, the end id among them), sequence_id (from 0), offset (ids before it in its
    sequence), placed_by (`full`: a window by itself; `solved`: by the least squares; `greedy`: by what followed). Null and empty texts have the end id alone. Null doc_ids stay null. Repeated rows are packed each. An empty
    table gives no rows. Columns other than doc_id and text are ignored. `path` names the tokenizer's file.
    """
    spark = docs.sparkSession
    ship(spark)
    made = Saved(pieces(docs, path, end, window), "pieces")
    counts = made.df.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `window` rows
    hist = np.zeros(window + 1)
    for r in counts:
        hist[r["length"]] = r["n"]
    slots, sequence, rank = [], 0, np.zeros(window + 1, np.int64)
    for layout in plan(hist, window):
        at, offsets = 0, {}
        for x in layout.lengths:
            offsets.setdefault(x, []).append(at)
            at += x
        for x, where in offsets.items():
            slots.append((int(x), int(rank[x]), sequence, [int(w) for w in where], layout.step))
            rank[x] += layout.times * len(where)
        sequence += layout.times
    by_length: dict[int, tuple] = {}
    for x, *values in slots:
        for column, value in zip(by_length.setdefault(x, ([], [], [], [])), values):
            column.append(value)
    table = spark.createDataFrame([(k, *v) for k, v in by_length.items()], "len long, firsts array<long>, sequences array<long>, places array<array<long>>, steps array<string>")
    ranked = numbered(made.df, ["length"], ["place"], "rank", key_bound=window)  # a document repeated very often is dealt like others
    # A length's slots stand in order of their first rank: the last of those not past a piece's rank is its own.
    placed = ranked.join(F.broadcast(table), F.col("length") == F.col("len"))
    placed = placed.withColumn("slot", F.size(F.filter("firsts", lambda f: f <= F.col("rank"))) - 1)
    placed = placed.withColumn("i", F.col("rank") - F.col("firsts")[F.col("slot")]).withColumn("where", F.col("places")[F.col("slot")])
    uses = F.size("where").cast("long")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("sequences")[F.col("slot")] + F.floor(F.col("i") / uses)).cast("long").alias("sequence_id"), F.col("where")[(F.col("i") % uses).cast("int")].alias("offset"), F.col("steps")[F.col("slot")].alias("placed_by"))
