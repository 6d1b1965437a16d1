"""MinHash near-duplicates by a multi-index Hamming join, confirmed on full shingle sets.

A signature has MINHASHES MinHashes of a document's word shingles. The index takes the first of them, chunks * CHUNK symbols of BITS
bits each, and splits them into chunks: by the pigeonhole principle, two signatures that differ in fewer than chunks * 2 of these
symbols share a chunk with at most one differing symbol. That error is enumerated as a blank: each chunk is looked up under
CHUNK keys, each leaving one of its symbols out, so all pairs under that distance meet in a bucket, and most beyond it too. A
pair at the similarity threshold meets in no bucket with a chance of about 1e-5 (`plan` picks the number of chunks for that). Pairs that
meet are held to a second distance: one bit of each MinHash, for which a pair at the threshold stays within `far` but for a
chance of 1e-6. What passes is confirmed on the full sets.

No bucket emits all its pairs. First, documents with equal shingle sets become one class. Then each bucket ties its members to its
least one and the ties are confirmed; after that, members of one component need no further comparison. Pairs of one bucket that lie in
different components are left. Buckets with up to SMALL members compare them inside a join, under the conditions on sizes and
bits, and each pair is emitted by one of the buckets it shares. The members of larger buckets, joined up where buckets
overlap, are cut into tiles of at most TILE documents of similar size; tiles are compared two at a time, where their sizes allow, and
return only links that keep a component together, so a crowd of similar texts that are not linked gives no rows. Components are found once
more over all confirmed links.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..deploy import ship
from .common import Saved, binary_list, mix, numbered, small_batches, word_hashes
from .components import components

CHUNK, MISS, BITS, MINHASHES = 5, 2e-5, 16, 256
WORDS = MINHASHES // 64
SMALL, TILE, SIZE_STEP = 64, 256, 1.08
#: Ids of candidate documents are broadcast up to so many, 32 MB; beyond, they are shuffled.
BROADCAST_IDS = 4_000_000
#: Keys of buckets with two classes or more, each with a document, are broadcast up to so many, 16 MB; beyond, they are shuffled.
BROADCAST_KEYS = 1_000_000


def plan(threshold: float) -> int:
    """Chunks of CHUNK symbols for which a pair at the threshold shares none, one error allowed, with a chance under MISS."""
    found = threshold**CHUNK + CHUNK * threshold ** (CHUNK - 1) * (1 - threshold)
    n = 1
    while found < 1 and (1 - found) ** n > MISS:
        n += 1
    return n


def far(threshold: float) -> int:
    """Differing bits of MINHASHES that a pair at the threshold stays within but for a chance of 1e-6."""
    p, tail = (1 - threshold) / 2, 0.0
    for k in range(MINHASHES, -1, -1):
        tail += comb(MINHASHES, k) * p**k * (1 - p) ** (MINHASHES - k)
        if tail > 1e-6:
            return k
    return 0


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text; fewer words than the width count as one shingle."""
    w = word_hashes(text.lower().split()) if text else np.zeros(0, np.uint64)
    if not len(w):
        return w
    n = min(width, len(w))
    out = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + w[i : len(w) - n + 1 + i])
    return np.unique(out)


def _factors() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240117)
    return r.integers(1, 2**32, MINHASHES, dtype=np.uint32) | np.uint32(1), r.integers(0, 2**32, MINHASHES, dtype=np.uint32)


def signature(s: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The MinHashes of a set of mixed hashes."""
    out, high = np.full(MINHASHES, np.iinfo(np.uint32).max, np.uint32), (s >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(s), 2048):  # a long text's table of hashes stays small
        block = np.multiply.outer(mult, high[at : at + 2048])
        block += add[:, None]
        np.minimum(out, block.min(axis=1), out=out)
    return out


def bucket_keys(symbols: np.ndarray, chunks: int) -> np.ndarray:
    """For each row of symbols, a key for each chunk and each symbol left out of it."""
    parts = symbols.reshape(len(symbols), chunks, CHUNK)
    out = np.empty((len(symbols), chunks, CHUNK), np.uint64)
    for gap in range(CHUNK):
        key = np.broadcast_to((np.arange(chunks, dtype=np.uint64) * np.uint64(CHUNK) + np.uint64(gap + 1)) * np.uint64(0x9E3779B97F4A7C15), parts.shape[:2])
        for j in range(CHUNK):
            if j != gap:
                key = mix(key ^ parts[:, :, j] * np.uint64(0xFF51AFD7ED558CCD))
        out[:, :, gap] = key
    return out.reshape(len(symbols), -1)


def sketches(docs: DataFrame, width: int, chunks: int) -> DataFrame:
    """(doc_id, n, digest, keys, bits) of every row; digest, keys and bits are null for a text without words."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult, add = _factors()
        for whole in it:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                n, digest, sigs = [], [], []
                for text in binary_list(batch.column(1)):
                    s = shingles(text, width)
                    n.append(len(s))
                    digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    sigs.append(signature(s, mult, add))
                mixed = mix(np.stack(sigs).astype(np.uint64))
                empty = np.array(n) == 0
                keys = bucket_keys(mixed[:, : chunks * CHUNK] & np.uint64((1 << BITS) - 1), chunks).view(np.int64)
                bits = np.packbits((mixed >> np.uint64(63)).astype(np.uint8), axis=1).view(np.int64)
                lists = [pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * t.shape[1], pa.array(t.ravel()), mask=pa.array(empty)) for t in (keys, bits)]
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), *lists], names=["doc_id", "n", "digest", "keys", "bits"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n long, digest binary, keys array<long>, bits array<long>")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            sets = [shingles(t, width).tobytes() for t in binary_list(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "items"])

    return docs.mapInArrow(run, "id long, items binary")


def _sets_of(ids: DataFrame, docs: DataFrame, width: int) -> Saved:
    """(id, items) of the documents with these ids: their whole sets."""
    ids = Saved(ids.distinct(), "ids")
    small = ids.df.count() <= BROADCAST_IDS
    wanted = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids.df) if small else ids.df, "id", "left_semi")
    with small_batches(docs.sparkSession):
        sets = Saved(_sets(wanted, width), "sets")
    ids.drop()
    return sets


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets meet the threshold.

    Each pair brings both sets to one row. Their sizes are near each other, as `_near` has seen to, so a document that is in very many
    pairs costs no more than its partners' own sets do. Spark bounds the batches that reach Python by bytes.
    """
    if not pairs.limit(1).count():
        return pairs.select(F.col("a").cast("long"), F.col("b").cast("long"))
    sets = _sets_of(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))), docs, width)
    left, right = sets.df.withColumnRenamed("id", "a").withColumnRenamed("items", "x"), sets.df.withColumnRenamed("id", "b").withColumnRenamed("items", "y")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    with small_batches(docs.sparkSession):
        found = Saved(joined.mapInArrow(run, "a long, b long").distinct(), "links")
    sets.drop()
    return found.df


_TILE = "g long, kind int, tile long, lo long, hi long, c0 long, c1 long, ids binary, n binary, c binary, bits binary, ends binary, items binary"


def _tiles(members: DataFrame) -> DataFrame:
    """Packs members (g, kind, part, n, id, c, bits, items) of the same g, kind and part, at most TILE, into one row."""

    def pack(table: pa.Table) -> pa.Table:
        n, ids, c = (table[k].to_numpy() for k in ("n", "id", "c"))
        items = table["items"].to_pylist()
        bits = np.array(table["bits"].to_pylist(), np.int64)
        cols = [table["g"][0].as_py(), table["kind"][0].as_py(), int(ids.min()), int(n.min()), int(n.max()), int(c.min()), int(c.max()), ids.tobytes(), n.tobytes(), c.tobytes(), bits.tobytes(), np.cumsum([len(x) // 8 for x in items]).tobytes(), b"".join(items)]
        kinds = [pa.int64(), pa.int32(), *[pa.binary() if isinstance(v, bytes) else pa.int64() for v in cols[2:]]]
        return pa.table([pa.array([v], k) for v, k in zip(cols, kinds)], names=["g", "kind", "tile", "lo", "hi", "c0", "c1", "ids", "n", "c", "bits", "ends", "items"])

    return members.groupBy("g", "kind", "part").applyInArrow(pack, _TILE)


def overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of x with all of y."""
    out = np.zeros((len(x), len(y)), np.float32)
    shared = np.intersect1d(np.concatenate(x), np.concatenate(y))
    at = lambda sets: [p[shared[np.minimum(p, len(shared) - 1)] == s] for s in sets for p in [np.searchsorted(shared, s)]] if len(shared) else [[] for _ in sets]
    px, py = at(x), at(y)
    for first in range(0, len(shared), 8192):
        width = min(8192, len(shared) - first)
        sides = []
        for places in (px, py):
            m = np.zeros((len(places), width), np.float32)
            for i, p in enumerate(places):
                q = p[(p >= first) & (p < first + width)] - first
                m[i, q] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def _compared(pairs: DataFrame, percent: int, most: int) -> DataFrame:
    """Links (a, b) that keep the components of each pair of tiles together."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for r in range(batch.num_rows):
                get = lambda name, kind=np.int64: np.frombuffer(batch.column(name)[r].as_buffer(), kind)  # noqa: E731, B023
                ids, n, c, bits = ([get(f"{k}_{s}") for s in "ab"] for k in ("ids", "n", "c", "bits"))
                words = [b.reshape(-1, WORDS).view(np.uint64) for b in bits]
                differ = sum(np.bitwise_count(words[0][:, None, w] ^ words[1][None, :, w]).astype(np.int16) for w in range(WORDS))
                sizes = n[0][:, None], n[1][None, :]
                maybe = (differ <= most) & (c[0][:, None] != c[1][None, :]) & (100 * np.minimum(*sizes) >= percent * np.maximum(*sizes))
                if batch.column("a")[r] == batch.column("b")[r]:
                    maybe = np.triu(maybe, 1)
                i, j = np.nonzero(maybe)
                if not len(i):
                    continue
                sets = [np.split(get(f"items_{s}", np.uint64), get(f"ends_{s}")[:-1]) for s in "ab"]
                if len(i) > 1000:
                    both = overlaps(*sets)[i, j].astype(np.int64)
                else:
                    both = np.array([len(np.intersect1d(sets[0][p], sets[1][q], assume_unique=True)) for p, q in zip(i, j)])
                sure = 100 * both >= percent * (n[0][i] + n[1][j] - both)
                parent: dict[int, int] = {}

                def root(v: int) -> int:
                    while parent.setdefault(v, v) != v:  # noqa: B023
                        parent[v] = v = parent[parent[v]]  # noqa: B023
                    return v

                links = []
                for p, q in zip(i[sure], j[sure]):  # links within a component of this pair of tiles add nothing
                    u, v = root(int(c[0][p])), root(int(c[1][q]))
                    if u != v:
                        parent[u] = v
                        links.append((int(ids[0][p]), int(ids[1][q])))
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _tiled(crowd: DataFrame, docs: DataFrame, width: int, percent: int, most: int) -> DataFrame:
    """Links between members (g, id, n, c, bits) of the same g in different components."""
    spark = docs.sparkSession
    if not crowd.limit(1).count():
        return crowd.select(F.col("g").alias("a"), F.col("id").alias("b"))
    sets = _sets_of(crowd.select("id"), docs, width)
    kind = F.floor(F.log(F.col("n").cast("double")) / log(SIZE_STEP)).cast("int")
    placed = numbered(crowd.withColumn("kind", kind), ["g", "kind"], ["id"], "at", rows_per_bucket=4 * TILE).withColumn("part", F.floor(F.col("at") / TILE)).drop("at")
    tiles = Saved(_tiles(placed.join(sets.df, "id")), "tiles")
    sets.drop()
    # Tiles meet those of their own kind of size and of the few kinds above it that a link can span.
    about = tiles.df.select("g", "kind", "tile", "lo", "hi", "c0", "c1")
    span = int(log(100 / percent) / log(SIZE_STEP)) + 1
    a, b = about.withColumn("k", F.explode(F.sequence(F.col("kind"), F.col("kind") + span))).alias("a"), about.alias("b")
    fit = (F.least("a.hi", "b.hi") * 100 >= F.greatest("a.lo", "b.lo") * percent) & ~((F.col("a.c0") == F.col("a.c1")) & (F.col("b.c0") == F.col("b.c1")) & (F.col("a.c0") == F.col("b.c0")))
    wanted = Saved(a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.k") == F.col("b.kind")) & ((F.col("a.kind") < F.col("b.kind")) | (F.col("a.tile") <= F.col("b.tile"))) & fit).select(F.col("a.g").alias("g"), F.col("a.tile").alias("a"), F.col("b.tile").alias("b")), "wanted")
    side = lambda s: tiles.df.select("g", F.col("tile").alias(s), *[F.col(k).alias(f"{k}_{s}") for k in ("ids", "n", "c", "bits", "ends", "items")])
    joined = wanted.df.join(side("a"), ["g", "a"]).join(side("b"), ["g", "b"])
    with small_batches(spark, 2):
        out = Saved(_compared(joined, percent, most), "tilelinks")
    tiles.drop()
    wanted.drop()
    return out.df


def _near(x: str, y: str, percent: int, most: int) -> Column:
    """What the sizes and bits of two documents at the threshold meet."""
    differ = sum((F.bit_count(F.col(f"{x}.b{i}").bitwiseXOR(F.col(f"{y}.b{i}"))) for i in range(1, WORDS)), F.bit_count(F.col(f"{x}.b0").bitwiseXOR(F.col(f"{y}.b0"))))
    return (F.least(f"{x}.n", f"{y}.n") * 100 >= F.greatest(f"{x}.n", f"{y}.n") * percent) & (differ <= most)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Every row of `docs` (doc_id, text; other columns are ignored) with its group of near-duplicates.

    Words are runs of bytes other than space and \\x09-\\x0D, A-Z lower-cased; a document's set holds its distinct shingles of
    `width` words, or all its words as one shingle if there are fewer. Documents whose sets have a Jaccard similarity of
    `percent` / 100 or more are linked. Returns doc_id, n_shingles (size of the set), component_id (smallest doc_id reachable by
    links, itself included) and kept (doc_id = component_id).

    Null, empty or blank text: n_shingles 0, linked with nothing. Null doc_id: component_id null, kept false, linked with
    nothing. Repeated rows stay, each with the same result. A doc_id with several texts: each row stands for its own text.
    Empty tables give an empty result. Texts are used whole.
    """
    if _several_texts(docs):
        return _by_text(docs, width, percent).drop("row")
    return _linked(docs, width, percent)


def _several_texts(docs: DataFrame) -> bool:
    """Whether rows of one doc_id differ in their texts."""
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("h"))
    return texts.groupBy("doc_id").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo < hi").limit(1).count() > 0


def _row() -> Column:
    """A number for each doc_id and text; null where the doc_id is."""
    return F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))


def _by_text(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """What near_duplicates returns, and `row`: the groups are found under a number for each doc_id and text, then named by doc_id."""
    numbered_ = docs.select(_row().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = _linked(numbered_.select(F.col("row").alias("doc_id"), "text"), width, percent).select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("c"))
    named = Saved(found.join(numbered_.where("row is not null").select("row", "doc_id").distinct(), "row", "left"), "named").df
    least = named.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, "c", "left").select("doc_id", "n_shingles", "component_id", "row")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def _linked(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """near_duplicates where a doc_id has one text."""
    spark = docs.sparkSession
    ship(spark)
    threshold = percent / 100
    chunks = plan(threshold)
    made = Saved(sketches(docs, width, chunks), "sketch")
    worded = made.df.where("digest is not null and doc_id is not null")
    one = worded.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first(F.struct("n", "keys", "bits")).alias("s"))
    bits = [f"b{i}" for i in range(WORDS)]
    classes = Saved(one.select("digest", "rep", "s.n", "s.keys", *[F.col("s.bits")[i].alias(b) for i, b in enumerate(bits)]), "classes").df
    rows = Saved(made.df.select("doc_id", "n", "digest"), "rows")
    made.drop()
    about = lambda side: classes.select(F.col("rep").alias(side), F.struct("n", *bits).alias(f"{side}_is"))

    posted = classes.select(F.explode("keys").alias("key"), "rep")
    shared = posted.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    shared = Saved(shared.select("key", "least"), "buckets")
    # Only members of buckets with two classes or more go on; these are few where copies are few.
    few_keys = shared.df.count() <= BROADCAST_KEYS
    members = Saved(posted.join(F.broadcast(shared.df) if few_keys else shared.df, "key"), "members")
    ties = members.df.where("rep != least").select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct()
    star = Saved(ties.join(about("a"), "a").join(about("b"), "b").where(_near("a_is", "b_is", percent, far(threshold))).select("a", "b"), "star")
    links = _confirmed(star.df, docs, width, percent)
    first = Saved(components(links), "first")

    # What is left of a bucket: members in different components. A pair is emitted by the bucket of its least common key.
    placed = members.df.select("key", "rep").join(first.df, F.col("rep") == F.col("node"), "left").select("key", "rep", F.coalesce("component", "rep").alias("c"))
    placed = Saved(placed, "placed")
    split = placed.df.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count(F.lit(1)).alias("size"), F.min("rep").alias("first")).where("c0 < c1").select("key", "size", "first")
    split = Saved(split, "split")  # a table of its own, so that Spark splits a key of very many members in the join
    rest = Saved(placed.df.join(split.df, "key").select("key", "rep", "c", "size", "first"), "rest")
    large = rest.df.where(F.col("size") > SMALL)
    groups = Saved(components(large.select(F.col("rep").alias("a"), F.col("first").alias("b"))), "groups")
    most = far(threshold)
    crowd = large.select("rep", "c").distinct().join(groups.df.select(F.col("node").alias("rep"), F.col("component").alias("g")), "rep").join(classes.select("rep", "n", F.array(*bits).alias("bits")), "rep")
    crowd = Saved(crowd.select("g", F.col("rep").alias("id"), "n", "c", "bits"), "crowd")
    tiled = _tiled(crowd.df, docs, width, percent, most)

    few = rest.df.where(F.col("size") <= SMALL).select("key", "rep", "c").join(classes.select("rep", "keys", F.struct("n", *bits).alias("is")), "rep")
    few = Saved(few.join(groups.df.select(F.col("node").alias("rep"), F.col("component").alias("g")), "rep", "left"), "few")
    x, y = few.df.alias("x"), few.df.alias("y")
    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.c") != F.col("y.c")) & F.coalesce(F.col("x.g") != F.col("y.g"), F.lit(True))
    on = on & _near("x.is", "y.is", percent, most) & (F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("x.key"))
    cross = x.join(y, on).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    cross = Saved(cross.join(star.df, ["a", "b"], "left_anti"), "cross")
    more = _confirmed(cross.df, docs, width, percent).unionByName(tiled)
    # Components of components: the first round's labels stand for its links.
    ends = more
    for end in ("a", "b"):
        ends = ends.join(first.df.select(F.col("node").alias(end), F.col("component").alias(f"{end}c")), end, "left").withColumn(f"{end}c", F.coalesce(f"{end}c", end))
    second = Saved(components(ends.select(F.col("ac").alias("a"), F.col("bc").alias("b"))), "second")
    labels = classes.select("digest", "rep").join(first.df, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("component", "rep").alias("c"))
    labels = labels.join(second.df, F.col("c") == F.col("node"), "left").select(F.col("digest").alias("d"), F.coalesce("component", "c").alias("label"))
    labels = Saved(labels, "labels")
    out = Saved(rows.df.join(labels.df, (F.col("digest") == F.col("d")) & F.col("doc_id").isNotNull(), "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "doc_id").alias("component_id")), "near")
    for table in (rows, shared, members, star, first, placed, split, rest, groups, crowd, few, cross, second, labels):
        table.drop()
    return out.df.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that are the first of their group. Rows without words, or without doc_id, stay.

    Of rows that repeat a doc_id and text, each stays if the document does, for all of them are that document. Rows of one doc_id
    with different texts stay or go each for its own text.
    """
    if _several_texts(docs):
        gone = Saved(_by_text(docs, width, percent).where("not kept and row is not null").select(F.col("row").alias("__row")).distinct(), "gone").df
        docs, by = docs.withColumn("__row", _row()), "__row"
    else:
        gone = Saved(_linked(docs, width, percent).where("not kept and doc_id is not null").select("doc_id").distinct(), "gone").df
        by = "doc_id"
    small = gone.count() <= BROADCAST_IDS  # whole texts are shuffled only if not
    return docs.join(F.broadcast(gone) if small else gone, by, "left_anti").drop("__row")
