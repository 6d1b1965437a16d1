"""Sharding by a k-d tree over document metadata, cut at distributed weighted medians.

Every node of the tree is cut along its widest dimension at the median of its bytes, until as many leaves stand as shards are
wanted. A dimension's values are scaled to its range over all documents: numbers as they are, sizes by their logarithm, texts by where
the bytes after what all begin with stand among the distinct ones, so that they keep their order and lie apart. The widest dimension of a node is that of the greatest standard deviation,
weighted by bytes.

The tree is a table with a row for each node of a level, and so is everything about it: spreads, bins and cuts never pass through the
driver. A median is found by refining a histogram: each pass sums the bytes of a node by the next 12 bits of its sort key and goes on
within the bin that holds the median. The key holds the dimension's value first, then a hash of the text, then one of the row, so ties,
copies and repeated rows are cut exactly too; a bin of few rows is resolved at once. Copies take the least metadata of their group, which puts equal texts beside each other in
every order, and a cut goes round a group unless that costs more than `group_slack` of a shard; `group_cut` tells the rows of texts that lie
in several shards. The metadata is written once for each level of the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Saved, numbered

VALUE_BITS, TEXT_BITS, ID_BITS, STEP = 20, 28, 15, 12
KEY_BITS = VALUE_BITS + TEXT_BITS + ID_BITS
#: Bytes of a text after the beginning that all share which tell its place, and quantiles of the distinct ones that scale it.
PREFIX, MARKS = 6, 256
#: Rows of a bin that are told apart at once.
FEW_ROWS = 20_000
#: A cut is done when its bin holds under this share of its node's bytes.
CLOSE = 1e-6
#: A cut spares a group of equal texts of under this share of a shard's bytes.
GROUP_SLACK = 0.005
#: Rows of a small table that are broadcast: nodes of a level, groups of copies with differing metadata, groups that were cut; 32 MB or so.
BROADCAST_ROWS = 500_000


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _metadata(docs: DataFrame, dims: list[str]) -> DataFrame:
    """doc_id, size, text_crc32, `same` (a hash of the text), `row` (a hash of the row's place), and the dimensions v0, v1, ..."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    kinds = dict(docs.dtypes)
    cols = []
    for i, d in enumerate(dims):
        if d == "size":
            v = F.log2(F.octet_length(text) + F.lit(1.0))
        elif d not in kinds:
            v = F.lit(0.0)
        elif kinds[d] in ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean") or kinds[d].startswith("decimal"):
            x = F.col(d).cast("double")
            v = F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)
        else:
            v = F.col(d).cast("string")
        cols.append(v.alias(f"v{i}"))
    return docs.select(F.col("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("same"), F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("row"), *cols)


def _grouped(meta: DataFrame, dims: int) -> DataFrame:
    """Rows of equal texts get the least value of their group in each dimension. Only groups that differ are joined."""
    names = [f"v{i}" for i in range(dims)]
    differ = F.lit(False)
    for d in names:
        differ = differ | (F.col(f"least_{d}") < F.col(f"most_{d}")) | ((F.col(f"known_{d}") > 0) & (F.col(f"known_{d}") < F.col("n")))
    found = [f(d).alias(f"{n}_{d}") for d in names for n, f in (("least", F.min), ("most", F.max), ("known", F.count))]
    groups = meta.groupBy("same").agg(F.count(F.lit(1)).alias("n"), *found).where(differ)
    groups = Saved(groups.select(F.col("same").alias("other"), *[f"least_{d}" for d in names]), "groups").df
    joined = meta.join(_small(groups, groups.count()), F.col("same") == F.col("other"), "left")
    return joined.select("doc_id", "size", "text_crc32", "same", "row", *[F.coalesce(f"least_{d}", d).alias(d) for d in names])


def _shared(a: str, b: str) -> int:
    """Bytes that two texts begin with alike."""
    x, y = a.encode(), b.encode()
    return next((i for i in range(min(len(x), len(y))) if x[i] != y[i]), min(len(x), len(y)))


def _text_place(meta: DataFrame, column: str, lo: str, hi: str) -> Column:
    """Where a text stands among the distinct texts of the column, from 0 to 1: between MARKS of their quantiles, in their order."""
    at = _shared(lo, hi)
    number = F.conv(F.rpad(F.hex(F.substring(F.col(column).cast("binary"), at + 1, PREFIX)), 2 * PREFIX, "0"), 16, 10).cast("double")
    distinct = meta.select(number.alias("n")).where("n is not null").distinct()
    marks = sorted(set(distinct.agg(F.percentile_approx("n", [i / MARKS for i in range(MARKS + 1)], 100 * MARKS).alias("q")).first()["q"]))
    if len(marks) < 2:
        return F.lit(0.0)
    held = F.array(*[F.lit(float(m)) for m in marks])
    i = F.greatest(F.size(F.filter(held, lambda m: m <= number)), F.lit(1))
    low, high = F.element_at(held, i), F.element_at(held, F.least(i + 1, F.lit(len(marks))))
    between = F.when(high > low, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (number - low) / (high - low)))).otherwise(0.0)
    return F.when(number.isNotNull(), (i - 1 + between) / float(len(marks) - 1))


def _scaled(meta: DataFrame, dims: int) -> DataFrame:
    """The dimensions as d0, d1, ...: whole numbers of VALUE_BITS bits over each one's range; null is the least."""
    kinds = dict(meta.dtypes)
    ends = meta.agg(*[f(f"v{i}").alias(f"{n}{i}") for i in range(dims) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    cols = []
    for i in range(dims):
        lo, hi, v = ends[f"lo{i}"], ends[f"hi{i}"], F.col(f"v{i}")
        if lo is None or lo == hi:
            share = F.lit(0.0)
        elif kinds[f"v{i}"] == "string":
            share = _text_place(meta, f"v{i}", lo, hi)
        else:
            share = (v - float(lo)) / (float(hi) - float(lo))
        cols.append(F.coalesce((share * ((1 << VALUE_BITS) - 1)).cast("long"), F.lit(0)).alias(f"d{i}"))
    tail = F.shiftleft(F.shiftrightunsigned("same", 64 - TEXT_BITS), ID_BITS).bitwiseOR(F.shiftrightunsigned("row", 64 - ID_BITS))
    return meta.select("doc_id", "size", "text_crc32", "same", "row", tail.alias("tail"), *cols)


def _key(dims: int) -> Column:
    """The sort key along the node's dimension `dim`."""
    value = F.lit(0).cast("long")
    for i in range(dims):
        value = F.when(F.col("dim") == i, F.col(f"d{i}")).otherwise(value)
    return F.shiftleft(value, TEXT_BITS + ID_BITS).bitwiseOR(F.col("tail"))


def _opened(rows: DataFrame, dims: int) -> DataFrame:
    """A row for each node (at, shards) of two shards or more: its widest dimension, its bytes, and those wanted below its cut."""
    open_ = rows.where("shards > 1")
    weighted = [F.sum(F.col("size") * F.pow(F.col(f"d{i}").cast("double") / (1 << VALUE_BITS), F.lit(float(p)))).alias(f"s{i}_{p}") for i in range(dims) for p in (1, 2)]
    nodes = open_.groupBy("at", "shards").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), *weighted)
    spread = [F.col(f"s{i}_2") / F.col("bytes") - F.pow(F.col(f"s{i}_1") / F.col("bytes"), F.lit(2.0)) for i in range(dims)]
    widest = F.array_max(F.array(*[F.struct(s.alias("spread"), F.lit(-i).alias("dim")) for i, s in enumerate(spread)]))
    want = F.col("bytes") * F.floor(F.col("shards") / 2) / F.col("shards")
    zero = F.lit(0).cast("long")
    return nodes.select("at", "shards", "bytes", "rows", (-widest["dim"]).alias("dim"), want.alias("want"), zero.alias("below"), zero.alias("prefix"), F.lit(0).alias("bits"), F.lit(False).alias("done"), zero.alias("cut"))


def _refined(rows: DataFrame, nodes: DataFrame, dims: int, small: bool, group_slack: float) -> DataFrame:
    """The nodes with the bin that holds the median narrowed by `_step` bits; those whose bin is fine enough get their cut and are done."""
    kept = ["at", "shards", "bytes", "rows", "dim", "want", "below", "prefix", "bits", "done", "cut"]
    open_ = nodes.where("not done").drop("done", "cut").withColumn("step", _step().cast("int")).withColumnRenamed("rows", "before")
    joined = rows.select("at", "size", "tail", *[f"d{i}" for i in range(dims)]).join(F.broadcast(open_) if small else open_, "at")
    # Spark's shifts take a column as their width only in SQL.
    joined = joined.withColumn("key", _key(dims)).withColumn("bin", F.expr(f"shiftrightunsigned(key, {KEY_BITS} - bits - step)")).where(F.expr("shiftright(bin, step) = prefix"))
    bins = joined.groupBy("at", "bin").agg(F.sum("size").alias("held"), F.count(F.lit(1)).alias("rows"))
    placed = bins.join(F.broadcast(open_) if small else open_, "at")
    order = Window.partitionBy("at").orderBy("bin")
    upto = F.col("below") + F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = F.row_number().over(Window.partitionBy("at").orderBy(F.col("bin").desc())) == 1
    found = placed.withColumn("upto", upto).withColumn("last", last).where((F.col("upto") >= F.col("want")) | F.col("last"))
    found = found.withColumn("nth", F.row_number().over(order)).where("nth = 1").withColumn("bits", (F.col("bits") + F.col("step")).cast("int"))
    bits, before = F.col("bits"), F.col("upto") - F.col("held")
    spared = (bits == VALUE_BITS + TEXT_BITS) & (F.col("held") <= F.lit(group_slack) * F.col("bytes") / F.col("shards"))
    done = spared | (F.col("rows") == 1) | (F.col("held") <= F.lit(CLOSE) * F.col("bytes")) | (bits == KEY_BITS)
    over = (F.col("upto") - F.col("want") < F.col("want") - before).cast("long")  # the nearer side of the bin
    found = found.select("at", "shards", "bytes", "rows", "dim", "want", before.alias("below"), F.col("bin").alias("prefix"), "bits", done.alias("done"), over.alias("over"))
    found = found.withColumn("cut", F.expr(f"shiftleft(prefix + over, {KEY_BITS} - bits)")).select(*kept)
    return nodes.where("done").select(*kept).unionByName(found)


def _step() -> Column:
    """STEP bits, so that a node has 4,096 bins; of so few rows that they are not more bins than that by much, all bits up to the end of the text's,
    or of the key."""
    rest = F.when(F.col("bits") < VALUE_BITS + TEXT_BITS, F.lit(VALUE_BITS + TEXT_BITS)).otherwise(F.lit(KEY_BITS)) - F.col("bits")
    return F.when(F.col("rows") <= FEW_ROWS, rest).otherwise(F.least(F.lit(STEP), rest))


def _level(rows: DataFrame, dims: int, nodes_at_most: int, group_slack: float) -> DataFrame:
    """Every row in the half of its node that it falls into; a node of one shard stays."""
    small = nodes_at_most <= BROADCAST_ROWS
    nodes = Saved(_opened(rows, dims), "nodes")
    while nodes.df.where("not done").limit(1).count():
        finer = Saved(_refined(rows, nodes.df, dims, small, group_slack), "nodes")
        nodes.drop()
        nodes = finer
    cuts = nodes.df.select("at", "dim", "cut")
    joined = rows.join(F.broadcast(cuts) if small else cuts, "at", "left")
    left = F.floor(F.col("shards") / 2).cast("int")
    # A cut past the last key would not fit a long: the key is below 2^63 in any case.
    low = (_key(dims) < F.col("cut")) | (F.col("cut") < 0)
    at = F.when(F.col("cut").isNull(), F.col("at")).when(low, F.col("at")).otherwise(F.col("at") + left)
    shards = F.when(F.col("cut").isNull(), F.col("shards")).when(low, left).otherwise(F.col("shards") - left)
    out = Saved(joined.select(*[c for c in rows.columns if c not in ("at", "shards")], at.cast("int").alias("at"), shards.cast("int").alias("shards")), "level")
    nodes.drop()
    return out


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, dims: tuple[str, ...] = ("source", "lang", "size"), group_slack: float = GROUP_SLACK) -> DataFrame:
    """Every row of `docs` in one of the shards 0 to n - 1 of near equal bytes; n is `shards`, or follows from `target_bytes`.

    Returns doc_id, size (UTF-8 bytes of the text and 1), text_crc32, shard, slot (from 0 in each shard, without gaps), group_cut (whether
    rows of the same text lie in other shards). Null text: size 1, checksum 0. Null ids and null or absent dimensions count as one value,
    the least. Repeated rows are dealt each. With fewer rows than shards some shards stay empty; an empty table gives no rows. Columns
    other than doc_id, text and the dimensions are ignored. Equal texts share a shard unless their group has more than `group_slack` of
    a shard's bytes: then sizes stay near equal, and the group is cut.
    """
    scanned = Saved(_metadata(docs, list(dims)), "meta")
    grouped = Saved(_grouped(scanned.df, len(dims)), "grouped")
    scanned.drop()
    if shards is None:
        total = grouped.df.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // (target_bytes or 1 << 30)))
    rows = Saved(_scaled(grouped.df, len(dims)).withColumn("at", F.lit(0)).withColumn("shards", F.lit(int(shards))), "level")
    grouped.drop()
    deepest, nodes = (int(shards) - 1).bit_length(), 1
    for _ in range(deepest):
        halves = _level(rows.df, len(dims), nodes, group_slack)
        rows.drop()
        rows, nodes = halves, 2 * nodes
    placed = rows.df.select("doc_id", "size", "text_crc32", "same", "row", F.col("at").alias("shard"))
    cut = placed.groupBy(F.col("same").alias("other")).agg(F.min("shard").alias("lo"), F.max("shard").alias("hi")).where("lo < hi").select("other")
    cut = Saved(cut, "cut").df
    placed = placed.join(_small(cut, cut.count()), F.col("same") == F.col("other"), "left").withColumn("group_cut", F.col("other").isNotNull())
    out = numbered(placed.drop("other"), ["shard"], ["row"], "slot", key_bound=shards)
    return out.select("doc_id", "size", "text_crc32", "shard", "slot", "group_cut")


def write_shards(docs: DataFrame, path: str, **how) -> None:
    """Write whole documents under shard=<n>/ folders of a Parquet table at `path`; a column named shard is left out for them.

    Every row is dealt for itself, rows without doc_id and repeated ones too; see `kd_shards` for what `how` may say.
    """
    rows = Saved(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    placed = kd_shards(rows.df.withColumn("doc_id", F.col("__row")), **how).select(F.col("doc_id").alias("__of"), "shard")
    joined = rows.df.drop("shard").join(placed, F.col("__row") == F.col("__of")).drop("__row", "__of")
    joined.hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path)
    rows.drop()
