"""One query per capability of the table layer, over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import errors
from .catalog import Lake, LakeTable
from .functions import predicate as language
from .plans.windows import Window
from .sources import connection, delimited, location, log, storage
from .sources.files import HadoopFiles, files_of
from .streaming.watermark import Seen, WatermarkStore
from .workspace import fresh_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _table(spark: SparkSession, name: str) -> LakeTable:
    return Lake(spark, fresh_root(spark, name)).table(name)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").withColumn("dt", F.date_format("o_orderdate", "yyyy-MM"))


_DT = "strftime(o_orderdate, '%Y-%m')"
_ORDERS = f"SELECT *, {_DT} AS dt FROM orders"


@query(f"SELECT {_DT} AS dt, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total, max(o_orderdate) AS last_placed FROM orders GROUP BY 1")
def partitioned_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders merged by key and month into monthly partitions, then reported by Spark SQL over a view of the table."""
    t = _table(spark, "orders")
    t.merge(_orders(spark, sf_dir), ["o_orderkey", "dt"], options={"partition_by": "dt"})
    t.view("tidelake_orders")
    return spark.sql("SELECT dt, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total, max(o_orderdate) AS last_placed FROM tidelake_orders GROUP BY dt ORDER BY dt")


@query("SELECT * FROM orders")
def scan_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _table(spark, "orders")
    t.append(_read(spark, sf_dir, "orders"))
    return t.read()


def _two_versions(spark: SparkSession, sf_dir: str) -> LakeTable:
    t, orders = _table(spark, "orders"), _read(spark, sf_dir, "orders")
    t.append(orders.where("o_orderkey % 2 = 0"))
    t.append(orders.where("o_orderkey % 2 = 1"))
    return t


@query("SELECT * FROM orders WHERE o_orderkey % 2 = 0")
def scan_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time travel: version 0 made the table, 1 and 2 appended to it."""
    return _two_versions(spark, sf_dir).read(version=1)


@query("SELECT * FROM orders WHERE o_orderkey % 2 = 1")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _two_versions(spark, sf_dir)
    return t.read(version=2).join(t.read(version=1).select("o_orderkey"), "o_orderkey", "left_anti")


@query("SELECT * FROM orders")
def scan_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, orders = _table(spark, "orders"), _read(spark, sf_dir, "orders")
    t.append(orders.where("o_orderkey % 2 = 0"))
    t.append(orders.where("o_orderkey % 2 = 1").select(*reversed(orders.columns)))
    return t.read(union_by_name=True)


def _events(spark: SparkSession, sf_dir: str) -> LakeTable:
    t = _table(spark, "events")
    t.append(_read(spark, sf_dir, "events"))
    return t


@query("SELECT * FROM events WHERE event_id > 100")
def window_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).read(window=Window("event_id", "100"))


@query("SELECT * FROM events WHERE event_id >= 100")
def window_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).read(window=Window("event_id", "100", inclusive=True))


@query("SELECT * FROM events WHERE event_id > 100 AND event_id <= 700")
def window_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).read(window=Window("event_id", "100", "700"))


@query("SELECT * FROM events")
def window_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).read(window=Window("event_id"))


@query("SELECT * FROM events")
def watermark_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental runs: the first copies what is there, the second what lies above the stored mark."""
    source, copy, store = _table(spark, "source"), _table(spark, "copy"), WatermarkStore(spark, fresh_root(spark, "marks"))
    events = _read(spark, sf_dir, "events")
    for part in (events.where("event_id <= 400"), events.where("event_id > 400")):
        source.append(part)
        rows = Seen(source.read(window=store.window("events", "event_id")), "event_id")
        copy.merge(rows.df, ["event_id"])
        store.advance("events", rows)
    return copy.read()


@query(f"{_ORDERS} WHERE o_orderstatus = 'F'")
def replace_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replace takes all partitions, those without new rows too."""
    t, orders = _table(spark, "orders"), _orders(spark, sf_dir)
    t.append(orders, options={"partition_by": ["dt"]})
    t.replace(orders.where("o_orderstatus = 'F'"))
    return t.read()


@query("SELECT * FROM orders WHERE false")
def replace_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a frame, a replace leaves an empty table of the same schema."""
    t, orders = _table(spark, "orders"), _read(spark, sf_dir, "orders")
    t.append(orders)
    t.begin(orders.schema, "replace").commit()
    return t.read()


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
          FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0""")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of the keys are stored; the even ones come again with another price, some of them for the first time."""
    t, orders = _table(spark, "orders"), _read(spark, sf_dir, "orders")
    t.append(orders.where("o_orderkey % 3 <> 0"))
    t.merge(orders.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey"])
    return t.read()


@query("""SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 4 = 0 THEN value * 2 ELSE value END AS value, props, strftime(ts, '%Y-%m-%d') AS day
          FROM events WHERE event_id % 3 <> 0 OR event_id % 4 = 0""")
def merge_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _table(spark, "events")
    events = _read(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    t.append(events.where("event_id % 3 <> 0"), options={"partition_by": "day"})
    t.merge(events.where("event_id % 4 = 0").withColumn("value", F.col("value") * 2), ["event_id", "day"])
    return t.read()


@query("SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 UNION SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1")
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns are keys: rows are added if absent, and no file is rewritten."""
    t, orders = _table(spark, "pairs"), _read(spark, sf_dir, "orders")
    pairs = orders.select("o_custkey", "o_orderstatus")
    t.append(orders.where("o_orderkey % 2 = 0").select("o_custkey", "o_orderstatus").distinct())
    t.merge(pairs.where("true"), ["o_custkey", "o_orderstatus"])
    return t.read()


@query("""SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 2 WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS o_totalprice FROM orders""")
def merge_last_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three frames in one session repeat keys: the last frame that has a key wins."""
    t, orders = _table(spark, "orders"), _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    raised = lambda by: F.col("o_totalprice") + by
    t.merge([orders, orders.where("o_orderkey % 2 = 0").withColumn("o_totalprice", raised(1)), orders.where("o_orderkey % 5 = 0").withColumn("o_totalprice", raised(2))], ["o_orderkey"])
    return t.read()


@query("""SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1, 2""")
def merge_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys repeat inside a frame; an explicit order says which row is the last."""
    t = _table(spark, "lines")
    t.merge(_read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), ["l_orderkey", "l_linenumber"], order_by=["l_extendedprice"])
    return t.read()


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders
          UNION ALL SELECT o_orderkey, o_totalprice + 1, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus <> 'O'""")
def merge_predicate_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row that the predicate excludes from matching is inserted beside the one it shares a key with."""
    t, orders = _table(spark, "orders"), _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    t.append(orders)
    t.merge(orders.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey"], options={"merge_predicate": "target.o_orderstatus = 'O' AND NOT (source.\"o_orderkey\" IS NULL)"})
    return t.read()


@query("""WITH twice AS (SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_totalprice FROM orders)
          SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM twice""")
def merge_target_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, orders = _table(spark, "orders"), _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    t.append([orders, orders])
    t.merge(orders.where("o_orderkey % 7 = 0").withColumn("o_totalprice", F.lit(0.0)), ["o_orderkey"])
    return t.read()


@query(f"SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 4 = 0 THEN 'moved' ELSE {_DT} END AS dt FROM orders")
def merge_partition_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, orders = _table(spark, "orders"), _orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "dt")
    t.append(orders, options={"partition_by": "dt"})
    t.merge(orders.where("o_orderkey % 4 = 0").withColumn("dt", F.lit("moved")), ["o_orderkey"])
    return t.read()


@query(f"SELECT o_orderkey, CASE WHEN {_DT} IN ('1995-03', '1996-07') THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, {_DT} AS dt FROM orders")
def merge_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partition column is a key: only files of the two months that come in are read or rewritten."""
    t, orders = _table(spark, "orders"), _orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "dt")
    t.append(orders, options={"partition_by": "dt"})
    t.merge(orders.where("dt IN ('1995-03', '1996-07')").withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey", "dt"], options={"partition_by": "dt"})
    return t.read()


@query("SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 1 THEN 'new' END AS note FROM orders")
def evolve_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, orders = _table(spark, "orders"), _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    t.append(orders.where("o_orderkey % 2 = 0"))
    t.append(orders.where("o_orderkey % 2 = 1").withColumn("note", F.when(F.col("o_orderkey") >= 0, F.lit("new"))), schema_policy="evolve")
    return t.read()


@query("SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN 'new' END AS note FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def evolve_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, orders = _table(spark, "orders"), _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    t.append(orders.where("o_orderkey % 2 = 0"))
    t.merge(orders.where("o_orderkey % 3 = 0").withColumn("note", F.when(F.col("o_orderkey") >= 0, F.lit("new"))), ["o_orderkey"], schema_policy="evolve")
    return t.read()


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus FROM orders")
def evolve_omit(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, orders = _table(spark, "orders"), _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    t.append(orders.where("o_orderkey % 2 = 0"))
    t.append(orders.where("o_orderkey % 2 = 1").select("o_orderkey"), schema_policy="evolve")
    return t.read()


@query("SELECT o_orderkey, o_totalprice, o_orderkey * 2 AS twice FROM orders WHERE o_orderkey % 2 = 0")
def replace_evolve_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replace may add a column that is never null, as no stored row outlives it."""
    t, orders = _table(spark, "orders"), _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    t.append(orders)
    wider = orders.where("o_orderkey % 2 = 0").withColumn("twice", F.coalesce(F.col("o_orderkey") * 2, F.lit(0).cast("long")))
    t.replace(wider, schema_policy="evolve")
    return t.read()


@query("""SELECT vec_id, CAST(vec_id % 2 = 0 AS BOOLEAN) AS flag, CAST(vec_id % 100 AS TINYINT) AS tiny, CAST(vec_id AS SMALLINT) AS small, CAST(vec_id AS INTEGER) AS whole, CAST(vec_id AS DECIMAL(20, 4)) AS exact,
          CAST(DATE '2024-01-01' + CAST(vec_id AS INTEGER) AS DATE) AS day, CAST(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(vec_id) AS TIMESTAMP) AS at, encode(CAST(vec_id AS VARCHAR)) AS raw, embedding[1] AS first, label FROM embeddings""")
def type_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column per type. `small` is null for ids that no smallint holds, where the strict cast of the SQL has no result but an error."""
    v = F.col("vec_id")
    df = _read(spark, sf_dir, "embeddings").select(
        "vec_id", (v % 2 == 0).alias("flag"), (v % 100).cast("tinyint").alias("tiny"), v.try_cast("smallint").alias("small"), v.cast("int").alias("whole"), v.cast("decimal(20,4)").alias("exact"),
        F.date_add(F.lit("2024-01-01").cast("date"), v.cast("int")).alias("day"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=v)).alias("at"), v.cast("string").cast("binary").alias("raw"),
        F.struct(F.col("embedding").alias("vector"), F.create_map(F.lit("k"), v).alias("named")).alias("nested"), "label",
    )
    t = _table(spark, "types")
    t.append(df)
    return t.read().select("vec_id", "flag", "tiny", "small", "whole", "exact", "day", "at", "raw", F.col("nested.vector")[0].alias("first"), "label").where(F.col("nested.named")["k"] == F.col("vec_id"))


# Partition values that folder names must not change.
HOSTILE_VALUES = ["abc", "a b", "a/b", "a%b", "a=b", "a:b", "a+b", "a\\b", "a'b", "a\nb", "a\tb", "café", "日本", "😀", "001", "1.0", "1e3", "null", "TRUE", "EU", "eu", " padded "]


def _values(rows: list[tuple], names: list[str]) -> str:
    """SQL for literal rows."""
    quote = lambda x: "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(quote, r)) + ')' for r in rows)}) AS v({', '.join(names)})"


@query(_values([(i, v) for i, v in enumerate([*HOSTILE_VALUES, None])], ["id", "part"]).replace("SELECT *", "SELECT CAST(id AS BIGINT) AS id, CAST(part AS VARCHAR) AS part"))
def partition_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _table(spark, "encoding")
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*HOSTILE_VALUES, None])], "id long, part string")
    t.append(df, options={"partition_by": "part"})
    t.merge(df.where("id % 2 = 0"), ["id"])
    return t.read()


@query(" UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS records FROM {n}" for n in ("region", "nation", "customer", "orders", "events")))
def log_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the log alone."""
    out = []
    for name in ("region", "nation", "customer", "orders", "events"):
        t = _table(spark, name)
        t.append(_read(spark, sf_dir, name))
        out.append((name, t.snapshot().num_records()))
    return spark.createDataFrame(out, "name string, records long")


@query("SELECT event_type, count(*) AS n FROM events WHERE event_id > 250 AND event_id <= 600 GROUP BY event_type")
def file_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose logged bounds lie outside the predicate are not read."""
    t, events = _table(spark, "events"), _read(spark, sf_dir, "events")
    for low in range(0, 1000, 200):
        upper = "" if low == 800 else f" AND event_id < {low + 200}"
        t.append(events.where(f"event_id >= {low}{upper}"))
    snapshot = t.snapshot()
    assert len(snapshot.select_files([("event_id", ">", 250), ("event_id", "<=", 600)])) < len(snapshot.files)
    return t.read(where=[("event_id", ">", 250), ("event_id", "<=", 600)]).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderstatus, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total FROM orders GROUP BY 1")
def csv_source_and_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited text with declared types in, a report as delimited text out."""
    root = fresh_root(spark, "csv")
    delimited.replace_csv(_read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), f"{root}/in")
    t = _table(spark, "orders")
    t.append(delimited.read_csv(spark, f"{root}/in", "o_orderkey long, o_orderstatus string, o_totalprice double"))
    report = t.read().groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    delimited.replace_csv(report, f"{root}/out")
    return delimited.read_csv(spark, f"{root}/out", "o_orderstatus string, orders long, total decimal(38,2)")


@query("SELECT c_custkey, o.n AS orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) o ON c_custkey = o_custkey WHERE try_cast(c_mktsegment AS INTEGER) IS NULL")
def sql_over_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection, filter, join, grouping and try_cast in Spark SQL over views of tables."""
    orders, customers = _table(spark, "orders"), _table(spark, "customers")
    orders.append(_read(spark, sf_dir, "orders"))
    customers.append(_read(spark, sf_dir, "customer"))
    orders.view("tidelake_o")
    customers.view("tidelake_c")
    return spark.sql("WITH o AS (SELECT o_custkey, count(*) AS n FROM tidelake_o WHERE o_orderstatus <> 'P' GROUP BY o_custkey) SELECT c_custkey, o.n AS orders FROM tidelake_c LEFT JOIN o ON c_custkey = o_custkey WHERE try_cast(c_mktsegment AS INT) IS NULL")


def _code(f: Callable[[], object]) -> tuple[str, bool]:
    try:
        f()
    except errors.LakeError as e:
        return e.code, e.transient
    return "none", False


@query("SELECT * FROM orders")
def checkpoint_multipart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose log was cleaned behind a checkpoint of two parts, as other engines leave it, and one more commit."""
    t = _two_versions(spark, sf_dir)
    files, state = files_of(spark, t.root), t.snapshot().state
    adds = [json.dumps({"add": a}) for a in state.files.values()]
    parts = [[json.dumps({"protocol": state.protocol}), json.dumps({"metaData": state.metadata}), *adds[::2]], adds[1::2] or [json.dumps({"txn": {"appId": "a", "version": 1}})]]
    shape = spark.read.json(spark.sparkContext.parallelize([x for p in parts for x in p])).schema
    for i, lines in enumerate(parts):
        spark.read.schema(shape).json(spark.sparkContext.parallelize(lines, 1)).write.parquet(f"{t.root}/_staging/part{i}")
        written = next(e.path for e in files.walk(f"_staging/part{i}") if e.path.endswith(".parquet"))
        files.move(f"_staging/part{i}/{written}", f"{log.LOG}/{state.version:020d}.checkpoint.{i + 1:010d}.{len(parts):010d}.parquet")
    for v in range(state.version + 1):
        files.delete(log.commit_name(v))
    t.append(_read(spark, sf_dir, "orders").where("false"))
    return t.read()


# What tables ask of their writers, and the codes of an append, a replace and a merge that updates.
WRITERS = [
    ("plain", {}, {}, "none", "none", "none"), ("append only", {}, {"delta.appendOnly": "true"}, "none", errors.WRITE_FAILED, errors.WRITE_FAILED), ("constraint", {}, {"delta.constraints.few": "id < 100"}, errors.WRITE_FAILED, errors.WRITE_FAILED, errors.WRITE_FAILED),
    ("column mapping", {"minReaderVersion": 1, "minWriterVersion": 5}, {}, errors.WRITE_FAILED, errors.WRITE_FAILED, errors.WRITE_FAILED), ("unknown feature", {"minReaderVersion": 1, "minWriterVersion": 7, "writerFeatures": ["rowTracking"]}, {}, errors.WRITE_FAILED, errors.WRITE_FAILED, errors.WRITE_FAILED),
    ("known feature", {"minReaderVersion": 1, "minWriterVersion": 7, "writerFeatures": ["appendOnly", "invariants"]}, {}, "none", "none", "none"), ("later writer", {"minReaderVersion": 1, "minWriterVersion": 8}, {}, errors.WRITE_FAILED, errors.WRITE_FAILED, errors.WRITE_FAILED),
    ("change feed", {"minReaderVersion": 1, "minWriterVersion": 4}, {"delta.enableChangeDataFeed": "true"}, errors.WRITE_FAILED, errors.WRITE_FAILED, errors.WRITE_FAILED),
]


@query(_values([(n, *codes) for n, _, _, *codes in WRITERS], ["case_name", "append_code", "replace_code", "merge_code"]))
def writer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes keep what a table's protocol and properties ask, or are refused."""
    lake, base, found = Lake(spark, fresh_root(spark, "writers")), spark.createDataFrame([(1, 1.0)], "id long, amt double"), []
    for i, (name, protocol, properties, *_) in enumerate(WRITERS):
        codes = []
        for how in ("append", "replace", "merge"):
            t = lake.table(f"{how}{i}")
            t.append(base)
            snapshot = t.snapshot()
            metadata = snapshot.state.metadata | {"configuration": properties}
            log.commit(files_of(spark, t.root), snapshot.version, [{"protocol": protocol or snapshot.state.protocol}, {"metaData": metadata}, log.commit_info("SET", {}, None)], True)
            codes.append(_code(lambda: t.write(base, how, ["id"] if how == "merge" else None))[0])  # noqa: B023
        found.append((name, *codes))
    return spark.createDataFrame(found, "case_name string, append_code string, replace_code string, merge_code string")


# Every refusal with its code and whether trying again can help.
GUARDS = [
    ("unknown_option", errors.WRITE_OPTION, False), ("mode_option", errors.WRITE_OPTION, False), ("bad_strategy", errors.WRITE_OPTION, False), ("bad_file_bytes", errors.WRITE_OPTION, False), ("repeated_partition", errors.WRITE_OPTION, False), ("version_option", errors.VERSION_ON_WRITE, False), ("merge_without_keys", errors.MERGE_WITHOUT_KEYS, False),
    ("key_missing", errors.KEY_NOT_IN_SCHEMA, False), ("key_type", errors.KEY_TYPE, False), ("unwritable_type", errors.UNWRITABLE_TYPE, False), ("quoted_name", errors.UNQUOTABLE_NAME, False),
    ("new_column", errors.SCHEMA_MISMATCH, False), ("missing_column", errors.SCHEMA_MISMATCH, False), ("type_differs", errors.SCHEMA_MISMATCH, False), ("case_collision", errors.SCHEMA_MISMATCH, False), ("partition_differs", errors.SCHEMA_MISMATCH, False),
    ("null_key", errors.UNMATCHABLE_KEY, False), ("nan_key", errors.UNMATCHABLE_KEY, False), ("empty_partition", errors.PARTITION_VALUE, False), ("long_partition", errors.PARTITION_VALUE, False), ("predicate", errors.MERGE_PREDICATE, False), ("predicate_unparsable", errors.MERGE_PREDICATE, False),
    ("no_table", errors.READ_FAILED, False), ("no_version", errors.READ_FAILED, False), ("bad_version", errors.VERSION_VALUE, False), ("bad_root", errors.UNSUPPORTED_ROOT, False), ("half_credentials", errors.OPTION_MISMATCH, False), ("lost_race", errors.CONFLICT, True), ("negative_zero_key", "none", False), ("null_partition", "none", False),
]


@query(_values(GUARDS, ["case_name", "code", "transient"]))
def guard_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, fresh_root(spark, "guards"))
    base = spark.createDataFrame([(1, "2026-01-01", 1.0), (2, "2026-01-02", 2.0)], "id long, dt string, amt double")
    t = lake.table("base")
    t.append(base, options={"partition_by": "dt"})
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    rates = lake.table("rates")

    def race() -> None:
        first, second = (t.begin(base.schema, "merge", ["id"]) for _ in range(2))
        for s in (first, second):
            s.write(base)
        first.commit()
        second.commit()

    cases = {
        "unknown_option": lambda: t.append(base, options={"partition_bye": "dt"}), "mode_option": lambda: t.append(base, options={"mode": "append"}), "bad_strategy": lambda: t.write(base, "upsert"), "bad_file_bytes": lambda: t.append(base, options={"target_file_bytes": 0}),
        "repeated_partition": lambda: t.append(base, options={"partition_by": ["dt", "dt "]}), "version_option": lambda: t.append(base, options={"version": 1}), "merge_without_keys": lambda: t.merge(base, []), "key_missing": lambda: t.merge(base, ["ID"]),
        "key_type": lambda: lake.table("lists").merge(frame([([1],)], "id array<int>"), ["id"]), "unwritable_type": lambda: lake.table("voids").append(base.withColumn("v", F.lit(None))), "quoted_name": lambda: t.merge(base.withColumn('a"b', F.lit(1)), ["id"]),
        "new_column": lambda: t.append(base.withColumn("note", F.lit("x"))), "missing_column": lambda: t.append(base.select("id", "dt")), "type_differs": lambda: t.append(base.withColumn("amt", F.col("amt").cast("decimal(10,2)"))), "case_collision": lambda: t.append(base.withColumnRenamed("amt", "AMT"), schema_policy="evolve"),
        "partition_differs": lambda: t.append(base, options={"partition_by": "id"}), "null_key": lambda: t.merge(frame([(None, "d", 1.0)], base.schema), ["id"]), "nan_key": lambda: rates.merge(frame([(float("nan"), "x")], "rate double, label string"), ["rate"]),
        "empty_partition": lambda: t.append(frame([(5, "", 1.0)], base.schema)), "long_partition": lambda: t.append(frame([(5, " " * 90, 1.0)], base.schema)), "predicate": lambda: t.merge(base, ["id"], options={"merge_predicate": "dt = 'a'"}), "predicate_unparsable": lambda: t.merge(base, ["id"], options={"merge_predicate": "target.id = 1 IN ()"}),
        "no_table": lambda: lake.table("nothing").read(), "no_version": lambda: t.read(version=99), "bad_version": lambda: t.read(version="-1"), "bad_root": lambda: Lake(spark, "relative/path"), "half_credentials": lambda: Lake(spark, "s3://bucket/x", access_key_id="A"), "lost_race": race,
        "negative_zero_key": lambda: rates.merge(frame([(-0.0, "x"), (0.0, "y")], "rate double, label string"), ["rate"]), "null_partition": lambda: t.append(frame([(6, None, 1.0)], base.schema)),
    }
    return spark.createDataFrame([(name, *_code(f)) for name, f in cases.items()], "case_name string, code string, transient boolean")


# Predicates over the columns of AWKWARD, and whether the language takes them.
AWKWARD = ["k", "day", "zone", "unit price", "x_", "x1", "Qty"]
PREDICATES = [
    ("target.zone = 'north' AND target.day > '2030-02-01'", True), ("source.zone <> target.zone", True), ("target.\"unit price\" < 7", True), ("source.\"unit price\" = source.Qty", True), ("target.x_ = 'p' OR target.x1 = 'q'", True), ("target.Qty >= 0 AND \"source\".\"Qty\" <= 9", True),
    ("target.zone LIKE 'n%' and NOT target.Qty is null", True), ("target.k IN (4, 5, 6) Or FALSE", True), ("target.Qty BETWEEN -2 AND 2.5e1", True), ("(target.k + 1) * 2 - 3 <> source.k / 4", True), ("target.zone = 'two words' OR target.zone != ''", True), ("target.Qty > .5", True),
    ("target.k = 1; DELETE FROM t", False), ("target.zone = $q$north$q$", False), ("target.`zone` = 'north'", False), ("target.zone = 'n\\'", False), ("target.zone = R'north'", False), ("target.zone = X'6e'", False), ("target.k::int = 1", False), ("target.k = ?", False), ("target.k = :name", False), ("target.zone = 'north", False), ("target.zone = \"north", False),
    ("target.k ~ 3", False), ("\t \n", False), ("", False), ("ZONE = 'north'", False), ("source.ZONE = 'north'", False), ("target.qty = 1", False), ("Target.Qty = 1", False), ("\"OR\" = 1", False), ("target.k = 1 \"AND\" 2 = 2", False), ("zone = 'north'", False), ("\"unit price\" > 1", False), ("k BETWEEN 1 AND 2", False),
    ("target.k = (SELECT max(k) FROM source)", False), ("coalesce(target.k, 0) = 1", False), ("target.k = CASE WHEN TRUE THEN 1 END", False), ("target.colour = 'red'", False), ("left.k = 1", False), ("target.k.k = 1", False), ("target.\"k.day\" = 1", False), ("target.Qty = 2e", False), ("target.Qty = 0x1F", False), ("target.Qty = 3 4x", False),
    ("target.zone = 'o''clock'", False), ("target.\"unit\"\"price\" = 1", False), ("target.k = 1 -- rest", False), ("target.k = 1 /* rest */", False), ("target.k = 2'north'", False), ("x1'north' = 'north'", False), ("target.k = 1) OR (target.k = 2", False), ("((target.k = 1)", False),
]


@query(_values([(i, ok) for i, (_, ok) in enumerate(PREDICATES)], ["id", "accepted"]).replace("SELECT *", "SELECT CAST(id AS BIGINT) AS id, accepted"))
def predicate_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(i, _code(lambda p=p: language.check(p, AWKWARD, AWKWARD))[0] == "none") for i, (p, _) in enumerate(PREDICATES)], "id long, accepted boolean")


# Messages, what must not be left of them, and what must be.
MESSAGES = [
    ("opening the store with fs.s3a.secret.key=q8Zw+17/x= did not work", "q8Zw", "did not work"), ("{\"sessionToken\": \"one two\", \"zone\": 4}", "one two", "\"zone\": 4"), ("DefaultEndpointsProtocol=https;AccountName=tide;AccountKey=bXkga2V5;EndpointSuffix=x", "bXkga2V5", "AccountName=tide"),
    ("PUT https://anna:open-sesame@store.example/b/part-0 was refused", "open-sesame", "store.example/b/part-0"), ("GET https://store.example/b?se=2030&sig=a%2Fb%3D&sp=r was refused", "a%2Fb%3D", "sp=r"), ("header Authorization: Bearer abc.def.ghi was refused", "abc.def.ghi", "was refused"), ("abfss://bin@tide.dfs.core.windows.net/t is not there", "no such part", "bin@tide.dfs.core.windows.net"),
    ("<Reply><Status>denied</Status><SecurityToken>c2VjcmV0</SecurityToken></Reply>", "c2VjcmV0", "denied"), ("[CAST_INVALID_INPUT] The value 'Ms Smith' of the type \"STRING\" cannot be cast to \"BIGINT\"", "Smith", "cannot be cast"), ("For input string: \"4711x\"", "4711", "For input"),
    ("two rows are odd\n+---+-----+\n|  k|name |\n+---+-----+\n|  1|Smith|\n+---+-----+\nsee above", "Smith", "see above"), ("the keyboard: 12, monkey=3", "no such part", "monkey=3"),
]


@query(_values([(i, True, True) for i in range(len(MESSAGES))], ["id", "silenced", "kept"]).replace("SELECT *", "SELECT CAST(id AS BIGINT) AS id, silenced, kept"))
def redaction_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(i, secret not in errors.redact(m), rest in errors.redact(m)) for i, (m, secret, rest) in enumerate(MESSAGES)]
    return spark.createDataFrame(rows, "id long, silenced boolean, kept boolean")


# Failures as Spark, Hadoop and the stores tell them, and their codes.
FAILURES = [
    ("merge", "[MERGE_CARDINALITY_VIOLATION] The ON search condition of the MERGE statement matched a single row from the target table with multiple rows of the source table.", errors.DUPLICATE_MATCH, False), ("write", "[FAILED_READ_FILE.PARQUET_COLUMN_DATA_TYPE_MISMATCH] Data type mismatches when reading Parquet column.", errors.SCHEMA_MISMATCH, False),
    ("write", "[NOT_NULL_ASSERT_VIOLATION] NULL value appeared in non-nullable field", errors.PARTITION_VALUE, False), ("write", "java.io.FileNotFoundException: /t/_staging/x (File name too long)", errors.PARTITION_VALUE, False), ("write", "software.amazon.awssdk.services.s3.model.S3Exception: KeyTooLongError (Status Code: 400)", errors.PARTITION_VALUE, False),
    ("write", "S3Exception: A header you provided implies functionality that is not implemented. (Service: S3, Status Code: 501)", errors.UNSAFE_STORE, False), ("write", "org.apache.hadoop.fs.FileAlreadyExistsException: /t/_delta_log/00000000000000000007.json already exists", errors.CONFLICT, True), ("write", "S3Exception: At least one of the pre-conditions you specified did not hold (PreconditionFailed, Status Code: 412)", errors.CONFLICT, True),
    ("read", "S3Exception: Please reduce your request rate. (Service: S3, SlowDown, Status Code: 503)", errors.CONFLICT, True), ("write", "Operation failed: ServerBusy, 503, PUT", errors.CONFLICT, True), ("read", "java.net.SocketTimeoutException: Read timed out", errors.CONFLICT, True), ("write", "org.apache.hadoop.ipc.StandbyException: Operation category READ is not supported in state standby", errors.CONFLICT, True),
    ("read", "java.nio.file.AccessDeniedException: s3a://b/t: AccessDenied (Status Code: 403)", errors.READ_FAILED, False), ("write", "org.apache.hadoop.security.AccessControlException: Permission denied: user=x, access=WRITE", errors.WRITE_FAILED, False), ("read", "[PATH_NOT_FOUND] Path does not exist: file:/nowhere", errors.READ_FAILED, False), ("write", "no such thing", errors.WRITE_FAILED, False),
]


def _raised(spark: SparkSession) -> list[tuple[str, Callable[[], object], str, bool]]:
    """Operations of Spark and Hadoop that fail here and now, and the codes of what they raise."""
    root = fresh_root(spark, "failures")
    files = HadoopFiles(spark, root if "://" in root else f"file://{root}")
    files.claim("there", "{}\n")
    return [
        ("write", lambda: files.fs.create(files.path("there"), False), errors.CONFLICT, True), ("read", lambda: spark.read.parquet(f"{root}/nothing").count(), errors.READ_FAILED, False),
        ("write", lambda: spark.range(1).select(F.assert_true(F.lit(False))).collect(), errors.WRITE_FAILED, False), ("merge", lambda: spark.range(1).where("id = = 1"), errors.MERGE_PREDICATE, False),
    ]


_CODED = [(code, t) for _, _, code, t in FAILURES] + [(errors.CONFLICT, True), (errors.READ_FAILED, False), (errors.WRITE_FAILED, False), (errors.MERGE_PREDICATE, False)]


@query(_values([(i, code, t) for i, (code, t) in enumerate(_CODED)], ["id", "code", "transient"]).replace("SELECT *", "SELECT CAST(id AS BIGINT) AS id, code, transient"))
def classification_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [errors.translate(RuntimeError(m), kind, "write of orders") for kind, m, _, _ in FAILURES]
    for kind, f, _, _ in _raised(spark):
        try:
            f()
        except Exception as e:
            found.append(errors.translate(e, kind, "write of orders", predicate=True))
    return spark.createDataFrame([(i, e.code, e.transient) for i, e in enumerate(found)], "id long, code string, transient boolean")


# Roots, entities and paths with the locations they mean.
LOCATIONS = [
    ("s3://warehouse/delta", "orders", None, "s3", "s3://warehouse/delta/orders"), ("s3://warehouse/delta/", "orders", None, "s3", "s3://warehouse/delta/orders"), ("S3A://warehouse", "orders", "curated/orders", "s3", "S3A://warehouse/curated/orders"), ("s3://warehouse/delta", "orders", "s3://other/elsewhere", "s3", "s3://other/elsewhere"),
    ("/mnt/lake/", "orders", None, "local", "/mnt/lake/orders"), ("file:///mnt/lake", "orders", "/abs/", "local", "/abs"), ("abfss://fs@acct.dfs.core.windows.net/delta", "o", None, "azure", "abfss://fs@acct.dfs.core.windows.net/delta/o"), ("az://fs/delta", "o", "/p", "azure", "/p"),
    ("hdfs://nn/delta", "o", None, errors.UNSUPPORTED_ROOT, "hdfs://nn/delta/o"), ("gs://bucket", "o", None, errors.UNSUPPORTED_ROOT, "gs://bucket/o"), ("relative/path", "o", None, errors.UNSUPPORTED_ROOT, "relative/path/o"),
]


@query(_values([(r, k, at) for r, _, _, k, at in LOCATIONS], ["root", "kind", "resolved"]))
def location_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    def kind(root: str) -> str:
        try:
            return location.classify(root)
        except errors.LakeError as e:
            return e.code

    return spark.createDataFrame([(r, kind(r), location.resolve(r, e, p)) for r, e, p, _, _ in LOCATIONS], "root string, kind string, resolved string")


# Connections with a setting that must come of them, or must not where the value is null.
CONNECTIONS = [
    ({"root": "s3://w/d", "access_key_id": "AK", "secret_access_key": "SK"}, "fs.s3a.bucket.w.access.key", "AK"), ({"root": "s3://w/d", "endpoint": "store.example:7480"}, "fs.s3a.bucket.w.endpoint", "https://store.example:7480"), ({"root": "s3://w/d", "endpoint": "store.example:7480", "use_ssl": False}, "fs.s3a.bucket.w.endpoint", "http://store.example:7480"),
    ({"root": "s3://w/d", "endpoint": "http://127.0.0.1:7480"}, "fs.s3a.bucket.w.endpoint", "http://127.0.0.1:7480"), ({"root": "s3://w/d", "url_style": "path"}, "fs.s3a.bucket.w.path.style.access", "true"), ({"root": "s3://w/d", "url_style": "path"}, "fs.s3a.bucket.w.connection.ssl.enabled", None), ({"root": "s3://w/d", "use_ssl": False}, "fs.s3a.bucket.w.connection.ssl.enabled", "false"),
    ({"root": "s3://w/d"}, "fs.s3a.bucket.w.create.conditional.enabled", "true"), ({"root": "s3://w/d", "region": "eu-west-1"}, "fs.s3a.bucket.w.endpoint.region", "eu-west-1"), ({"root": "az://fs/d", "account_name": "acct", "account_key": "KEY"}, "fs.azure.account.key.acct.dfs.core.windows.net", "KEY"),
    ({"root": "az://fs/d", "connection_string": "AccountName=acct;AccountKey=cXVheQ==;EndpointSuffix=core.windows.net"}, "fs.azure.account.key.acct.dfs.core.windows.net", "cXVheQ=="), ({"root": "az://fs/d", "account_name": "acct", "tenant_id": "t", "client_id": "c", "client_secret": "s", "account_key": "K"}, "fs.azure.account.key.acct.dfs.core.windows.net", None),
    ({"root": "az://fs/d", "account_name": "acct", "tenant_id": "t", "client_id": "c", "client_secret": "s"}, "fs.azure.account.oauth2.client.secret.acct.dfs.core.windows.net", "s"), ({"root": "az://fs/d", "account_name": "acct", "client_id": "c"}, "fs.azure.account.oauth2.msi.endpoint.acct.dfs.core.windows.net", "http://localhost/msi"),
    ({"root": "az://fs/d", "account_name": "acct", "account_key": "K"}, "fs.azure.account.oauth2.msi.endpoint.acct.dfs.core.windows.net", None), ({"root": "az://fs/d", "connection_string": "AccountName=a;AccountKey=k;BlobEndpoint=http://127.0.0.1:7480/a"}, "fs.azure.always.use.https", "false"), ({"root": "/mnt/lake"}, "anything", None),
]


@query(_values([(i, v) for i, (_, _, v) in enumerate(CONNECTIONS)], ["id", "setting"]).replace("SELECT *", "SELECT CAST(id AS BIGINT) AS id, CAST(setting AS VARCHAR) AS setting"))
def storage_options_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [storage.settings(c, lambda name: "http://localhost/msi" if name == "IDENTITY_ENDPOINT" else None) for c, _, _ in CONNECTIONS]
    return spark.createDataFrame([(i, s.get(k)) for i, (s, (_, k, _)) in enumerate(zip(found, CONNECTIONS))], "id long, setting string")


# Connection and read options with the number of problems they have.
CHECKS = [
    ("connection", {"root": "s3://w/d"}, 0), ("connection", {}, 1), ("connection", {"root": " "}, 1), ("connection", {"root": "gs://b"}, 1), ("connection", {"root": "/x", "region": "r", "account_name": "a"}, 2), ("connection", {"root": "s3://b", "account_name": "a"}, 1), ("connection", {"root": "az://b", "use_ssl": True}, 1),
    ("connection", {"root": "s3://b", "access_key_id": "a"}, 1), ("connection", {"root": "s3://b", "nonsense": 1}, 1), ("read", {"path": "x", "version": 3, "union_by_name": True}, 0), ("read", {"version": -1}, 1), ("read", {"version": "3"}, 1), ("read", {"path": "a/{yyyy-MM-dd}"}, 1), ("read", {"union_by_name": 1, "pushdown_filters": True}, 2),
]


@query(_values([(i, n) for i, (_, _, n) in enumerate(CHECKS)], ["id", "problems"]).replace("SELECT *", "SELECT CAST(id AS BIGINT) AS id, CAST(problems AS BIGINT) AS problems"))
def validation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = {"connection": connection.check_connection, "read": connection.check_read}
    return spark.createDataFrame([(i, len(check[kind](o))) for i, (kind, o, _) in enumerate(CHECKS)], "id long, problems long")


@query(_values([(0, 5), (1, 5), (2, 5), (3, 5)], ["writer", "rows"]).replace("SELECT *", "SELECT CAST(writer AS BIGINT) AS writer, CAST(rows AS BIGINT) AS rows"))
def concurrent_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four writers append at once; each loses races to the others and goes behind them, and every row of each is there."""
    t = _table(spark, "race")
    base = spark.range(5).select(F.lit(0).cast("long").alias("writer"), F.col("id"))
    t.begin(base.schema, "append").commit()
    gate, failed = threading.Barrier(4), []

    def one(i: int) -> None:
        session = t.begin(base.schema, "append")
        session.write(base.withColumn("writer", F.lit(i).cast("long")).select("writer", "id"))
        gate.wait()
        try:
            session.commit()
        except errors.LakeError as e:
            failed.append(e)

    threads = [threading.Thread(target=one, args=(i,)) for i in range(4)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    if failed:
        raise failed[0]
    return t.read().groupBy("writer").agg(F.count(F.lit(1)).alias("rows"))


@query(_values([("requests", 4), ("commits", 4)], ["name", "value"]).replace("SELECT *", "SELECT name, CAST(value AS BIGINT) AS value"))
def write_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The creation, an append, a merge and a replace are one request and one commit each; reads count nothing."""
    lake = Lake(spark, fresh_root(spark, "stats"))
    t, nation = lake.table("nation"), _read(spark, sf_dir, "nation")
    t.append(nation)
    t.merge(nation, ["n_nationkey"])
    t.replace(nation)
    t.read().count()
    assert lake.stats.bytes > 0
    return spark.createDataFrame([("requests", lake.stats.requests), ("commits", lake.stats.commits)], "name string, value long")
