"""Tables end to end: versions, strategies, refusals, races, and tables that other engines wrote."""

import json
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidelake import errors
from tidelake.catalog import Lake
from tidelake.errors import LakeError
from tidelake.plans.pruning import derive
from tidelake.plans.windows import Window
from tidelake.sources.files import HadoopFiles, LocalFiles
from tidelake.streaming.ingest import into_table

SCHEMA = "id long, dt string, amt double"


def rows(n, start=0):
    return [(i, f"2026-01-{i % 8 + 1:02d}", float(i)) for i in range(start, start + n)]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def logged(lake, name, version):
    return [json.loads(x) for x in (Path(lake.root) / name / "_delta_log" / f"{version:020d}.json").read_text().splitlines()]


def code(f, *a, **b):
    with pytest.raises(LakeError) as e:
        f(*a, **b)
    return e.value.code


def test_log_has_the_actions_of_the_protocol(spark, lake):
    t = lake.table("t")
    t.append(frame(spark, rows(4)), options={"partition_by": "dt"})
    kinds = [next(iter(a)) for a in logged(lake, "t", 0)]
    assert kinds == ["protocol", "metaData", "commitInfo"] and logged(lake, "t", 0)[0]["protocol"] == {"minReaderVersion": 1, "minWriterVersion": 2}
    adds = [a["add"] for a in logged(lake, "t", 1) if "add" in a]
    assert {a["partitionValues"]["dt"] for a in adds} == {r[1] for r in rows(4)} and all(json.loads(a["stats"])["numRecords"] == 1 for a in adds)
    t.append(frame(spark, rows(1)).withColumn("at", F.lit("2024-01-01").cast("timestamp_ntz")).withColumn("at", F.when(F.col("id") >= 0, F.col("at"))), schema_policy="evolve")
    assert logged(lake, "t", 2)[0]["protocol"]["readerFeatures"] == ["timestampNtz"]


def test_versions_have_their_own_schema(spark, lake):
    t = lake.table("t")
    t.append(frame(spark, rows(2)))
    t.append(frame(spark, [(9, "d", 1.0, "x")], SCHEMA + ", note string"), schema_policy="evolve")
    assert t.schema(0).names == ["id", "dt", "amt"] and t.read(0).count() == 0 and t.read(1).count() == 2
    assert t.schema().names[-1] == "note" and got(t.read().select("note").distinct().where("note is not null")) == [("x",)]
    assert code(t.read, 7) == errors.READ_FAILED and code(lake.table("none").read) == errors.READ_FAILED


def test_merge_worked_examples(spark, lake):
    t = lake.table("t")
    t.append(frame(spark, rows(4)))
    t.merge(frame(spark, [(2, "x", 99.0), (7, "x", 1.0)]), ["id"])
    assert len(got(t.read())) == 5 and (2, "x", 99.0) in got(t.read())
    t.merge([frame(spark, [(5, "a", 1.0)]), frame(spark, [(5, "a", 2.0)]), frame(spark, [(5, "a", 3.0)])], ["id"])
    assert (5, "a", 3.0) in got(t.read()) and t.read().where("id = 5").count() == 1
    before = got(t.read())
    t.merge(frame(spark, [(5, "a", 3.0)]), ["id"])
    assert got(t.read()) == before


def test_merge_rewrites_only_files_with_a_match(spark, lake):
    t = lake.table("t")
    for part in range(4):
        t.append(frame(spark, rows(5, part * 5)).coalesce(1))
    t.merge(frame(spark, [(7, "x", 0.0)]), ["id"])
    assert sum("remove" in a for a in logged(lake, "t", 5)) == 1


def test_composite_keys_and_partition_moves(spark, lake):
    t = lake.table("t")
    t.merge(frame(spark, [(1, "d1", 1.0), (1, "d2", 10.0), (1, "d1", 2.0)]).coalesce(1), ["id", "dt"], options={"partition_by": "dt"})
    assert got(t.read()) == [(1, "d1", 2.0), (1, "d2", 10.0)]
    u = lake.table("u")
    u.append(frame(spark, [(1, "d1", 1.0)]), options={"partition_by": "dt"})
    u.merge(frame(spark, [(1, "d9", 1.0)]), ["id"])
    assert got(u.read()) == [(1, "d9", 1.0)]


def test_refusals_leave_no_trace(spark, lake):
    t = lake.table("t")
    t.append(frame(spark, rows(3)), options={"partition_by": "dt"})
    have = t.snapshot().version
    assert code(t.append, frame(spark, [(1, "", 1.0)])) == errors.PARTITION_VALUE
    assert code(t.merge, frame(spark, [(None, "d", 1.0)]), ["id"]) == errors.UNMATCHABLE_KEY
    with pytest.raises(LakeError) as e:
        t.append(frame(spark, [(1, "confidential" * 30, 1.0)]))
    assert e.value.code == errors.PARTITION_VALUE and "confidential" not in str(e.value)
    assert t.snapshot().version == have and not list((Path(lake.root) / "t" / "_staging").glob("*"))
    assert code(lake.table("bad").merge, frame(spark, [([1], 1.0)], "id array<long>, amt double"), ["id"]) == errors.KEY_TYPE
    assert not (Path(lake.root) / "bad").exists()


def test_not_null_is_kept_by_the_log_and_guarded(spark, lake):
    from pyspark.sql import types as T

    strict = T.StructType([T.StructField("id", T.LongType(), False)])
    t = lake.table("t")
    t.append(spark.createDataFrame([(1,)], strict))
    assert not t.schema()["id"].nullable
    assert code(t.append, frame(spark, [(None,)], "id long")) == errors.PARTITION_VALUE


def test_session_states(spark, lake):
    t = lake.table("t")
    s = t.begin(frame(spark, rows(1)).schema, "append")
    s.write(frame(spark, rows(2)))
    result = s.commit()
    assert (result.rows, result.frames, result.version) == (2, 1, 1)
    for again in (s.commit, s.abort, lambda: s.write(frame(spark, rows(1)))):
        with pytest.raises(RuntimeError):
            again()
    aborted = t.begin(frame(spark, rows(1)).schema, "append")
    aborted.write(frame(spark, rows(2)))
    aborted.abort()
    assert t.snapshot().version == 1
    assert t.begin(frame(spark, rows(1)).schema, "merge", ["id"]).commit().version is None
    t.begin(frame(spark, rows(1)).schema, "replace").commit()
    assert t.count() == 0 and t.schema().names == ["id", "dt", "amt"]


def test_racing_merges_have_one_winner_and_a_transient_loser(spark, lake):
    t = lake.table("t")
    t.append(frame(spark, rows(5)))
    sessions = [t.begin(frame(spark, rows(1)).schema, "merge", ["id"]) for _ in range(2)]
    for i, s in enumerate(sessions):
        s.write(frame(spark, [(1, "w", float(i))]))
    sessions[0].commit()
    with pytest.raises(LakeError) as e:
        sessions[1].commit()
    assert e.value.code == errors.CONFLICT and e.value.transient


def test_replace_against_a_concurrent_append(spark, lake):
    for keep in (False, True):
        t = lake.table(f"t{keep}")
        t.append(frame(spark, rows(5)))
        s = t.begin(frame(spark, rows(1)).schema, "replace", keep_concurrent=keep)
        s.write(frame(spark, rows(1)))
        t.append(frame(spark, rows(2, 50)))
        if keep:
            s.commit()
            assert t.count() == 3  # what came in between stays
        else:
            assert code(s.commit) == errors.CONFLICT


@pytest.mark.parametrize("kind", ["local", "hadoop"])
def test_a_commit_file_has_one_writer(spark, tmp_path, kind):
    files = LocalFiles(str(tmp_path)) if kind == "local" else HadoopFiles(spark, f"file://{tmp_path}")
    if kind == "hadoop":
        assert files.claim("a.json", "1") and not files.claim("a.json", "2") and files.read("a.json") == "1"
        return
    won, gate = [], threading.Barrier(8)

    def one(i):
        gate.wait()
        if files.claim("_delta_log/0.json", str(i)):
            won.append(i)

    threads = [threading.Thread(target=one, args=(i,)) for i in range(8)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert len(won) == 1 and files.read("_delta_log/0.json") == str(won[0])


def test_a_table_through_hadoop_files(spark, lake, monkeypatch):
    from tidelake.operators import session
    from tidelake.sources import snapshot

    for module in (session, snapshot):
        monkeypatch.setattr(module, "files_of", lambda s, root: HadoopFiles(s, root))
    t = lake.table("t")
    t.append(frame(spark, rows(6)), options={"partition_by": "dt"})
    t.merge(frame(spark, [(2, "2026-01-03", 9.0)]), ["id", "dt"])
    assert t.snapshot().num_records() == 6 and (2, "2026-01-03", 9.0) in got(t.read())


def test_partition_values_of_the_log_win_over_folders(spark, lake):
    """Another engine may name folders otherwise."""
    t = lake.table("t")
    t.append(frame(spark, [(1, "a", 1.0), (2, "b", 2.0)]).coalesce(1), options={"partition_by": "dt"})
    log = Path(lake.root) / "t" / "_delta_log" / f"{1:020d}.json"
    moved = []
    for i, a in enumerate(logged(lake, "t", 1)):
        if "add" in a:
            old = Path(lake.root) / "t" / a["add"]["path"]
            new = f"files with space/{i}%.parquet"
            (Path(lake.root) / "t" / new).parent.mkdir(exist_ok=True)
            old.rename(Path(lake.root) / "t" / new)
            a["add"]["path"] = new.replace("%", "%25").replace(" ", "%20")
        moved.append(json.dumps(a))
    log.write_text("\n".join(moved))
    assert got(t.read()) == [(1, "a", 1.0), (2, "b", 2.0)]
    t.merge(frame(spark, [(1, "a", 5.0)]), ["id"])
    assert got(t.read()) == [(1, "a", 5.0), (2, "b", 2.0)]


def test_checkpoints_are_read_and_unknown_features_refused(spark, lake):
    t = lake.table("t")
    t.append(frame(spark, rows(3)))
    t.append(frame(spark, rows(3, 3)))
    log = Path(lake.root) / "t" / "_delta_log"
    actions = [a for v in (0, 1) for a in logged(lake, "t", v) if "commitInfo" not in a]
    spark.read.json(spark.sparkContext.parallelize([json.dumps(a) for a in actions])).coalesce(1).write.parquet(str(log / "cp"))
    part = next((log / "cp").glob("part-*.parquet"))
    part.rename(log / f"{1:020d}.checkpoint.parquet")
    for v in (0, 1):
        (log / f"{v:020d}.json").unlink()
    assert t.count() == 6
    with (log / f"{3:020d}.json").open("w") as f:
        f.write(json.dumps({"protocol": {"minReaderVersion": 3, "minWriterVersion": 7, "readerFeatures": ["deletionVectors"]}}))
    assert code(t.read) == errors.READ_FAILED


def test_scans_push_filters_and_prune_columns_and_partitions(spark, lake):
    t = lake.table("t")
    t.append(frame(spark, rows(40)), options={"partition_by": "dt"})
    plan = t.read().where("dt = '2026-01-02' AND id > 3").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "GreaterThan(id,3)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_windows_over_a_table(spark, lake):
    t = lake.table("t")
    t.append(frame(spark, rows(11)))
    assert [r.id for r in t.read(window=Window("id", "3", "7")).orderBy("id").collect()] == [4, 5, 6, 7]
    assert code(t.read, window=Window("ID", "3")) == errors.READ_FAILED
    with pytest.raises(Exception):
        t.read(window=Window("id", "not a number")).collect()


def test_derived_partition_filters(spark):
    df = frame(spark, [(1, "a", 1.0), (2, "b", 2.0), (3, "a", 3.0)])
    assert derive(df, ["dt"], ["id", "dt"]).filters == {"dt": ["'a'", "'b'"]}
    assert derive(df, None, ["id"]).filters is None and derive(df, None, ["id"]).reason is None
    for bad, keys in (([(1, None, 1.0)], ["dt"]), ([(1, "it's", 1.0)], ["dt"]), ([(i, str(i), 1.0) for i in range(257)], ["dt"]), ([(1, "a", 1.0)], ["id"])):
        found = derive(frame(spark, bad), ["dt"], keys)
        assert found.filters is None and found.reason and "it's" not in found.reason
    assert len(derive(frame(spark, [(i, str(i), 1.0) for i in range(256)]), ["dt"], ["dt"]).filters["dt"]) == 256
    assert derive(df.where("false"), ["dt"], ["dt"]).reason is None and derive(df, ["amt"], ["amt"]).reason


def test_hot_keys_are_reduced_before_the_shuffle(spark, lake):
    t = lake.table("t")
    many = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("id"), F.lit("d").alias("dt"), F.col("id").cast("double").alias("amt"))
    t.merge(many, ["id"], order_by=["amt"])
    assert got(t.read().where("id = 0").select("amt")) == [(19998.0,)]


def test_extra_columns_with_clashing_names(spark, lake):
    t = lake.table("t")
    odd = frame(spark, [(1, 2, 3, "x")], "id long, __order long, __row long, `__file` string")
    t.append(odd)
    t.merge(frame(spark, [(1, 5, 6, "y")], "id long, __row long, other long, `__file` string").select("id", "__row", F.lit(7).cast("long").alias("x"), "__file").drop("x").withColumn("__order", F.lit(4).cast("long")), ["id"])
    assert t.read().count() == 1


def test_streams_merge_each_batch(spark, lake, tmp_path):
    frame(spark, rows(4)).coalesce(1).write.parquet(str(tmp_path / "in"))
    t = lake.table("t")
    q = into_table(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), t, ["id"], str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert got(t.read()) == rows(4)


class SlowStore:
    """A store where a name can be seen before its content, as one that creates, writes and closes shows it."""

    def __init__(self, files):
        self.files, self.hidden = files, {}

    def __getattr__(self, name):
        return getattr(self.files, name)

    def read(self, name):
        text = self.hidden.get(name, [])
        return text.pop(0) if text else self.files.read(name)


def test_a_loser_never_takes_a_commit_that_is_half_there_for_an_empty_one(spark, lake, monkeypatch):
    t = lake.table("t")
    t.append(frame(spark, rows(5)))
    loser = t.begin(frame(spark, rows(1)).schema, "merge", ["id"])
    loser.write(frame(spark, [(1, "w", 1.0)]))
    t.append(frame(spark, rows(2, 20)))
    name = f"_delta_log/{2:020d}.json"
    loser.files = SlowStore(loser.files)
    loser.files.hidden[name] = ["", '{"add":{"path":"x'] + [""] * 2
    assert code(loser.commit) == errors.CONFLICT
    # A commit that stays empty is a transient error for whoever needs to know what it holds.
    loser = t.begin(frame(spark, rows(1)).schema, "merge", ["id"])
    loser.write(frame(spark, [(1, "w", 1.0)]))
    (Path(lake.root) / "t" / "_delta_log" / f"{3:020d}.json").write_text("")
    with pytest.raises(LakeError) as e:
        loser.commit()
    assert e.value.code == errors.CONFLICT and e.value.transient and "not complete" in str(e.value)


def test_a_crashed_claim_does_not_block_the_table(spark, tmp_path, monkeypatch):
    files = HadoopFiles(spark, f"file://{tmp_path}")

    def crash(old, new):
        raise OSError("the writer is gone")

    monkeypatch.setattr(files, "_rename_if_free", crash)
    with pytest.raises(OSError):
        files.claim("_delta_log/0.json", "{}\n")
    assert "0.json" not in files.names("_delta_log")
    assert HadoopFiles(spark, f"file://{tmp_path}").claim("_delta_log/0.json", "{}\n") and not HadoopFiles(spark, f"file://{tmp_path}").claim("_delta_log/0.json", "[]\n")
    assert files.read("_delta_log/0.json") == "{}\n"


def property_table(spark, lake, name, **properties):
    t = lake.table(name)
    t.append(frame(spark, rows(3)))
    at = Path(lake.root) / name / "_delta_log" / f"{0:020d}.json"
    actions = [json.loads(x) for x in at.read_text().splitlines()]
    for a in actions:
        if "metaData" in a:
            a["metaData"]["configuration"] = {k: v for k, v in properties.items() if k.startswith("delta")}
        if "protocol" in a and "protocol" in properties:
            a["protocol"] = properties["protocol"]
    at.write_text("\n".join(map(json.dumps, actions)) + "\n")
    return t


def test_writes_keep_what_a_table_asks_of_its_writers(spark, lake):
    t = property_table(spark, lake, "only", **{"delta.appendOnly": "true"})
    t.append(frame(spark, rows(1, 9)))
    assert code(t.replace, frame(spark, rows(1))) == errors.WRITE_FAILED and code(t.merge, frame(spark, rows(1)), ["id"]) == errors.WRITE_FAILED
    t.merge(frame(spark, rows(1, 50)), ["id"])  # nothing matches, so nothing is removed
    assert t.count() == 5 and not list((Path(lake.root) / "only" / "_staging").glob("*"))
    t = property_table(spark, lake, "bound", **{"delta.constraints.small": "id < 100"})
    assert code(t.append, frame(spark, rows(1))) == errors.WRITE_FAILED and t.count() == 3
    for i, protocol in enumerate([{"minReaderVersion": 1, "minWriterVersion": 6}, {"minReaderVersion": 1, "minWriterVersion": 7, "writerFeatures": ["rowTracking"]}, {"minReaderVersion": 1, "minWriterVersion": 8}]):
        t = property_table(spark, lake, f"p{i}", protocol=protocol)
        assert t.count() == 3 and code(t.append, frame(spark, rows(1))) == errors.WRITE_FAILED
    t = property_table(spark, lake, "fine", protocol={"minReaderVersion": 1, "minWriterVersion": 7, "writerFeatures": ["appendOnly", "invariants"]})
    t.append(frame(spark, rows(1)))
    assert t.count() == 4


@pytest.mark.parametrize("kind", ["parts", "uuid", "json", "sidecar"])
def test_checkpoints_of_other_shapes(spark, lake, kind):
    t = lake.table("t")
    t.append(frame(spark, rows(4)), options={"partition_by": "dt"})
    t.append(frame(spark, rows(4, 4)))
    log, name = Path(lake.root) / "t" / "_delta_log", f"{2:020d}.checkpoint"
    actions = [json.dumps(a) for v in (0, 1, 2) for a in logged(lake, "t", v) if "commitInfo" not in a]
    adds, rest = [a for a in actions if '"add"' in a], [a for a in actions if '"add"' not in a]
    uid = "80a083e8-7026-4e79-81be-64bd76c43a11"

    def parquet(lines, to):
        schema = "protocol struct<minReaderVersion:int,minWriterVersion:int>, metaData struct<id:string,schemaString:string,partitionColumns:array<string>,configuration:map<string,string>>, add struct<path:string,partitionValues:map<string,string>,size:long,modificationTime:long,dataChange:boolean,stats:string>, sidecar struct<path:string,sizeInBytes:long>"
        spark.read.schema(schema).json(spark.sparkContext.parallelize(lines)).coalesce(1).write.parquet(str(log / "cp"), mode="overwrite")
        to.parent.mkdir(exist_ok=True)
        next((log / "cp").glob("part-*.parquet")).rename(to)

    if kind == "parts":
        parquet([*rest, *adds[:3]], log / f"{name}.{1:010d}.{2:010d}.parquet")
        parquet(adds[3:], log / f"{name}.{2:010d}.{2:010d}.parquet")
        (log / f"{3:020d}.checkpoint.{1:010d}.{2:010d}.parquet").write_text("a part whose other part is missing")
    elif kind == "uuid":
        parquet(actions, log / f"{name}.{uid}.parquet")
    elif kind == "json":
        (log / f"{name}.{uid}.json").write_text("\n".join(actions))
    else:
        parquet(adds, log / "_sidecars" / f"{uid}.parquet")
        (log / f"{name}.{uid}.json").write_text("\n".join([*rest, json.dumps({"sidecar": {"path": f"{uid}.parquet", "sizeInBytes": 1}})]))
    for v in (0, 1, 2):
        (log / f"{v:020d}.json").unlink()
    assert got(t.read()) == sorted(rows(8)) and t.snapshot().version == 2
    with pytest.raises(LakeError, match="its log begins at version 2"):
        t.read(1)
    if kind == "parts":
        (log / f"{3:020d}.checkpoint.{1:010d}.{2:010d}.parquet").unlink()
    t.append(frame(spark, rows(1, 8)))
    assert t.count() == 9 and t.snapshot().version == 3


def test_merges_tell_their_partition_filter(spark, lake):
    t = lake.table("t")
    t.append(frame(spark, rows(16)), options={"partition_by": "dt"})
    result = t.merge(frame(spark, [(1, "2026-01-02", 5.0), (9, "2026-01-02", 6.0)]), ["id", "dt"])
    assert result.partition_filter == {"dt": ["'2026-01-02'"]} and result.filter_skipped is None
    info = next(a["commitInfo"] for a in logged(lake, "t", 2) if "commitInfo" in a)
    assert 'target."dt" IN (\'2026-01-02\')' in info["operationParameters"]["statement"]
    result = t.merge(frame(spark, [(1, "2026-01-02", 7.0)]), ["id"])
    assert result.partition_filter is None and "not merge keys" in result.filter_skipped
    assert "not merge keys" in next(a["commitInfo"] for a in logged(lake, "t", 3) if "commitInfo" in a)["operationParameters"]["partitionFilterSkipped"]


@pytest.mark.parametrize("local_bytes", [8 << 20, -1])
def test_merges_of_small_and_large_inputs_agree(spark, lake, monkeypatch, local_bytes):
    from tidelake.operators import session

    monkeypatch.setattr(session, "LOCAL_BYTES", local_bytes)
    schema = "id long, dt string, at timestamp, ntz timestamp_ntz, d date, x decimal(20,4), raw binary, s struct<a:int,b:array<string>>"
    make = lambda ids, add: spark.range(0, 40).where(f"id in ({','.join(map(str, ids))})").selectExpr("id", "concat('p', id % 3) dt", f"timestamp_seconds(id * 1000 + {add}) at", f"cast(timestamp_seconds(id + {add}) as timestamp_ntz) ntz", f"date_add(date '2024-01-01', cast(id + {add} as int)) d", f"cast(id + {add} as decimal(20,4)) x", "cast(string(id) as binary) raw", f"named_struct('a', cast(id + {add} as int), 'b', array('x', null)) s")
    t = lake.table("t")
    t.append(make(range(30), 0), options={"partition_by": "dt"})
    t.merge([make([1, 2, 35], 5), make([2], 9)], ["id", "dt"])
    want = make([i for i in range(30) if i not in (1, 2)], 0).unionByName(make([1, 35], 5)).unionByName(make([2], 9))
    assert sorted(map(str, t.read().collect())) == sorted(map(str, want.collect())) and t.schema().names == [c.split()[0] for c in schema.split(", ")]


def test_marks_stand_for_what_was_written_and_only_rise(spark, tmp_path):
    from tidelake.streaming.watermark import Seen, WatermarkStore

    store = WatermarkStore(spark, str(tmp_path))
    write = lambda seen: seen.df.write.format("noop").mode("overwrite").save()
    live = spark.range(10).withColumn("at", F.expr("id + 90"))
    seen = Seen(live, "at")
    write(seen)
    assert store.advance("m", seen) == "99" == store.get("m")
    for top, want in ((5, "99"), (100, "100"), (-1, "100")):  # an older run, a newer one, an empty one
        seen = Seen(spark.range(top + 1).withColumnRenamed("id", "at"), "at")
        write(seen)
        assert store.advance("m", seen) == want
    seen = Seen(frame(spark, rows(3)), "dt")
    write(seen)
    assert store.advance("d", seen) == "2026-01-03"


def test_object_store_locations_open_under_hadoops_schemes(spark, tmp_path):
    """Through a file system that answers to s3a and keeps its files on this disk."""
    conf = spark._jsc.hadoopConfiguration()
    (tmp_path / "bucket").mkdir()
    conf.set("fs.s3a.impl", "org.apache.hadoop.fs.viewfs.ViewFileSystemOverloadScheme")
    conf.set("fs.viewfs.overload.scheme.target.s3a.impl", "org.apache.hadoop.fs.LocalFileSystem")
    conf.set("fs.viewfs.mounttable.tide.link./lake", f"file://{tmp_path}/bucket")
    lake = Lake(spark, "s3://tide/lake", access_key_id="a", secret_access_key="b")
    t = lake.table("orders")
    assert t.root == "s3a://tide/lake/orders"
    t.append(frame(spark, rows(8)), options={"partition_by": "dt"})
    t.merge(frame(spark, [(2, "2026-01-03", 9.0)]), ["id", "dt"])
    assert t.snapshot().num_records() == 8 and (2, "2026-01-03", 9.0) in got(t.read()) and (tmp_path / "bucket" / "orders" / "_delta_log").is_dir()
    s = [t.begin(frame(spark, rows(1)).schema, "merge", ["id"]) for _ in range(2)]
    for i, x in enumerate(s):
        x.write(frame(spark, [(1, "w", float(i))]))
    s[0].commit()
    assert code(s[1].commit) == errors.CONFLICT


def test_statistics_by_a_job_are_those_of_the_footers(spark, tmp_path):
    import datetime

    from tidelake.operators import staging
    from tidelake.sources.snapshot import _typed

    df = spark.range(0, 500).selectExpr("id", "concat('p', id % 3) p", "if(id % 7 = 0, null, id * 1.5) f", "if(id % 50 = 3, double('nan'), id) g", "date_add(date '2020-01-01', cast(id as int)) d", "cast(timestamp_seconds(id * 997) as timestamp_ntz) ts", "cast(id / 3 as decimal(12,3)) x", "concat('name ', id, repeat('x', cast(id % 60 as int))) s", "id % 2 = 0 b", "named_struct('a', id) n", "cast(null as int) z").repartition(2, "p")
    local, hadoop = LocalFiles(str(tmp_path)), HadoopFiles(spark, f"file://{tmp_path}")
    staged = staging.stage(df, local, str(tmp_path), ["p"], 1000)
    body = [f for f in df.schema.fields if f.name != "p"]
    counted = staging._counted(df, f"{tmp_path}/{staged.folder}", [e for e, _ in staged.entries], body)
    assert len(counted) > 3 and [e.path for e in hadoop.walk(staged.folder) if e.path.endswith(".parquet")] == [e.path for e, _ in staged.entries]
    kinds = {f.name: f.dataType for f in body}
    for (_, footer), job in zip(staged.entries, counted):
        assert footer["numRecords"] == job["numRecords"]
        assert {k: v for k, v in job["nullCount"].items()} == {k: v for k, v in footer["nullCount"].items() if k in job["nullCount"]}
        for side in ("minValues", "maxValues"):
            both = set(footer[side]) & set(job[side])
            assert {"id", "f", "d", "ts"} <= both and not {"z", "n"} & (set(job[side]) | set(footer[side])) and ("g" in job[side]) == ("g" in footer[side])
            assert all(_typed(footer[side][k], kinds[k]) == _typed(job[side][k], kinds[k]) for k in both)
    assert isinstance(datetime.date.fromisoformat(counted[0]["minValues"]["d"]), datetime.date)
