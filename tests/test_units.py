"""What needs no job: errors, locations, windows, predicates, options, schemas."""

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tidelake import errors
from tidelake.errors import LakeError
from tidelake.functions import arrow, predicate
from tidelake.functions import types as kinds
from tidelake.plans import options, reconcile
from tidelake.plans.windows import Window
from tidelake.sources import connection
from tidelake.sources.snapshot import folder_says, may_match, unescape


def code(f, *a, **b):
    with pytest.raises(LakeError) as e:
        f(*a, **b)
    return e.value.code


def test_every_code_is_described():
    named = {v for k, v in vars(errors).items() if k.isupper() and isinstance(v, str) and v.startswith("LAKE")}
    assert named == set(errors.CODES)


def test_message_has_code_cause_and_next_step():
    e = LakeError("LAKE0101", "what", "do")
    assert str(e) == "LAKE0101: what. Next step: do" and not e.transient


def test_translate_passes_coded_errors_and_raises_cancellations():
    own = LakeError("LAKE0101", "a", "b")
    assert errors.translate(own, "write", "x") is own
    with pytest.raises(errors.Cancelled):
        errors.translate(errors.Cancelled(), "write", "x")


def test_secrets_are_known_by_the_parts_of_a_name():
    for name in ("fs.s3a.secret.key", "AccountKey", "sessionToken", "AWS_ACCESS_KEY_ID", "client_secret", "dbpassword", "sig"):
        assert errors.is_secret(name)
    for name in ("monkey", "keyboard", "region", "design", "tokenizer", "sassy"):
        assert not errors.is_secret(name)


def test_row_data_never_survives():
    text = "rejected: password=hunter2 and the value '777' of k\n|  k|\n|778|\nthat is all"
    left = errors.redact(text)
    assert not any(x in left for x in ("hunter2", "777", "778")) and "that is all" in left
    assert errors.redact("nothing to hide: part-0.parquet, version 3") == "nothing to hide: part-0.parquet, version 3"


def test_redaction_takes_time_in_proportion():
    import time

    began = time.perf_counter()
    for text in ("key " * 250_000, "<secret>" * 60_000, "a" * 1_000_000, "|x\n" * 300_000):
        errors.redact(text)
    assert time.perf_counter() - began < 10


def test_window_text_and_pairing():
    assert Window("c").sql("f") == "f"
    assert Window('a"b', "o'k").sql("f") == "(select * from f where \"a\"\"b\" > 'o''k')"
    assert Window("c", "1", "2", inclusive=True).sql("f") == "(select * from f where \"c\" >= '1' and \"c\" <= '2')"
    with pytest.raises(ValueError):
        Window("c", None, "2")


def test_merge_text_is_the_statement_a_merge_stands_for():
    assert predicate.merge_text(["id", "dt", "amt"], ["id"]) == (
        'MERGE INTO target USING source ON target."id" = source."id"\n'
        'WHEN MATCHED THEN UPDATE SET target."dt" = source."dt", target."amt" = source."amt"\n'
        'WHEN NOT MATCHED THEN INSERT ("id", "dt", "amt") VALUES (source."id", source."dt", source."amt")\n'
    )
    assert "WHEN MATCHED" not in predicate.merge_text(["id", "dt"], ["id", "dt"])
    assert 'target."dt" IN (\'a\', 1)' in predicate.merge_text(["id", "dt"], ["id", "dt"], partitions={"dt": ["'a'", "1"]})
    for bad in ("$$x$$", "1\n", "'a', 'b'", "'a", "x", "", "'it''s'", "'back\\'"):
        assert code(predicate.merge_text, ["id"], ["id"], partitions={"id": [bad]}) == errors.MERGE_PREDICATE
    for good in ("'a;b'", "'a)b('", "42", "-1.5e3"):
        predicate.merge_text(["id"], ["id"], partitions={"id": [good]})


def test_an_unqualified_column_gets_its_own_refusal():
    with pytest.raises(LakeError, match="which side of the merge"):
        predicate.check("dt = 'x'", ["id", "dt"], ["id", "dt"])
    with pytest.raises(LakeError) as e:
        predicate.check("secretword = 'x'", ["id"], ["id"])
    assert "secretword" not in str(e.value) and "which side" not in str(e.value)


def test_checked_predicate_is_rendered_from_words():
    parts = predicate.check("target.\"weird col\"<=-1 AND source.a In (1,2)", ["weird col"], ["a"])
    assert predicate.to_spark(parts, {("target", "weird col"): "weird col", ("source", "a"): "__s0"}) == "`weird col` <= - 1 AND `__s0` IN ( 1 , 2 )"


def test_options_tell_all_problems_at_once():
    with pytest.raises(LakeError) as e:
        options.parse("upsert", {"partition_bye": "x", "mode": "append", "target_file_bytes": "0"})
    for part in ("strategy", "partition_by'?", "'mode'", "target_file_bytes"):
        assert part in str(e.value)
    spec = options.parse("append", {"partition_by": " dt ", "target_file_bytes": "1000"}, schema_policy="Evolve")
    assert spec.partition_by == ["dt"] and spec.target_file_bytes == 1000 and not spec.evolve
    assert code(options.parse, "append", incremental=True) == errors.WRITE_OPTION
    options.parse("append", incremental=True, duplicates="accept")
    assert code(options.parse, "append", {"partition_by": []}) == errors.WRITE_OPTION


BASE = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("dt", T.StringType()), T.StructField("amt", T.DoubleType())])


@pytest.mark.parametrize(
    ("policy", "strategy", "change", "fits"),
    [
        (None, "append", lambda s: s, True), (None, "append", lambda s: s[::-1], True), (None, "append", lambda s: [*s, T.StructField("note", T.StringType())], False), ("evolve", "append", lambda s: [*s, T.StructField("note", T.StringType())], True),
        ("evolve", "append", lambda s: [*s, T.StructField("note", T.StringType(), False)], False), ("evolve", "replace", lambda s: [*s, T.StructField("note", T.StringType(), False)], True), ("evolve", "append", lambda s: [*s[:2], T.StructField("AMT", T.DoubleType())], False),
        ("evolve", "append", lambda s: s[:2], True), (None, "append", lambda s: s[:2], False), ("evolve", "append", lambda s: s[1:], False), ("evolve", "append", lambda s: [*s[:2], T.StructField("amt", T.DecimalType(10, 2))], False),
    ],
)
def test_reconcile(policy, strategy, change, fits):
    spec = options.parse(strategy, {}, ["id"], policy)
    incoming = T.StructType(list(change(list(BASE.fields))))
    if fits:
        reconcile.reconcile(BASE, [], incoming, spec)
    else:
        assert code(reconcile.reconcile, BASE, [], incoming, spec) == errors.SCHEMA_MISMATCH


def test_types():
    for bad in (T.NullType(), T.DayTimeIntervalType(), T.ArrayType(T.NullType()), T.StructType([T.StructField("a", T.CalendarIntervalType())])):
        assert not kinds.writable(bad)
    assert kinds.writable(T.MapType(T.StringType(), T.ArrayType(T.DecimalType(38, 9))))
    assert not kinds.comparable(T.ArrayType(T.LongType())) and kinds.comparable(T.BinaryType())


def test_arrow_types():
    assert arrow.stored(pa.uint16()) == pa.int16() and arrow.stored(pa.large_string()) == pa.string() and arrow.stored(pa.timestamp("ms", "Z")) == pa.timestamp("us", "UTC")
    assert arrow.stored(pa.dictionary(pa.int8(), pa.string())) == pa.string()
    for bad in (pa.null(), pa.float16(), pa.duration("s"), pa.time32("s"), pa.list_(pa.int64(), 2), pa.timestamp("us", "Europe/Berlin"), pa.struct([("a", pa.null())])):
        assert not arrow.writable(bad)


def test_arrow_table_at_the_edge(spark):
    ok = pa.table({"a": pa.array([1, 2], pa.uint32()), "b": pa.array(["x", None]).dictionary_encode()})
    assert [tuple(r) for r in arrow.to_frame(spark, ok).collect()] == [(1, "x"), (2, None)]
    assert code(arrow.to_frame, spark, pa.table({"a": pa.array([2**31], pa.uint32())})) == errors.PARTITION_VALUE
    assert code(arrow.to_frame, spark, ok, ["b"]) == errors.UNWRITABLE_TYPE


def test_versions():
    assert connection.parse_version(None) is None and connection.parse_version("3") == 3
    for bad in (-1, "x", True, 1.5, 1 << 63):
        assert code(connection.parse_version, bad) == errors.VERSION_VALUE


def test_file_pruning_keeps_what_it_cannot_judge():
    kind = {"a": T.LongType(), "p": T.StringType(), "d": T.DateType()}
    add = {"partitionValues": {"p": "x"}, "stats": '{"numRecords":3,"minValues":{"a":10},"maxValues":{"a":20},"nullCount":{"a":0,"d":3}}'}
    test = lambda c, op, v: may_match(add, (c, op, v), kind, ["p"])
    assert test("a", ">", 19) and not test("a", ">", 20) and test("a", "<=", 10) and not test("a", "<", 10) and test("a", "=", 15) and not test("a", "in", [9, 21])
    assert test("p", "=", "x") and not test("p", "=", "y") and not test("d", ">", "2024-01-01") and test("a", ">", "not a number")
    assert not may_match({"partitionValues": {"p": None}}, ("p", "=", "x"), kind, ["p"]) and may_match({"partitionValues": {}}, ("a", ">", 1), kind, [])


def test_folder_names():
    assert unescape("a%2Fb") == "a/b" and unescape("100%") == "100%"
    assert folder_says({"path": "dt=a%252Fb/part.parquet", "partitionValues": {"dt": "a/b"}}, ["dt"])
    assert not folder_says({"path": "part.parquet", "partitionValues": {"dt": "a"}}, ["dt"])


def test_locations_in_hadoops_schemes():
    from tidelake.sources.storage import hadoop_uri

    az = {"account_name": "acct"}
    for place, options, want in (
        ("/mnt/x", {}, "/mnt/x"), ("file:///mnt/x", {}, "file:///mnt/x"), ("s3://b/x/y", {}, "s3a://b/x/y"), ("S3A://b/x", {}, "s3a://b/x"), ("az://c/x", az, "abfss://c@acct.dfs.core.windows.net/x"), ("adl://c/x/", az, "abfss://c@acct.dfs.core.windows.net/x/"),
        ("abfss://c@other.dfs.core.windows.net/x", az, "abfss://c@other.dfs.core.windows.net/x"), ("abfs://c/x", az, "abfs://c@acct.dfs.core.windows.net/x"), ("az://c", {"connection_string": "AccountName=q;AccountKey=k="}, "abfss://c@q.dfs.core.windows.net"),
        ("az://c/x", {"connection_string": "AccountName=q;AccountKey=k;BlobEndpoint=http://127.0.0.1:9/q"}, "abfs://c@127.0.0.1:9/x"),
    ):
        assert hadoop_uri(place, options) == want
    assert code(hadoop_uri, "az://c/x", {}) == errors.OPTION_MISMATCH


def test_read_options_are_checked_when_a_table_is_named_or_read(spark, tmp_path):
    from tidelake.catalog import Lake

    lake = Lake(spark, str(tmp_path))
    assert code(lake.table, "t", "a/{yyyy-MM-dd}") == errors.READ_FAILED
    assert code(lake.table("t").read, union_by_name=1) == errors.READ_FAILED
