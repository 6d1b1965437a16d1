"""Archives, shards and licences."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelake.llm import licenses, sharding, warc
from tidelake.llm.common import numbered

from .conftest import prose


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("ab", max_size=2), st.integers(0, 3)), max_size=8), max_size=9))
def test_loser_tree_merges(runs):
    rows = [sorted((k, str(t), None, 0, "", "", None, f"f{i}", j, 0) for j, (k, t) in enumerate(run)) for i, run in enumerate(runs)]
    rows = [sorted(r, key=warc._order) for r in rows]
    assert list(warc.LoserTree(rows)) == sorted((x for r in rows for x in r), key=warc._order)


def pages(spark):
    r = random.Random(3)
    rows = [(i, f"https://www.a{i % 7}.example.com/p/{i % 5}?q={i}" if i % 5 else "https://hot.example.com/", prose(i % 40, r.randint(1, 60)) if i % 4 else "same payload") for i in range(200)]
    rows += [(900, None, None), (901, "http://b ad/\r\nurl", ""), (None, "http://x", "same payload"), (902, "http://x", "é" * 70_000), (902, "http://x", "é" * 70_000), (903, "http://y", "body\r\n\r\nWARC/1.1\r\n\r\n")]
    return spark.createDataFrame([(*x, "clash", 1) for x in rows], "page_id long, url string, html string, digest string, bytes int").repartition(5), rows


@pytest.mark.parametrize(("least", "range_rows", "run_rows"), [(0, 50_000, 200_000), (20, 30, 1), (0, 30, 25)])
def test_archives_round_trip(spark, tmp_path, least, range_rows, run_rows):
    df, rows = pages(spark)
    warc.write_archives(df, str(tmp_path / "w"), least, archive_bytes=20_000)
    merged = warc.merged_index(spark, str(tmp_path / "w"), range_rows, run_rows).collect()
    order = [(r.urlkey, r.captured, r.archive, r.offset) for r in merged]
    assert order == sorted(order) and len({r.archive for r in merged}) > 3
    body = {i: (h or "").encode() for i, _, h in rows}
    digest = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    last = {}
    for i, _, h in rows:
        if i is not None:
            b = (h or "").encode()
            last[b] = max(last.get(b, i), i)
    want = Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        again = i is not None and len(b) >= least and i < last[b]
        want[i, len(b), digest(b), "revisit" if again else "response", last[b] if again else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in merged) == want
    for r in merged[::17]:  # an entry leads to its record
        data = (tmp_path / "w" / r.archive).read_bytes()[r.offset : r.offset + r.length]
        headers, _, _, block = next(warc.parse(data))
        assert headers["WARC-Type"] == r.record_type and (r.record_type == "revisit" or block.partition(b"\r\n\r\n")[2] == body[r.page_id] or r.page_id is None)


def test_large_pages_among_small_ones_make_no_large_archive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CLASSES", [0, 1000, 50_000, 1 << 40])
    monkeypatch.setattr(warc, "MOST_BYTES", 400_000)
    rows = [(i, f"http://x/{i}", "s" * (i % 90)) for i in range(3000)] + [(5000 + i, f"http://x/{i}", f"{i}" + "l" * 190_000) for i in range(8)] + [(6000 + i, f"http://x/{i}", f"{i}" + "m" * 20_000) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "w"), archive_bytes=300_000)
    assert max(f.stat().st_size for f in (tmp_path / "w").glob("part-*")) <= 400_000
    got = warc.merged_index(spark, str(tmp_path / "w"))
    assert Counter((r.page_id, r.payload_bytes) for r in got.collect()) == Counter((i, len(h)) for i, _, h in rows)


def test_no_pages(spark):
    df, _ = pages(spark)
    assert warc.archive(df.where("false")).count() == 0


def test_url_keys():
    assert warc.url_key("HTTP://user@WWW.Example.COM:80/A?b=1#c") == "com,example)/a?b=1" and warc.url_key("urn:page:5") == "urn:page:5" and warc.url_key("http://[bad") == "http://[bad"


def shard_rows(spark, docs, **how):
    return sharding.kd_shards(spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").repartition(4), **how).collect()


def check_shards(got, docs, n):
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in docs)
    for s in range(n):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(0 <= r.shard < n for r in got)


@pytest.mark.parametrize("n", [1, 3, 8])
def test_shards_are_near_equal(spark, n):
    docs = [(i, prose(i, 5 + i % 50), f"s{i % 3}" if i % 4 else "hot", ["en", "fr", None][i % 3]) for i in range(3000)]
    docs += [(10_000 + i, prose(7, 30), f"s{i}", "en") for i in range(12)]  # a small group of copies from many sources
    got = shard_rows(spark, docs, shards=n)
    check_shards(got, docs, n)
    sizes = [sum(r["size"] for r in got if r.shard == s) for s in range(n)]
    assert max(sizes) - min(sizes) < 0.02 * max(sizes)
    assert len({r.shard for r in got if r.doc_id >= 10_000}) == 1


def test_a_third_of_copies_still_splits_evenly(spark):
    docs = [(i, "the same text" if i % 3 == 0 else prose(i, 3), "s", "en") for i in range(3000)]
    got = shard_rows(spark, docs, shards=8)
    check_shards(got, docs, 8)
    sizes = [sum(r["size"] for r in got if r.shard == s) for s in range(8)]
    assert max(sizes) < 1.03 * min(sizes)


def by_brute_force(rows, dims, shards, at=0):
    """{row: shard} by the same tree over all rows at once; rows are (row, size, keys), a sort key for each dimension."""
    if shards == 1 or not rows:
        return {r: at for r, _, _ in rows}
    total = sum(s for _, s, _ in rows)
    value = lambda k: (k >> (sharding.TEXT_BITS + sharding.ID_BITS)) / (1 << sharding.VALUE_BITS)
    spread = [sum(s * value(k[d]) ** 2 for _, s, k in rows) / total - (sum(s * value(k[d]) for _, s, k in rows) / total) ** 2 for d in range(dims)]
    d = max(range(dims), key=lambda i: (round(spread[i], 12), -i))
    want, below = total * (shards // 2) / shards, 0
    for bits in (sharding.ID_BITS, 0):  # groups of equal value and text first, then rows
        groups = Counter()
        for _, s, k in rows:
            groups[k[d] >> bits] += s
        below = 0
        for g in sorted(groups):
            if below + groups[g] >= want:
                break
            below += groups[g]
        alone = sum(k[d] >> bits == g for _, _, k in rows) == 1
        if alone or groups[g] <= sharding.GROUP_SLACK * total / shards:
            break
    cut = (g + (below + groups[g] - want < want - below)) << bits
    left = shards // 2
    return by_brute_force([r for r in rows if r[2][d] < cut], dims, left, at) | by_brute_force([r for r in rows if r[2][d] >= cut], dims, shards - left, at + left)


@pytest.mark.parametrize("few", [20_000, 0])
def test_tree_is_that_of_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(sharding, "FEW_ROWS", few)
    r = random.Random(12)
    docs = [(i, prose(r.randrange(400), r.randint(1, 300)), f"https://site{r.randrange(30)}.example", r.choice(["de", "en", "es", None])) for i in range(700)]
    docs += [(2000 + i, prose(1, 900), "https://site1.example", "en") for i in range(40)] + [(3000, "one row", "https://x", "fr")] * 90
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").repartition(3)
    df = sharding.Saved(df, "docs").df
    dims = ["source", "lang", "size"]
    scaled = sharding._scaled(sharding.Saved(sharding._grouped(sharding.Saved(sharding._metadata(df, dims), "m").df, 3), "g").df, 3).collect()
    assert all(len({x[f"d{i}"] for x in scaled}) > 2 for i in range(3))
    for shards in (2, 5, 8) if few else (3,):
        want = by_brute_force([((x.doc_id, x.row), x["size"], [(x[f"d{i}"] << (sharding.TEXT_BITS + sharding.ID_BITS)) | x.tail for i in range(3)]) for x in scaled], 3, shards)
        got = Counter((x.doc_id, x.shard) for x in sharding.kd_shards(df, shards=shards).collect())
        assert got == Counter((d, s) for (d, _), s in want.items())


def test_texts_keep_their_order_on_a_dimension(spark):
    names = ["https://a.example/x", "https://b.example/", "https://ba.example/", "https://c.example/é", None, "https://"]
    df = spark.createDataFrame([(i, f"text {i}", n, "en") for i, n in enumerate(names)], "doc_id long, text string, source string, lang string")
    got = {x.doc_id: x for x in sharding._scaled(sharding.Saved(sharding._metadata(df, ["source", "lang", "absent"]), "m").df, 3).collect()}
    order = sorted((n for n in names if n), key=str.encode)
    places = [got[names.index(n)].d0 for n in order]
    assert places == sorted(places) and len(set(places)) == len(places) and got[4].d0 == 0 and {(x.d1, x.d2) for x in got.values()} == {(0, 0)}


def test_a_row_repeated_very_often_is_dealt_evenly(spark):
    docs = [(1, "the same row", "s", "en")] * 4000 + [(i, prose(i, 6), f"s{i % 9}", "de") for i in range(10, 2010)]
    got = shard_rows(spark, docs, shards=8)
    check_shards(got, docs, 8)
    sizes = [sum(r["size"] for r in got if r.shard == s) for s in range(8)]
    assert max(sizes) < 1.01 * min(sizes)
    assert {r.group_cut for r in got if r.doc_id == 1} == {True} and {r.group_cut for r in got if r.doc_id != 1} == {False}


def test_many_shards_by_target(spark):
    docs = [(i, prose(i, 20), f"s{i % 50}", "de") for i in range(3000)]
    total = sum(len(t) + 1 for _, t, *_ in docs)
    got = shard_rows(spark, docs, target_bytes=total // 100)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    assert len(sizes) in (100, 101) and max(sizes.values()) < 1.1 * total / 100


def test_awkward_shards(spark, with_clashes, no_docs, tmp_path):
    df, rows = with_clashes
    got = sharding.kd_shards(df, shards=8).collect()
    check_shards(got, rows, 8)
    assert sharding.kd_shards(no_docs, shards=8).count() == 0
    by_target = sharding.kd_shards(df, target_bytes=100_000).collect()
    check_shards(by_target, rows, max(r.shard for r in by_target) + 1)
    one = shard_rows(spark, [(1, "a", "s", "en")], shards=8)
    assert len(one) == 1 and one[0].slot == 0
    sharding.write_shards(df, str(tmp_path / "s"), shards=4)
    back = spark.read.parquet(str(tmp_path / "s")).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter(r[:2] for r in rows) and {r.shard for r in back} <= set(range(4))
    many = spark.createDataFrame([(None if i % 3 == 0 else i // 2, f"text {i} " * 5, "s", "en") for i in range(900)], "doc_id long, text string, source string, lang string")
    sharding.write_shards(many, str(tmp_path / "t"), shards=3)
    sizes = Counter()
    for r in spark.read.parquet(str(tmp_path / "t")).collect():
        sizes[r.shard] += len(r.text) + 1
    assert len(sizes) == 3 and max(sizes.values()) < 1.01 * min(sizes.values())


def test_numbers_have_no_gaps_however_hot_a_key(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, null, id % 2) AS k", "id")
    got = numbered(df, ["k"], ["id"], "at", rows_per_bucket=100).collect()
    for k in (None, 0, 1):
        at = sorted(r["at"] for r in got if r.k == k)
        assert at == list(range(len(at)))


def test_licences(spark):
    full = " ".join(licenses.SENTENCES[i][0] for i in ("MITgrant", "MITnotice", "MITnowarranty", "MITnoliability"))
    bsd = "\n".join(licenses.SENTENCES[i][0] for i in ("BSDgrant", "BSDsource", "BSDbinary"))
    wrapped = "\n".join(" ".join(full.split()[k : k + 9]) for k in range(0, len(full.split()), 9))
    cases = {
        wrapped: "MIT", "junk ### line\nReleased under the MIT License.": "MIT",
        full.lower(): "MIT", bsd: "BSD-2-Clause", bsd + "\n" + licenses.SENTENCES["BSDendorse"][0]: "BSD-3-Clause", "Text here. Licensed under CC BY-NC 4.0.\nMore.": "CC-BY-NC-4.0",
        "licensed UNDER the apache licence -- version 2.0!": "Apache-2.0", "Released under the MIT License. This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only,MIT", "Our license is our own.": "", "nothing": "", "": "",
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)] + [(99, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert [got[i].licenses for i in range(len(cases))] == list(cases.values()) and got[99].licenses == "" and got[99].n_known == 0
    assert got[8].sentence_ids == "<?>" and got[8].n_known == 0 and got[0].n_known == 4
    assert all(licenses.normal(s) in licenses.KNOWN for v in licenses.SENTENCES.values() for s in v)


def test_every_known_sentence_and_rule_is_found_in_running_text(spark):
    around = lambda s: f"Some words here: and more.\n{s}\nOther words follow. And more."
    wrapped = lambda s: "\n".join(f"# {' '.join(s.split()[k : k + 6])}" for k in range(0, len(s.split()), 6))
    one = [(f"<{i}>", around(s)) for i, v in licenses.SENTENCES.items() for s in v]
    one += [(f"<{i}>", f"Some words.\n\n{wrapped(s)}\n\nOther words.") for i, v in licenses.SENTENCES.items() for s in v]
    rules = [(name, "".join(f"<{i}>" for i in ids), around("\n".join(licenses.SENTENCES[i][0] for i in ids))) for name, ids in licenses.RULES]
    texts = [t for _, t in one] + [t for *_, t in rules]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].sentence_ids for i in range(len(one))] == [i for i, _ in one]
    assert [(got[len(one) + i].licenses, got[len(one) + i].sentence_ids) for i in range(len(rules))] == [(name, ids) for name, ids, _ in rules]


def test_marks_outside_known_sentences_still_end_one(spark):
    cases = {
        "Free software: you may not use this file except in compliance with the License.": "<?><Apache2use>", "SPDX-License-Identifier:\n\nMIT": "<?>", "SPDX-License-Identifier: MIT-0": "<?>",
        "SPDX-Licence-Identifier: MIT\nReleased under the MIT License.": "<MITref><MITref>", "/* SPDX-License-Identifier: Apache-2.0 */": "<Apache2ref>", "Licensed under the ISC License. SPDX-License-Identifier: ISC. End.": "<ISCref><ISCref>",
        "SPDX-License-Identifier:" + " " * 50_000 + "x": "<?>", "SPDX-License-Identifier" + ". " * 500 + "x": "<?>",
    }
    got = {r.doc_id: r.sentence_ids for r in licenses.scan(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_sql_finds_what_the_operator_finds(spark):
    """On texts that hold what the tables' texts do not."""
    import duckdb

    from tidelake.llm import queries

    texts = [f"Some words here: and more.\n{s}\nOther words follow. And more." for v in licenses.SENTENCES.values() for s in v]
    texts += ["\n".join(licenses.SENTENCES[i][0] for i in ids) for _, ids in licenses.RULES]
    texts += ["SPDX-License-Identifier: MIT SPDX-License-Identifier: ISC SPDX-License-Identifier: EPL-2.0", "SPDX-License-Identifier: MIT-0", "SPDX-License-Identifier:\n\nMIT", "xSPDX-License-Identifier: MIT", "spdx-licence-identifier :  mit.", "", None, "our license: none"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, n_known, sentence_ids, licenses FROM ({queries.ORACLES['op6_license_sentences']})").fetchall()}
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == want


def test_awkward_licences(spark, with_clashes, no_docs):
    df, rows = with_clashes
    assert {r.licenses for r in licenses.scan(df).collect()} == {""} and licenses.scan(df).count() == len(rows) and licenses.scan(no_docs).count() == 0
