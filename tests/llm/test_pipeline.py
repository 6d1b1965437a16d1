"""The queries against their SQL, and the pipeline against what each stage must do."""

from collections import Counter

import pytest

import corpus_pipeline
from tidelake.llm import decontaminate, near_dedup, queries
from tidelake.llm.common import DOCUMENT_COLUMNS, Saved


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, data, same, name):
    same(queries.QUERIES[name](spark, data), queries.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_other_queries_cover_the_whole_table(spark, data, name):
    found = queries.QUERIES[name](spark, data)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert found.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    bench = spark.read.parquet(f"{data}/benchmark.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = Saved(stage(spark, docs, data), name).df
        assert tuple(out.columns) == DOCUMENT_COLUMNS and out.select("doc_id").subtract(docs.select("doc_id")).count() == 0
        seen.append((name, docs, out))
        docs = out
    assert [n for n, *_ in seen] == ["language", "quality", "near_duplicates", "decontamination"]
    _, before, after = seen[2]
    groups = near_dedup.near_duplicates(before, 5, 80)
    assert {r.doc_id for r in groups.where("kept").collect()} == {r.doc_id for r in after.collect()}
    _, before, after = seen[3]
    dirty = {r.doc_id for r in decontaminate.contaminated(before, bench).where("n_hit > 0").collect()}
    assert decontaminate.contaminated(after, bench).where("n_hit > 0").count() == 0
    text = {r.doc_id: r for r in before.collect()}
    assert all(r == text[r.doc_id] for r in after.collect() if r.doc_id not in dirty)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_language_stage_drops_what_was_not_learned(spark):
    big = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{big}/documents.parquet").select(*DOCUMENT_COLUMNS)
    foreign = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.", "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.", "Minden emberi lény szabadon születik és egyenlő méltósága és joga van.",
        "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi.", "Все люди рождаются свободными и равными в своем достоинстве.", "Привет",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι.", "すべての人間は、生まれながらにして自由であり", "日本語", "人人生而自由,在尊严和权利上一律平等。", "يولد جميع الناس أحرارا متساوين في الكرامة",
        "सभी मनुष्यों को गौरव और अधिकारों के मामले में", "%%% 123 ### x !!! 456 --- ###", "$$$ " * 50 + "q", "§ … — !!! é " + "— " * 40,
    ]
    clean = ["the", "La.", "This is it.", "All human beings are born free and equal in dignity and rights.", "Alle Menschen sind frei und gleich an Würde und Rechten geboren.", "Tous les êtres humains naissent libres et égaux en dignité et en droits."]
    planted = [(-1 - i, t, None, "planted", len(t)) for i, t in enumerate(foreign + clean)]
    out = corpus_pipeline.identify_language(spark, docs.unionByName(spark.createDataFrame(planted, docs.schema)), big)
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert [t for i, t in enumerate(foreign) if -1 - i in kept] == [] and [t for i, t in enumerate(clean) if -1 - len(foreign) - i not in kept] == []
    assert {r.doc_id for r in docs.select("doc_id").collect()} <= kept


def test_run_is_the_stages_in_turn(spark, data):
    assert corpus_pipeline.run(spark, data).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "placed_by"]


def test_empty_documents_pass_all_stages(spark, data, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data)
    assert docs.count() == 0


def joined_rows(rows):
    """For each row, whether it is the first of its group, as brute force over all rows tells."""
    shingles = []
    for r in rows:
        w = (r.text or "").encode().lower().split()
        shingles.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w and r.doc_id is not None else set())
    least = [r.doc_id for r in rows]
    while True:
        before = list(least)
        for i in range(len(rows)):
            for j in range(i):
                a, b = shingles[i], shingles[j]
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    least[i] = least[j] = min(least[i], least[j])
        if before == least:
            break
    return [not s or r.doc_id == k for r, s, k in zip(rows, shingles, least)]


def test_stages_on_awkward_documents(spark, data, with_clashes):
    """Null, repeated and two-text ids, null and empty and very long texts, ties and columns of clashing names."""
    awkward, _ = with_clashes
    docs = spark.read.parquet(f"{data}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    again = awkward.where("doc_id in (0, 2)")  # repeated rows
    for name in ("language", "quality", "near_duplicates", "decontamination"):
        mixed = docs.unionByName(awkward.unionByName(again), allowMissingColumns=True) if name != "near_duplicates" else awkward.unionByName(again)
        rows = Saved(mixed, "mixed").df
        out = stages[name](spark, rows, data)
        assert tuple(out.columns) == DOCUMENT_COLUMNS
        before, after = rows.select(*DOCUMENT_COLUMNS).collect(), out.collect()
        have = Counter((r.doc_id, r.text) for r in before)
        got = Counter((r.doc_id, r.text) for r in after)
        if name != "decontamination":
            assert got <= have and all(got[k] in (0, n) for k, n in have.items())  # repeated rows stay or go together
        if name == "language":
            assert not [r for r in after if not (r.text or "").strip()] and all(r.lang in ("en", "de", "es", "fr") for r in after)
        if name == "near_duplicates":
            assert got == Counter((r.doc_id, r.text) for r, stays in zip(before, joined_rows(before)) if stays)
            assert (4, before[0].text) not in got and [k for k in got if k[0] is None]
        if name == "decontamination":
            assert Counter(k[0] for k in got) == Counter(k[0] for k in have) or len(after) < len(before)
            assert decontaminate.contaminated(out, spark.read.parquet(f"{data}/benchmark.parquet")).where("n_hit > 0").count() == 0
    packed = stages["packing"](spark, Saved(awkward, "awkward").df, data).collect()
    starts = Counter(r.doc_id for r in packed if r.start == 0)
    assert starts == Counter(r.doc_id for r in awkward.collect())
