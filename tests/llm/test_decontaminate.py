import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelake.llm import decontaminate as D

from .conftest import prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    owners = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            owners.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in owners}:
            for k in range(len(w) - n + 1):
                if (o := owners.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= {str(i) for i in o if i is not None}
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.integers(1, 4))
def test_index_finds_what_a_scan_finds(symbols, n):
    text = np.array([0, *symbols], np.int64)
    index = D.FMIndex(text, 4, sample=3)
    patterns = np.array([[1 + (k // 4**j) % 4 for j in range(n)] for k in range(4**n)], np.int64)
    which, lo, hi = index.search(patterns.ravel(), np.arange(len(patterns)) * n, n)
    got = {int(p): sorted(index.locate(np.arange(a, b)).tolist()) for p, a, b in zip(which, lo, hi)}
    want = {}
    for k, p in enumerate(patterns):
        at = [i for i in range(len(text) - n + 1) if (text[i : i + n] == p).all()]
        if at:
            want[k] = at
    assert got == want


@pytest.mark.parametrize("shard", [5, 12, 40, 300])
def test_an_index_has_no_more_symbols_than_a_shard(monkeypatch, shard):
    items, docs = items_and_docs()
    patterns = D.Patterns([(i, (t or "").encode()) for i, t in items], 4)
    texts = [None if t is None else t.encode() for _, t in docs] + [" ".join(t for _, t in items if t).encode() * 3]
    want, sizes, real = D.hits(texts, patterns), [], D.FMIndex
    monkeypatch.setattr(D, "SHARD", shard)
    monkeypatch.setattr(D, "FMIndex", lambda text, *a: sizes.append(len(text)) or real(text, *a))
    assert D.hits(texts, patterns) == want and max(sizes) <= shard and len(sizes) > 1 and any(s for _, s, _ in want)


def items_and_docs():
    items = [(i, prose(100 + i, 25)) for i in range(12)] + [(90, "Short one here"), (91, None), (92, ""), (None, prose(300, 15)), (5, prose(301, 12)), (93, prose(100, 25))]
    r = random.Random(4)
    docs = []
    for d in range(60):
        text = prose(1000 + d, r.randint(0, 80))
        if d % 3 == 0:
            text += " " + (items[r.randrange(12)][1] or "") + " " + prose(d, 5)
        if d % 7 == 0:
            text += "!! SHORT one,here -- " + (items[15][1] or "")
        docs.append((d, text))
    return [*docs, (100, None), (101, ""), (102, (items[0][1] + " ") * 40), (3, docs[0][1]), (None, items[2][1])], items


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 500])
def test_hits_equal_brute_force(spark, block):
    docs, items = items_and_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = D.find(df, spark.createDataFrame(items, "item_id long, text string"), 10, block).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found), key=str) == brute(docs, items, 10)
    assert all(r.n_hit == sum(s.after - s.first for s in r.spans) for r in found)


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 500])
def test_cutting_leaves_no_occurrence_and_clean_texts_alone(spark, block):
    docs, items = items_and_docs()
    half = words(items[0][1])
    docs.append((200, " ".join([*half[:8], *words(items[1][1]), *half[8:20]])))  # cutting the middle brings an occurrence together
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = D.decontaminate(df, bench, 10, block).collect()
    assert not [r for r in brute([(r.doc_id, r.text) for r in out], items, 10) if r[2]]
    clean = {str(d) for d in brute(docs, items, 10) if not d[2]}
    before = sorted((d for d in docs if str(brute([d], items, 10)[0]) in clean), key=str)
    after = [(r.doc_id, r.text) for r in out]
    assert all(d in after for d in before) and 102 not in {r.doc_id for r in out}


def test_awkward_documents(spark, with_clashes, no_docs):
    df, rows = with_clashes
    bench = spark.createDataFrame([(1, rows[4][1])], "item_id long, text string")
    found = D.contaminated(df, bench).collect()
    assert len(found) == len(rows) and sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found), key=str) == brute([r[:2] for r in rows], [(1, rows[4][1])], 10)
    assert D.contaminated(no_docs, bench).count() == 0
    assert D.contaminated(df, bench.where("false")).where("n_hit > 0").count() == 0
    cut = D.decontaminate(df, bench)
    assert cut.columns == df.columns and D.contaminated(cut, bench).where("n_hit > 0").count() == 0


def test_small_shards_find_the_same(spark):
    docs, items = items_and_docs()
    patterns = D.Patterns([(i, (t or "").encode()) for i, t in items], 10)
    texts = [t.encode() if t else None for _, t in docs]
    assert D.hits(texts, patterns) == [x for t in texts for x in D.hits([t], patterns)]


def test_windows_of_absent_words_are_not_searched():
    patterns = D.Patterns([(1, b"one two three four"), (2, b"two three one two"), (3, b"nine")], 2)
    there = np.array([patterns.vocabulary[w] for w in (b"one", b"two", b"three")])
    n, which = next((n, w) for n, w in patterns.possible(there) if n == 2)
    _, places, _, _ = next(g for g in patterns.groups if g[0] == n)
    names = {v: k for k, v in patterns.vocabulary.items()}
    got = {tuple(names[x] for x in patterns.text[p : p + n]) for p in places[which]}
    assert got == {(b"one", b"two"), (b"two", b"three"), (b"three", b"one")} and len(places) == 4
    assert not any(len(w) for _, w in patterns.possible(np.zeros(0, np.int64)))


def test_patterns_take_bytes_in_proportion_to_their_words():
    import pickle

    texts = [(i, prose(i, 2000, 8 * 5 * 8).encode()) for i in range(60)]
    n = sum(len(t.split()) for _, t in texts)
    assert len(pickle.dumps(D.Patterns(texts, 10))) < 30 * n


def test_shards_span_batches():
    import pyarrow as pa

    batch = lambda ts: pa.RecordBatch.from_arrays([pa.array(ts, pa.string())], names=["text"])
    held = list(D._shards(iter([batch(["a", "b"]), batch([]), batch([None, "x" * (D.HELD_BYTES + 5), "c"]), batch(["d"])])))
    assert [t for _, ts in held for t in ts] == [b"a", b"b", None, b"x" * (D.HELD_BYTES + 5), b"c", b"d"]
    assert [len(ts) for _, ts in held] == [3, 1, 2] and all(sum(b.num_rows for b in bs) == len(ts) for bs, ts in held)
