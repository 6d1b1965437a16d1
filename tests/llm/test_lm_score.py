from collections import Counter
from math import log10

import numpy as np
import pytest

from tidelake.llm import lm_score as L

from .conftest import fold, prose


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def base(docs):
    counts = Counter(w for d, t in docs if fold(d, 7) not in (2, None) for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    return total, {str((d, t)): (len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), sum(log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens(t))) for d, t in docs}


WAYS = [{}, {"slice_bytes": 2000}, {"slice_bytes": 2000, "broadcast_text": 0}, {"broadcast_text": 0}]


@pytest.mark.parametrize("how", WAYS)
def test_base_score_is_exact_whatever_the_way(spark, how):
    docs = [(d, prose(d, 3 * d)) for d in range(40)] + [(50, None), (51, ""), (3, prose(3, 9)), (None, "one two")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    total, want = base(docs)
    got = L.score(df, df.where("crc32(cast(cast(doc_id as string) as binary)) % 7 != 2"), **how).collect()
    assert {r.train_tokens for r in got} == {total}
    wanted = Counter((d, *(round(x, 6) for x in want[str((d, t))])) for d, t in docs)
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == wanted
    assert all(r.score < 0 for r in got)


def test_counts_are_read_back():
    hashes = np.unique(L.mix(np.arange(1, 30_001, dtype=np.uint64)))
    keys = np.sort(hashes & L._KEY)
    counts = np.concatenate([np.arange(1, 20_001), np.ones(len(keys) - 20_000, np.int64)]) ** np.where(np.arange(len(keys)) % 2, 1, 2)
    s = L.Slice.build(hashes, counts, keys, counts, 30_000)
    assert (s.token_counts(hashes) == counts).all() and not s.token_counts(L.mix(hashes)).any()
    read = s.pair_counts(keys)
    small = counts < 2 * 2**L.MANTISSA
    assert (read[small] == counts[small]).mean() > 0.98  # an entry may be there by chance, and never is missing
    assert (np.abs(read / counts - 1) <= 1 / 128).mean() > 0.98 and (read >= counts * (1 - 1 / 128)).all()
    other = np.sort(L.mix(hashes + np.uint64(5)) & L._KEY)
    assert (s.pair_counts(other) > 0).mean() <= 3 * s.false_rate() + 1e-3


def test_keys_are_packed_and_unpacked():
    keys = np.sort(np.random.default_rng(4).integers(0, 1 << L.KEY_BITS, 1000).astype(np.uint64))
    assert (L.unpack_keys(L.pack_keys(keys)) == keys).all() and len(L.pack_keys(keys)) == 5000 and len(L.unpack_keys(b"")) == 0


def exact_model(docs):
    """The same model from exact counts of tokens and pairs."""
    uni, pair = Counter(), Counter()
    for _, t in docs:
        w = tokens(t)
        uni.update(w)
        pair.update(zip([None, *w[:-1]], w))
    total, kinds = sum(uni.values()), len(uni)
    alone = lambda w: (uni[w] + 1) / (total + kinds + 1)
    return uni, pair, lambda v, w: (pair[v, w] + L.MASS * alone(w)) / (uni[v] + L.MASS)


@pytest.mark.parametrize("how", WAYS)
def test_scores_are_those_of_exact_counts_within_the_bounds_of_the_filter(spark, how):
    docs = [(d, prose(d % 25, 30 + 5 * d)) for d in range(80)] + [(90, None), (91, "nothing of this is known"), (92, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    train = [x for x in docs if x[0] < 70]
    _, _, p = exact_model(train)
    got = {r.doc_id: r for r in L.score(df, df.where("doc_id < 70"), **how).collect()}
    for d, t in docs:
        w = tokens(t)
        want = sum(log10(p(v, x)) for v, x in zip([None, *w[:-1]], w))
        # Of each token: 1/128 of a count, the false positives in the divisor, and now and then a false pair in the dividend.
        assert abs(got[d].score - want) <= 0.01 * len(w) + 0.02 * abs(want), d


def test_ways_agree_and_read_the_same_rows(spark):
    docs = [(d, prose(d % 30, 40)) for d in range(200)] + [(None, prose(1, 9)), (5, prose(1, 40))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    ways = [Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 4)) for r in L.score(df, df, **how).collect()) for how in ({"slice_bytes": 3000}, {"slice_bytes": 3000, "broadcast_text": 0})]
    assert ways[0] == ways[1]


def test_blocks_that_are_read_otherwise_are_written_and_asked_again(spark, tmp_path, monkeypatch):
    docs = [(d, prose(d % 30, 40)) for d in range(100)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    df, calls, real = spark.read.parquet(str(tmp_path / "d")), [], L._routed
    assert L._rereadable(df.select("doc_id", "text")) and not L._rereadable(df.repartition(2))

    def once(*a):
        calls.append(a[0])
        if len(calls) == 1:
            raise RuntimeError(f"job aborted: {L.MISREAD}")
        return real(*a)

    monkeypatch.setattr(L, "_routed", once)
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    got = L.score(df, df, slice_bytes=3000, broadcast_text=0)
    assert len(calls) == 2 and got.count() == 100 and spark.conf.get("spark.sql.files.minPartitionNum", None) == before, (len(calls), before)
    want = L.score(df, df, slice_bytes=3000)
    assert sorted((r.doc_id, round(r.score, 4)) for r in got.collect()) == sorted((r.doc_id, round(r.score, 4)) for r in want.collect())


def test_probabilities_sum_to_one(spark, data):
    """Over the vocabulary of a whole table and one unknown word, after common and rare words."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data.replace('sf0.001', 'sf0.01')}/documents.parquet").collect()]
    uni, pair, _ = exact_model(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    saved = L.Saved(L._reduced(L._counted(df, 2), 2), "filter").df
    about, slices = L.About(saved, 2, L.MASS), {r["slice"]: L._slice_of(r) for r in saved.collect()}
    words = [w for w, _ in uni.most_common()]
    assert (about.total, about.kinds) == (sum(uni.values()), len(words))
    hashes = np.array([L.END if w is None else L.word_hashes([w])[0] for w in [*words, b"\x00 no word"]], np.uint64)
    alone = np.array([uni[w] + 1 for w in words] + [1]) / (about.total + about.kinds + 1)
    assert abs(alone.sum() - 1) < 1e-9
    for at in (0, 1, 2, 5, 20, 100, 500, 1000, 5000, len(words) - 1):
        ids = L.mix(hashes[at] * L._PAIR + hashes) >> np.uint64(L.MOST_SLICE_BITS - 2)
        seen = np.zeros(len(ids))
        for s, model in slices.items():
            mine = L._pair_slice(ids) == s
            seen[mine] = model.pair_counts(ids[mine] & L._KEY)
        p = about.probability(seen, np.full(len(ids), float(uni[words[at]])), alone)
        assert abs(p.sum() - 1) < 0.01, (at, words[at], p.sum())


def test_repeated_prose_scores_above_the_base(spark):
    docs = [(d, prose(d % 10, 200)) for d in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = L.score(df, df).collect()
    assert sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got)  # both negative: pairs that were seen are likelier


def test_awkward_documents(spark, with_clashes, no_docs):
    df, rows = with_clashes
    for how in WAYS:
        assert L.score(df, df, **how).count() == len(rows) and L.score(no_docs, df, **how).count() == 0
    assert {r.n_known for r in L.score(df, no_docs).collect()} == {0}
