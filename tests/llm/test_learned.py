"""Quality and language: what they learn from, held-out accuracy, and awkward documents."""

import numpy as np
import pytest

from tidelake.llm import langid, quality
from tidelake.llm.features import drawn, ngrams

from .conftest import fold


@pytest.fixture(scope="module")
def tables(spark, data):
    big = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")


def test_language_on_held_out_documents(spark, tables):
    docs, _ = tables
    model = langid.fit(langid.training_rows(docs), 200)
    assert set(model.families) == {"germanic", "romance"} and len(model.pairs) == 2
    got = [r for r in langid.identify(docs.select("doc_id", "text", "lang"), model).collect() if fold(r.doc_id, 4) == 2]
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.99 and all(0 <= r.score <= 1 for r in got)


def test_quality_on_held_out_documents(spark, tables):
    docs, labels = tables
    model = quality.fit(docs, labels)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = [(truth[r.doc_id], r.predicted, r.score) for r in quality.classify(docs.select("doc_id", "text"), model).collect() if r.doc_id in truth and fold(r.doc_id, 3) == 1]
    good = [p for t, p, _ in got if t == 1]
    bad = [p for t, p, _ in got if t == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.15 and abs(model.prior - 0.86) < 0.05
    assert all(0 <= s <= 1 and p == (s >= 0.5) for _, p, s in got)


def test_prior_and_cut_are_found_among_all_texts():
    r = np.random.default_rng(5)
    draw = lambda n, share: np.where(r.random((n, 1)) < share, r.normal(1, 0.3, (n, 8)), r.normal(-1, 0.3, (n, 8)))
    for share in (0.3, 0.7, 0.9):
        p, u = draw(1500, 1.0), draw(6000, share)
        w = quality.separating(quality.Moments.of(p), quality.Moments.of(u))
        below = np.searchsorted(np.sort(u @ w[:-1]), p @ w[:-1]) / len(u)
        prior = quality.estimate_prior(below)
        assert abs(prior - share) < 0.06 and abs(quality.cut_share(below, prior) - (1 - share)) < 0.05


def test_weights_have_the_least_squared_risk():
    """Against the risk itself, summed over rows, around the weights that were solved for."""
    r = np.random.default_rng(8)
    p = r.normal(0.6, 1, (3000, 5))
    u = np.vstack([r.normal(0.6, 1, (3600, 5)), r.normal(-0.6, 1, (5400, 5))])
    prior, f = 0.4, lambda x, w: x @ w[:-1] + w[-1]
    w = quality.non_negative_risk(quality.Moments.of(p), quality.Moments.of(u), prior)
    risk = lambda v: prior * ((1 - f(p, v)) ** 2 / 4).mean() + ((1 + f(u, v)) ** 2 / 4).mean() - prior * ((1 + f(p, v)) ** 2 / 4).mean()
    assert abs(quality.negative_risk(w, quality.Moments.of(p), quality.Moments.of(u), prior) - (((1 + f(u, w)) ** 2 / 4).mean() - prior * ((1 + f(p, w)) ** 2 / 4).mean())) < 1e-9
    assert all(risk(w) <= risk(w + r.normal(0, 0.05, 6)) + 1e-5 for _ in range(50))


def test_risk_of_the_negative_part_is_not_negative():
    r = np.random.default_rng(6)
    p, u = (quality.Moments.of(r.normal(0, 1, (n, 200))) for n in (40, 80))
    w = quality.non_negative_risk(p, u, 0.5)
    assert np.isfinite(w).all() and quality.negative_risk(w, p, u, 0.5) >= 0


def test_moments_and_shares_are_those_of_all_rows(spark, tables):
    docs, _ = tables
    docs = docs.limit(700).repartition(5).cache()
    features = quality._featured(docs, spark.createDataFrame([], "id long")).df
    x = np.stack([np.frombuffer(r.x, np.float16) for r in features.collect()]).astype(np.float64)
    got, want = quality.corpus_moments(features), quality.Moments.of(x)
    assert got.rows == 700 and np.allclose(got.second, want.second) and np.allclose(got.first, want.first)
    r = np.random.default_rng(1)
    w, marks = r.normal(size=quality.WIDTH + 1), np.sort(r.normal(size=30))
    z = x @ w[:-1] + w[-1]
    assert np.allclose(quality.shares_below(features, [w, -w], [marks, marks]), [[(s < m).mean() for m in marks] for s in (z, -z)])
    for share in (0.0, 0.1, 0.9, 1.0):
        assert abs((z < quality.score_at(features, w, share)).mean() - share) < 0.01


def test_support_vectors_separate():
    r = np.random.default_rng(1)
    x = np.vstack([r.normal(1, 0.5, (50, 5)), r.normal(-1, 0.5, (50, 5))]).astype(np.float32)
    y = np.repeat([1.0, -1.0], 50)
    w = langid.svm(x, y)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).all()


def test_whole_texts_are_read():
    a, b = b"ab" * 2_000_000, b"ab" * 2_000_000 + b"#" * 1_000_000
    assert not np.allclose(ngrams(a, None, 64), ngrams(b, None, 64))
    assert abs(np.linalg.norm(ngrams(b, None, 64)) - 1) < 1e-5 and not ngrams(b"", None, 64).any() and not ngrams(None, None, 64).any()


def test_awkward_documents(spark, with_clashes, no_docs, tables):
    df, rows = with_clashes
    docs, labels = tables
    model = langid.fit(langid.training_rows(df))
    found = langid.identify(df, model)
    assert found.columns == [c for c in df.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    got = {(r.doc_id, r.text): r for r in found.collect()}
    for text in (None, "", "  \n\t ", "§ … — !!!"):
        assert all(r.lang_pred == "und" and r.score == 0 for (_, t), r in got.items() if t == text)
    assert got[11, rows[11][1]].lang_pred != "und"
    empty = langid.fit(langid.training_rows(no_docs))
    assert {r.lang_pred for r in langid.identify(df, empty).collect()} == {"und"} and langid.identify(no_docs, model).count() == 0
    scored = quality.classify(df, quality.fit(docs, labels, 300)).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    nothing = quality.fit(df, labels.where("false"))
    assert {(r.score, r.predicted) for r in quality.classify(df, nothing).collect()} == {(0.5, 1)}
    assert quality.classify(no_docs, nothing).count() == 0 and quality.fit(no_docs, labels).prior == 0.5


def test_a_row_repeated_very_often_does_not_crowd_out_others(spark):
    many = [(1, "der Hund und die Katze", "de")] * 3000 + [(i, f"the house number {i} by the road", "en") for i in range(10, 60)] + [(i, f"das Haus Nummer {i} an der Straße", "de") for i in range(100, 400)]
    got = drawn(spark.createDataFrame(many, "doc_id long, text string, lang string").repartition(4), "lang", 40, 3).collect()
    texts = [r.text for r in got]
    assert len(set(texts)) == len(texts) and 30 <= sum(r.lang == "de" for r in got) < 140 and sum(r.lang == "en" for r in got) >= 25


def test_any_number_of_positives_follows_one_rule(spark):
    """From one positive to many, and with a trusted document that repeats."""
    good = [(i, " ".join(f"Word{k} and then some." for k in range(i % 7 + 5)), None) for i in range(60)]
    bad = [(1000 + i, "$$ ## !! " * (5 + i % 6), None) for i in range(20)]
    docs = spark.createDataFrame([*good, *bad, *[good[0]] * 200], "doc_id long, text string, lang string")
    for n in (1, 2, 7, 60):
        model = quality.fit(docs, spark.createDataFrame([(i, 1) for i in range(n)], "doc_id long, quality int"))
        assert np.isfinite(model.weights).all() and 0 < model.prior < 1
        got = {r.doc_id: r for r in quality.classify(docs, model).collect()}
        if n == 60:
            assert all(got[i].predicted == 1 for i in range(60)) and not any(got[1000 + i].predicted for i in range(20))


def test_quality_is_that_of_brute_force_over_all_rows(spark):
    """The same model from all features at once, without Spark; and scores that are the formula's."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(docs, labels)
    rows = docs.select("doc_id", "text").collect()
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1 and fold(r.doc_id, 3) != 1}
    x = np.stack([quality.vector(r.text.encode() if r.text else None).astype(np.float16).astype(np.float64) for r in rows])
    order = {r.id: i for i, r in enumerate(quality._featured(docs, spark.createDataFrame([(i,) for i in trusted], "id long")).df.where("mine").selectExpr("id", "xxhash64(id, x) h").distinct().orderBy("h", "id").collect())}
    p = np.stack([v for _, v in sorted((order[r.doc_id], v.tolist()) for r, v in zip(rows, x) if r.doc_id in trusted)])
    u, one = quality.Moments.of(x), lambda v: np.column_stack([v, np.ones(len(v))])

    def left_out(fitted):
        shares = []
        for f in quality.folds(p):
            w = fitted(quality.Moments.of(p[~f]))
            shares += [(one(x) @ w < s - 1e-9).mean() for s in np.sort(one(p[f]) @ w)]
        return np.array(shares)

    prior = quality.estimate_prior(left_out(lambda m: quality.separating(m, u)))
    risk_of = lambda m: quality.non_negative_risk(m, u, prior)
    w = risk_of(quality.Moments.of(p))
    share = quality.cut_share(left_out(risk_of), prior)
    assert abs(model.prior - prior) < 1e-3 and np.allclose(model.weights[:-1], w[:-1], atol=1e-3 * np.abs(w).max())
    got = {r.doc_id: r for r in quality.classify(docs.select("doc_id", "text"), model).collect()}
    below = np.mean([got[r.doc_id].score < 0.5 for r in rows])
    assert abs(below - share) < 0.01
    for r in rows[::37]:
        z = quality.vector(r.text.encode() if r.text else None).astype(float) @ model.weights[:-1] + model.weights[-1]
        assert abs(got[r.doc_id].score - 1 / (1 + np.exp(-quality.STEEP * z))) < 1e-9


def test_languages_are_those_of_the_formula(spark):
    """Family, votes and score of every text of a table, by loops over classes and pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(langid.training_rows(docs))
    got = {r.doc_id: r for r in langid.identify(docs.select("doc_id", "text"), model).collect()}
    for r in docs.collect():
        if not langid.has_letter((r.text or "").encode()):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0)
            continue
        x = np.append(langid.vector(r.text.encode()), 1)
        z = [sum(a * b for a, b in zip(x, model.weights[:, k])) for k in range(len(model.families))]
        p = [np.exp(v - max(z)) for v in z]
        best = int(np.argmax(p))
        langs = model.members[model.families[best]]
        belief = dict.fromkeys(langs, 0.0)
        for (a, b), w in model.pairs.items():
            if a in langs and b in langs:
                q = 1 / (1 + np.exp(-3.0 * float(x @ w)))
                belief[a] += q
                belief[b] += 1 - q
        want = max(langs, key=belief.get)
        assert got[r.doc_id].lang_pred == want and abs(got[r.doc_id].score - p[best] / sum(p) * belief[want] / max(1, len(langs) - 1)) < 1e-4


def test_grams_are_counted_as_loops_count_them():
    text, bins, shift = b"abracadabra, abra!", 64, 33 - (64).bit_length()
    counts = np.zeros(bins)
    for i in range(len(text)):
        y = None
        for n in range(min(3, len(text) - i)):
            c = text[i + n]
            y = (c * 0x9E3779B1 + 0x7F4A7C15) % 2**32 if y is None else ((y ^ (y >> 15)) * 0x2C1B3C6D + c * 0x9E3779B1) % 2**32
            counts[(y * 0x85EBCA6B) % 2**32 >> shift] += 1
    assert np.allclose(ngrams(text, None, bins), np.sqrt(counts / counts.sum()), atol=1e-6)
