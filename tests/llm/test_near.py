"""Near-duplicate documents and embeddings against brute force."""

import numpy as np
import pytest

from tidelake.llm import embed_dedup as E
from tidelake.llm import near_dedup as N
from tidelake.llm.components import components

from .conftest import prose


def joined(nodes, links):
    parent = {n: n for n in nodes}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_components(spark):
    r = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in r.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(5001, 5300)] + [(7, 7)]
    got = {x.node: x.component for x in components(spark.createDataFrame([*links, (None, 1), (2, None)], "a long, b long")).collect()}
    want = joined({n for x in links for n in x}, links)
    assert all(got.get(n, n) == c for n, c in want.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def sets_of(docs, width):
    out = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    return out


def brute(docs, width, percent):
    s = sets_of(docs, width)
    links = [(i, j) for i in range(len(s)) for j in range(i + 1, len(s)) if s[i] and s[j] and docs[i][0] is not None and docs[j][0] is not None and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j])]
    return s, joined(range(len(docs)), links)


def near_texts():
    docs = [(d, prose(d, 40 + d)) for d in range(60)]
    for d in range(60, 160):
        w = prose(d % 20, 120).split()
        for k in range(d % 9):
            w[(d * 31 + k * 17) % len(w)] = f"new{d}x{k}"
        docs.append((d, " ".join(w)))
    crowd = prose(999, 100).split()
    for d in range(200, 420):  # a crowd around one text, of which some link and many do not
        w = list(crowd)
        for k in range(d % 14):
            w[(d * 13 + k * 7) % len(w)] = f"other{d}x{k}"
        docs.append((d, " ".join(w)))
    return docs


@pytest.mark.parametrize(("width", "percent", "small"), [(3, 85, 64), (5, 80, 64), (3, 85, 4)])
def test_documents_equal_brute_force(spark, monkeypatch, width, percent, small):
    monkeypatch.setattr(N, "SMALL", small)
    monkeypatch.setattr(N, "TILE", 32)
    docs = near_texts()
    got = {r.doc_id: r for r in N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), width, percent).collect()}
    s, want = brute(docs, width, percent)
    for i, (d, _) in enumerate(docs):
        assert got[d].n_shingles == len(s[i]) and got[d].component_id == docs[want[i]][0] and got[d].kept == (got[d].component_id == d)


def test_overlaps_are_exact():
    r = np.random.default_rng(8)
    sets = [np.unique(r.integers(0, 500, r.integers(0, 200))).astype(np.uint64) for _ in range(20)]
    assert (N.overlaps(sets[:9], sets[9:]) == [[len(np.intersect1d(a, b)) for b in sets[9:]] for a in sets[:9]]).all()


def test_chances():
    for t in (0.8, 0.85):
        n = N.plan(t)
        found = t**5 + 5 * t**4 * (1 - t)
        assert (1 - found) ** n <= N.MISS < (1 - found) ** (n - 1)


def test_awkward_documents(spark, with_clashes, no_docs):
    df, rows = with_clashes
    got = N.near_duplicates(df, 3, 85).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert {by[i][0].component_id for i in (0, 1, 2, 13, 17)} == {0} and by[18][0].component_id == 18 == by[19][0].component_id
    for i in (5, 6, 7):
        assert by[i][0].n_shingles == 0 and by[i][0].component_id == i and by[i][0].kept
    assert all(r.component_id is None and not r.kept for r in by[None])
    assert by[8][0].n_shingles == 1 and by[9][0].n_shingles == 1 and by[8][0].component_id == 8 and by[9][0].component_id == 9
    assert N.near_duplicates(no_docs).count() == 0
    kept = N.keep_one(df, 5, 80)
    assert kept.columns == df.columns and {5, 6, 7, 0, 12} <= {r.doc_id for r in kept.collect()} and 1 not in {r.doc_id for r in kept.collect()}


def vectors():
    r = np.random.default_rng(11)
    rows, at = [], 0
    for label in range(3):
        centres = r.normal(size=(6, 16))
        for k in range(120):
            v = centres[k % 6] + r.normal(scale=0.22, size=16)
            rows.append((at, [float(np.float32(x)) for x in v * r.uniform(0.5, 20)], label))
            at += 1
    same = rows[5][1]
    rows += [(at + i, same, 0) for i in range(30)]
    return rows


def linked(rows, threshold):
    links = []
    for i, (_, x, p) in enumerate(rows):
        for j in range(i + 1, len(rows)):
            _, y, q = rows[j]
            if p == q and np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links.append((i, j))
    return links


@pytest.mark.parametrize(("tile", "sheet_bytes"), [(16, 1), (16, 4000), (1024, 4 << 20)])
def test_embeddings_equal_brute_force(spark, tile, sheet_bytes):
    rows = vectors()
    odd = [(9000, None, 1), (9001, [0.0] * 16, 1), (9002, [float("nan")] + [1.0] * 15, 1), (9003, rows[0][1], None), (None, rows[0][1], 0), (9004, [], 1), (9005, [None] + [1.0] * 15, 1), (9006, [float("inf")] * 16, 1), (9007, [1.0, 2.0], 1)]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows + odd], "vec_id long, embedding array<float>, label int, n_links string, tile string")
    got = {r.vec_id: r for r in E.near_vectors(df, 0.93, tile=tile, sheet_bytes=sheet_bytes).collect()}
    links = linked(rows, 0.93)
    want = joined(range(len(rows)), links)
    degree = np.bincount(np.array(links).ravel(), minlength=len(rows))
    assert len(links) > 400
    for i, (v, _, _) in enumerate(rows):
        assert (got[v].n_links, got[v].component_id, got[v].kept) == (degree[i], rows[want[i]][0], rows[want[i]][0] == v)
    for v in (9000, 9001, 9002, 9003, 9004, 9005, 9006, 9007):
        assert (got[v].n_links, got[v].component_id, got[v].kept) == (0, v, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert E.near_vectors(df.where("false")).count() == 0


def test_rows_of_one_doc_id_stand_for_their_own_texts(spark):
    a, b, c, d, e = (prose(700 + i, 150) for i in range(5))
    rows = [(1, a), (2, a), (2, b), (2, None), (3, c), (3, d), (0, d + " extra"), (7, c + " extra"), (8, e), (8, e), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in N.near_duplicates(df, 5, 80).collect())
    want = [(1, 1, True), (2, 1, False), (2, 2, True), (2, 2, True), (3, 3, True), (3, 0, False), (0, 0, True), (7, 3, False), (8, 8, True), (8, 8, True), (None, None, False)]
    assert got == sorted((str(i), str(k), kept) for i, k, kept in want)
    kept = N.keep_one(df, 5, 80)
    assert kept.columns == df.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in df.collect() if tuple(r) not in {(2, a), (3, d), (7, c + " extra")})
