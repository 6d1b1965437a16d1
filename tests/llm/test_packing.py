import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelake.llm import packing as P
from tidelake.llm.queries import tokenizer_path

from .conftest import prose


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcABCéÉßσΣςŀı019'.,!?-_ \t\n\r\x0b\x1c\x85 　…日😀<|>strevmld½²́"), max_size=40) | st.text(max_size=30))
def test_ids_are_the_tokenizers(text):
    from tokenizers import Tokenizer

    global _TK
    _TK = globals().get("_TK") or Tokenizer.from_file(tokenizer_path())
    text = text.encode("utf-8", "replace").decode()
    assert P.encode(text.encode(), tokenizer_path(), 2) == np.array([*_TK.encode(text, add_special_tokens=False).ids, 2], "<u4").tobytes()


def test_special_spellings(tokenizer):
    for text in ("<|endoftext|>a", "x<|startoftext|> Y", "<|ENDOFTEXT|>", "a <| b"):
        assert P.encode(text.encode(), tokenizer_path(), 2) == np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4").tobytes()


def test_other_tokenizers_encode_whole_texts(tmp_path, tokenizer):
    import json
    from tokenizers import Tokenizer

    assert P.part_ids(tokenizer_path()).cuts
    spec = json.load(open(tokenizer_path(), encoding="utf-8"))
    spec["normalizer"]["normalizers"].append({"type": "Replace", "pattern": {"String": "a b"}, "content": "c"})
    other = str(tmp_path / "other.json")
    json.dump(spec, open(other, "w", encoding="utf-8"))
    own = Tokenizer.from_file(other)
    assert not P.part_ids(other).cuts
    for text in ("a b", "x a b y", "", "plain words"):
        assert P.encode(text.encode(), other, 2) == np.array([*own.encode(text, add_special_tokens=False).ids, 2], "<u4").tobytes()


def used_by(layouts, size):
    out = np.zeros(size, np.int64)
    for x in layouts:
        np.add.at(out, list(x.lengths), x.times)
    return out


@pytest.mark.parametrize("window", [4, 37, 256, 4096])
def test_plan_uses_every_piece_once(window):
    r = np.random.default_rng(3)
    for n in (0, 1, 50, 3000, 200_000):
        hist = np.bincount(r.integers(1, window + 1, n), minlength=window + 1).astype(float)
        layouts = P.plan(hist, window)
        assert all(sum(x.lengths) <= window and x.times > 0 for x in layouts) and (used_by(layouts, window + 1) == hist).all()
        if n >= 3000:
            assert (hist * np.arange(window + 1)).sum() / (window * sum(x.times for x in layouts)) > 0.98  # lengths are uniform here, long ones as common as short ones


def test_most_pieces_are_placed_by_the_solution():
    r = np.random.default_rng(5)
    for n in (2_000, 20_000, 2_000_000):
        hist = np.bincount(np.clip(r.lognormal(6, 1.1, n).astype(int), 1, 4096), minlength=4097).astype(float)
        layouts = P.plan(hist, 4096)
        assert (used_by(layouts, 4097) == hist).all()
        part = [x for x in layouts if x.step != "full"]
        assert used_by([x for x in part if x.step == "solved"], 4097).sum() > 0.8 * used_by(part, 4097).sum()
        size, least = 4096 * sum(x.times for x in layouts), (hist * np.arange(4097)).sum()
        assert size - least <= 0.01 * size + 4096
        assert len(layouts) < 30_000  # follows the lengths, not the pieces


def test_least_squares_is_non_negative_and_close():
    hist = np.zeros(17)
    hist[[16, 12, 4, 8]] = [5, 7, 7, 10]
    columns = P.combinations(hist > 0, 1, 16)
    x = P.nonnegative_least_squares(columns, hist)
    fitted = np.zeros(17)
    for c, v in zip(columns, x):
        assert v >= 0 and sum(k * n for k, n in zip(c.bins, c.times)) == 16
        np.add.at(fitted, list(c.bins), v * np.array(c.times))
    assert np.abs(fitted - hist).max() < 1e-6


def test_least_squares_meets_its_conditions():
    r = np.random.default_rng(9)
    for _ in range(20):
        have = r.random(33) < 0.4
        have[0] = False
        wanted = np.where(have, r.integers(1, 200, 33), 0).astype(float)
        columns = P.combinations(have, 1, 32)
        x = P.nonnegative_least_squares(columns, wanted)
        a = np.zeros((33, len(columns)))
        for j, c in enumerate(columns):
            np.add.at(a[:, j], list(c.bins), c.times)
        gradient = a.T @ (wanted - a @ x)
        assert (x >= 0).all() and (gradient < 1e-3 * wanted.sum()).all() and (np.abs(gradient[x > 0]) < 1e-3 * wanted.sum()).all()


def check(rows, docs, window, tokenizer):
    whole = {}
    for d, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        whole.setdefault(d, []).append(ids)
    by_seq = {}
    for r in rows:
        assert any(len(w) == r.doc_tokens and zlib.crc32(w[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for w in whole[r.doc_id])
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(len(w) for v in whole.values() for w in v)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window


def test_round_trip(spark, tokenizer):
    docs = [(d, prose(d, (d * 37) % 90)) for d in range(150)] + [(500, None), (501, ""), (7, prose(7, 10))]
    got = P.pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), tokenizer_path(), 2, 128).collect()
    check(got, docs, 128, tokenizer)


def test_awkward_documents(spark, with_clashes, no_docs, tokenizer):
    df, rows = with_clashes
    check(P.pack(df, tokenizer_path()).collect(), [r[:2] for r in rows], 4096, tokenizer)
    assert P.pack(no_docs, tokenizer_path()).count() == 0


def test_most_documents_are_placed_by_the_solution(spark):
    from tidelake.llm import queries

    rows = queries.op3_pack_nnls(spark, "/root/testdata/sf0.1").groupBy("placed_by").count().collect()
    n = {r.placed_by: r["count"] for r in rows}
    assert n["solved"] > 0.8 * (n["solved"] + n.get("greedy", 0))
