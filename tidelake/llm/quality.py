"""A quality classifier from positive and unlabelled texts.

Trusted positives are labelled texts of quality 1; every text of the corpus is unlabelled. The classifier is linear and its loss
(1 - z)^2 / 4, so that the risk of the unlabelled texts hangs on their first and second moments alone: one pass sums these over the whole
corpus, however large, and the driver solves for the weights. The unbiased risk is prior * E_p[l(f)] + (E_u[l(-f)] - prior * E_p[l(-f)]); the
second term estimates a risk and must not be negative. The weights are those of the least ridge for which it is not.

The class prior is estimated from the two sides alone: for any region, the share of the unlabelled texts in it over that of the positives
bounds the prior from above, and the least such bound over the regions above a score of a first classifier is taken. The prior and the cut
are placed by scores of positives that were left out of the weights, fold by fold, among the scores of all texts.

The classifier sees the shape of whole texts and nothing else: hashed n-grams of kinds of characters, so that languages look alike, and
how much is repeated. Only the trusted positives are bounded, to POSITIVES labelled rows drawn by hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..deploy import ship
from .common import Saved, binary_list, fold, small_batches
from .features import ngrams

POSITIVES, BINS = 2500, 256
EXTRA = 4
WIDTH = BINS + EXTRA
FOLDS = 5
#: Ridges that are tried, from the largest.
RIDGES = 10.0 ** np.arange(0, -6.25, -0.25)
#: The ridge of the classifier that finds the prior.
FIRST_RIDGE = 1e-3
#: Scores double their odds for each sixth of an e-fold or so: what the weights give, mostly between -1 and 1, becomes 0 to 1.
STEEP = 6.0
#: Partial sums of moments that reach the driver at most.
SUMS = 16

# Small letters and non-ASCII bytes look alike, and so do capitals, and digits.
_SHAPE = bytes(0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x41 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else b for b in range(256))


def vector(text: bytes | None) -> np.ndarray:
    """n-grams of the text's shape, and the shares of words that repeat the one or two before or that occurred already, and of lines that did."""
    out = np.zeros(WIDTH, np.float32)
    out[:BINS] = ngrams(text, _SHAPE, BINS)
    words = text.split() if text else []
    if len(words) > 2:
        lines = text.splitlines()
        out[BINS:] = (sum(map(eq, words, words[1:])) / len(words), sum(map(eq, words, words[2:])) / len(words), 1 - len(set(words)) / len(words) ** 0.9 if len(set(words)) < len(words) ** 0.9 else 0, 1 - len(set(lines)) / len(lines))
    return out


@dataclass
class Model:
    weights: np.ndarray  # the last is a bias
    prior: float

    def score(self, text: bytes | None) -> float:
        z = STEEP * float(vector(text).astype(np.float64) @ self.weights[:-1] + self.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


@dataclass
class Moments:
    """Rows, and the mean of x and of x x^T over them; x ends with a one."""

    rows: int
    first: np.ndarray
    second: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        x = _with_one(x)
        return cls(len(x), x.mean(axis=0), x.T @ x / len(x))


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))]).astype(np.float64)


def negative_risk(w: np.ndarray, p: Moments, u: Moments, prior: float) -> float:
    """E_u[l(-f)] - prior * E_p[l(-f)]: what the texts that are not positive are estimated to cost."""
    cost = lambda m: (1 + 2 * m.first @ w + w @ m.second @ w) / 4
    return float(cost(u) - prior * cost(p))


def non_negative_risk(p: Moments, u: Moments, prior: float) -> np.ndarray:
    """Weights of least risk under the least ridge that keeps the negative term from falling below zero, where it only shows overfitting."""
    best = np.zeros(len(p.first))
    free = np.ones(len(best))
    free[-1] = 1e-9  # the bias
    for ridge in RIDGES:
        w = np.linalg.solve(u.second / 2 + np.diag(ridge * free), prior * p.first - u.first / 2)
        if negative_risk(w, p, u, prior) < 0:
            break
        best = w
    return best


def separating(p: Moments, u: Moments) -> np.ndarray:
    """Weights that tell positives from unlabelled texts, each side counting half: the classifier that finds the prior, and needs none."""
    free = np.ones(len(p.first))
    free[-1] = 1e-9
    return np.linalg.solve((p.second + u.second) / 2 + np.diag(FIRST_RIDGE * free), (p.first - u.first) / 2)


def folds(positive: np.ndarray) -> list[np.ndarray]:
    """Which positives each fold leaves out; no fold where there is none to fit then."""
    n = min(FOLDS, len(positive))
    return [np.arange(len(positive)) % n == k for k in range(n)] if n > 1 else []


def estimate_prior(below: np.ndarray) -> float:
    """From the share of all texts that score below each positive: the least ratio of shares, over regions that hold most positives."""
    if not len(below):
        return 0.5
    below = np.sort(below)
    cuts = np.quantile(below, np.linspace(0.01, 0.1, 19))
    return float(np.clip(np.min((1 - cuts) / (1 - np.searchsorted(below, cuts) / len(below))), 0.05, 0.98))


def cut_share(below: np.ndarray, prior: float) -> float:
    """The share of all texts that should score under one half: the least whose non-negative risk under zero-one loss is within one
    standard error, which the number of positives gives, of the least."""
    if not len(below):
        return 0.0
    below = np.sort(below)
    cuts = np.unique(below)
    lost = np.searchsorted(below, cuts) / len(below)
    risk = prior * lost + np.maximum(0, 1 - cuts - prior * (1 - lost))
    least = int(risk.argmin())
    error = prior * ((lost[least] * (1 - lost[least]) + 1 / len(below)) / len(below)) ** 0.5
    return float(cuts[risk <= risk[least] + error][0])


def _featured(docs: DataFrame, ids: DataFrame) -> Saved:
    """(id, mine, x) of every row: x the features of its text in half precision, mine whether its id is among the trusted."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = [vector(t).astype(np.float16).tobytes() for t in binary_list(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.binary())], names=["id", "mine", "x"])

    known = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids.select("id", F.lit(True).alias("mine"))), "id", "left")
    return Saved(known.select("id", F.coalesce("mine", F.lit(False)).alias("mine"), "text").mapInArrow(run, "id long, mine boolean, x binary"), "features")


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(-1, WIDTH).astype(np.float64)


def corpus_moments(features: DataFrame) -> Moments | None:
    """Over all rows. Tasks send sums, and a few tasks add these up, one after another."""

    def sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((WIDTH + 1, WIDTH + 1))
        for batch in it:
            x = _with_one(_rows(batch.column(0)))
            n += len(x)
            total += x.T @ x
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["n", "total"])

    def added(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((WIDTH + 1) ** 2)
        for batch in it:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n += k
                total += np.frombuffer(t)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["n", "total"])

    each = Saved(features.select("x").mapInArrow(sums, "n long, total binary"), "moments")
    with small_batches(features.sparkSession, 16):
        rows = each.df.repartition(SUMS).mapInArrow(added, "n long, total binary").collect()  # SUMS rows of half a megabyte
    each.drop()
    n = sum(r["n"] for r in rows)
    if not n:
        return None
    second = sum(np.frombuffer(r["total"]) for r in rows).reshape(WIDTH + 1, WIDTH + 1) / n
    return Moments(n, second[-1].copy(), second)


def shares_below(features: DataFrame, weights: list[np.ndarray], marks: list[np.ndarray]) -> list[np.ndarray]:
    """For each vector of weights, the share of all rows that score below each of its marks, which are sorted."""
    w = np.column_stack(weights)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(m) + 1, np.int64) for m in marks]
        for batch in it:
            z = _with_one(_rows(batch.column(0))) @ w
            for k, m in enumerate(marks):
                counts[k] += np.bincount(np.searchsorted(m, z[:, k], "right"), minlength=len(m) + 1)
        for k, c in enumerate(counts):
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k), pa.int32()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())], names=["k", "at", "n"])

    found = features.select("x").mapInArrow(run, "k int, at int, n long").groupBy("k", "at").agg(F.sum("n").alias("n")).collect()  # a row for each mark
    out = []
    for k, m in enumerate(marks):
        c = np.zeros(len(m) + 1, np.int64)
        for r in found:
            if r["k"] == k:
                c[r["at"]] = r["n"]
        out.append(np.cumsum(c)[:-1] / max(1, c.sum()))
    return out


def _left_out(features: DataFrame, p: np.ndarray, fitted: Callable[[Moments], np.ndarray]) -> np.ndarray:
    """The share of all texts that score below each positive, by weights that were fitted without it."""
    out = folds(p)
    if not out:
        return np.zeros(0)
    weights = [fitted(Moments.of(p[~f])) for f in out]
    # Positives are among the texts: a hair less, so that none counts as below itself for how a sum was rounded.
    return np.concatenate(shares_below(features, weights, [np.sort(_with_one(p[f]) @ w) - 1e-9 for f, w in zip(out, weights)]))


def score_at(features: DataFrame, w: np.ndarray, share: float) -> float:
    """A score with the share of all rows below it, by halving the range until it is a thousandth of a score's steepness wide."""
    low, high = -64.0, 64.0
    while high - low > 1e-3 / STEEP:
        marks = np.linspace(low, high, 129)
        below = shares_below(features, [w], [marks])[0]
        at = int(np.searchsorted(below, share, "left"))
        low, high = marks[max(0, at - 1)], marks[min(128, at)]
        if at in (0, 129):
            break
    return float(low)


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES) -> Model:
    """Learn from the rows of `docs` (doc_id, text) that `labels` (doc_id, quality) marks 1, outside fold 1 of 3, and from all rows.

    At most `positives` trusted documents are taken, by hash; rows that repeat a trusted doc_id and text count once. Null texts are texts
    without features; rows with a null doc_id are unlabelled. Without a trusted positive, or of an empty table, the model scores 0.5.
    """
    spark = docs.sparkSession
    ship(spark)
    trusted = labels.where((F.col("quality") == 1) & (fold("doc_id", 3) != 1)).select(F.col("doc_id").cast("long").alias("id")).distinct()
    trusted = Saved(trusted.orderBy(F.xxhash64("id"), "id").limit(positives), "trusted")  # at most `positives` ids
    features = _featured(docs, trusted.df)
    trusted.drop()
    mine = features.df.where("mine").select("id", "x").distinct().orderBy(F.xxhash64("id", "x"), "id", "x").limit(positives).collect()
    u = corpus_moments(features.df) if mine else None
    if u is None:
        features.drop()
        return Model(np.zeros(WIDTH + 1), 0.5)
    p = np.stack([np.frombuffer(r["x"], np.float16) for r in mine]).astype(np.float64)
    prior = estimate_prior(_left_out(features.df, p, lambda m: separating(m, u)))
    risk_of = lambda m: non_negative_risk(m, u, prior)
    w = risk_of(Moments.of(p))
    share = cut_share(_left_out(features.df, p, risk_of), prior)
    w[-1] -= score_at(features.df, w, share)
    features.drop()
    return Model(w, prior)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of `docs`, and score and predicted in place of any such columns.

    score is between 0 and 1, higher for texts that are likelier of quality 1; predicted is 1 from 0.5 on. Null and empty texts get the
    score of a text without features. Without a trusted positive every score is 0.5. Whole texts are read; repeated rows, and rows with a
    null doc_id, stay and are scored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    base = docs.drop("score", "predicted").withColumn("text", F.col("text").cast("string"))
    schema = ", ".join([f"`{c}` {t}" for c, t in base.dtypes] + ["score double", "predicted int"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            scores = [held.value.score(t) for t in binary_list(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], names=[*batch.schema.names, "score", "predicted"])

    return base.mapInArrow(run, schema)
