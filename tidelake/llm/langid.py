"""Language identification in two steps: the family first, then support vector machines between the family's languages.

The family comes from a softmax classifier over all families. Within it, one linear support vector machine per pair of languages
votes. Both see hashed byte n-grams of the whole text and nothing else. They are fitted on the driver on at most PER_LANGUAGE
texts of a language, drawn by hash.

Both only choose among the languages that were learned. Whether a text is in one of them at all is another question, asked if
wanted: how much less likely its n-grams are under the profile of the nearest language than that language's own texts are, and
how many of its characters are letters. Both cuts are placed on the training texts, each left out of its profile.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..deploy import ship
from .common import binary_list, fold
from .features import drawn, matrix, ngrams, vectors

PER_LANGUAGE, BINS, UNKNOWN = 400, 4096, "und"
#: A profile is mixed with so much of the even distribution. A text is foreign if its mean log-likelihood lies by so much beyond the
#: farthest hundredth of the training texts, or if its share of letters is under such a part of that of their lowest hundredth.
EVEN, BEYOND, LETTERS = 0.05, 1.2, 1 / 3

# Families of languages by ISO 639-1 code. A language that is not here is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
}

# Letters and bytes of non-ASCII characters stay, A-Z in lower case; all else is a space.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_SPACES = re.compile(rb" {2,}")
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def family(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), f"only {lang}")


def has_letter(text: bytes | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace")))


def vector(text: bytes) -> np.ndarray:
    return ngrams(_SPACES.sub(b" ", text.translate(_TABLE)), None, BINS)


_NO_LETTER = bytes(b for b in range(128) if not (0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))


def letter_share(text: bytes | None) -> float:
    """The share of letters among the characters of a text other than ASCII white space."""
    kept, n = (text or b"").translate(None, _NO_LETTER).decode("utf-8", "replace"), len((text or b"").translate(None, b" \t\n\x0b\f\r").decode("utf-8", "replace"))
    return (len(kept) - sum(kept.count(c) for c in set(kept) if not c.isalpha())) / n if n else 0.0


def _vector_and_share(text: bytes) -> np.ndarray:
    return np.append(vector(text), np.float32(letter_share(text)))


def _profile(shares: np.ndarray) -> np.ndarray:
    return np.log((1 - EVEN) * shares + EVEN / BINS)


def softmax_weights(x: np.ndarray, y: np.ndarray, classes: int, steps: int = 300, rate: float = 20.0, decay: float = 1e-5) -> np.ndarray:
    """Weights, with a bias row, of multinomial logistic regression by accelerated gradient descent."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = v = np.zeros((x.shape[1], classes), np.float32)
    weight = (1 / np.bincount(y, minlength=classes).clip(1))[y] / classes  # families count alike
    for k in range(steps):
        z = x @ v
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        new = v - rate * (x.T @ (p * weight[:, None]).astype(np.float32) + decay * v)
        v, w = new + k / (k + 3) * (new - w), new
    return w


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 30) -> np.ndarray:
    """Weights, the last a bias, of a linear support vector machine with squared hinge loss, by dual coordinate descent; y is 1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    diagonal = (x * x).sum(axis=1) + 0.5 / c
    r = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in r.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + alpha[i] * 0.5 / c
            new = max(0.0, alpha[i] - g / diagonal[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None
    members: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)
    #: A column a language, the mean log-likelihood of its texts, the largest distance and the least share of letters that count as learned.
    profiles: np.ndarray | None = None
    usual: np.ndarray | None = None
    most_far: float = 0.0
    least_letters: float = 0.0

    def foreign(self, x: np.ndarray, text: bytes) -> bool:
        """Whether a text with vector x is in no learned language."""
        return float((self.usual - (x * x) @ self.profiles).min()) > self.most_far or letter_share(text) < self.least_letters

    def predict(self, text: bytes | None, reject: bool = False) -> tuple[str, float]:
        if not self.families or not has_letter(text):
            return UNKNOWN, 0.0
        x = vector(text)
        if reject and self.foreign(x, text):
            return UNKNOWN, 0.0
        x = np.append(x, np.float32(1))
        z = x @ self.weights
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        langs = self.members[self.families[best]]
        if len(langs) == 1:
            return langs[0], float(min(1.0, p[best]))
        votes, belief = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
        for (a, b), w in self.pairs.items():
            if a in votes and b in votes:
                q = 1 / (1 + np.exp(np.clip(-3.0 * (x @ w), -50, 50)))
                votes[a if q >= 0.5 else b] += 1
                belief[a] += q
                belief[b] += 1 - q
        lang = max(langs, key=lambda k: (votes[k], belief[k]))
        return lang, float(min(1.0, p[best] * belief[lang] / (len(langs) - 1)))


def learned_range(x: dict[str, np.ndarray], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """profiles, usual, most_far and least_letters of a Model, from the vectors of each language and the letter shares of all texts."""
    counts = {k: (v * v).astype(np.float64) for k, v in x.items()}
    profiles = np.stack([_profile(c.mean(axis=0)) for c in counts.values()], axis=1)
    usual = np.array([(c @ profiles[:, i]).mean() for i, c in enumerate(counts.values())])
    far = []
    for i, c in enumerate(counts.values()):
        d = usual - c @ profiles
        total = c.sum(axis=0)
        # A text's own language is judged without the text.
        d[:, i] = [usual[i] - row @ _profile((total - row) / max(len(c) - 1, 1)) for row in c]
        far.append(d.min(axis=1))
    return profiles.astype(np.float32), usual.astype(np.float32), float(np.quantile(np.concatenate(far), 0.99)) + BEYOND, float(np.quantile(letters, 0.01)) * LETTERS


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from the rows of `docs` (doc_id, text, lang) with a lang and a text of letters; at most `per_language` of each lang.

    Rows that repeat a doc_id and text count once. The driver holds the drawn texts' vectors and, at the end, weights for each family and
    each pair of languages of a family. An empty table, or one without a lang, gives a model that knows no language.
    """
    known = docs.where("lang is not null and text is not null and text rlike '\\\\p{L}'")
    texts = drawn(known.select("doc_id", "lang", F.col("text").cast("string").alias("text")), "lang", per_language, 11)
    by_lang: dict[str, list] = defaultdict(list)
    for r in sorted(vectors(texts, _vector_and_share).collect(), key=lambda r: (r["order"], r["x"])):
        if len(by_lang[r["lang"]]) < per_language:
            by_lang[r["lang"]].append(r)
    langs = sorted(k for k, v in by_lang.items() if v)
    if not langs:
        return Model()
    both = {k: matrix(by_lang[k], BINS + 1) for k in langs}
    x = {k: v[:, :BINS] for k, v in both.items()}
    members: dict[str, list[str]] = defaultdict(list)
    for k in langs:
        members[family(k)].append(k)
    families = sorted(members)
    y = np.concatenate([np.full(len(x[k]), families.index(family(k))) for k in langs])
    weights = softmax_weights(np.concatenate([x[k] for k in langs]), y, len(families)) if len(families) > 1 else np.zeros((BINS + 1, 1), np.float32)
    pairs = {}
    for group in members.values():
        for a, b in combinations(group, 2):
            pairs[a, b] = svm(np.concatenate([x[a], x[b]]), np.concatenate([np.ones(len(x[a])), -np.ones(len(x[b]))])).astype(np.float32)
    return Model(families, weights, dict(members), pairs, *learned_range(x, np.concatenate([v[:, BINS] for v in both.values()])))


def identify(docs: DataFrame, model: Model, reject: bool = False) -> DataFrame:
    """The columns of `docs`, and lang_pred and score in place of any such columns.

    lang_pred is a language that was learned, or `und`, with score 0, where the text is null or has no letter or nothing was learned.
    With `reject`, it is `und` also for a text that is far from all learned languages or hardly has letters; without, the nearest is given.
    Repeated rows stay, and an empty table gives an empty result; whole texts of any length are read.
    """
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    base = docs.drop("lang_pred", "score").withColumn("text", F.col("text").cast("string"))
    schema = ", ".join([f"`{c}` {t}" for c, t in base.dtypes] + ["lang_pred string", "score double"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [held.value.predict(t, reject) for t in binary_list(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([k for k, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    return base.mapInArrow(run, schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: those of the folds other than 2 of 4. Rows without doc_id are not."""
    return docs.where(fold("doc_id", 4) != 2).select("doc_id", "text", "lang")
