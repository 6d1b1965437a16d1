import random
import zlib

import pytest

#: Columns whose names the operators use for what they return, or inside.
CLASHING = ["score", "kept", "n", "digest", "keys", "spans", "items", "n_hit", "n_words", "slot", "shard", "lang_pred", "predicted", "size", "rank", "tail", "x", "own", "key", "links", "tile"]


def fold(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    pool = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in "rstnlmpk"][:vocabulary]
    return " ".join(r.choice(pool) for _ in range(words))


@pytest.fixture(scope="session")
def with_clashes(spark):
    """Documents with every awkward case, and columns of clashing names."""
    from pyspark.sql import functions as F

    base = prose(1, 120)
    texts = [base, base, base.upper(), base + " extra", prose(2, 300), None, "", "  \n\t ", "one", "one two", "§ … — !!!", "日本語 テキスト です", prose(3, 60_000), base.replace(" ", "\n"), prose(4, 50) + "\x00 end", "a" * 50_000, prose(2, 299), base, prose(5, 20), prose(5, 20)]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(None, base, "en", None, 1), (None, None, None, None, None), (4, prose(2, 300), "en", "s0", 1), (4, prose(9, 40), "en", "s0", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASHING:
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3).cache(), rows


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
