"""From raw documents to packed training sequences: five operators, each over all that the one before kept.

Every stage but the last returns the columns of `documents`. Stages between are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.deploy import ship
from tidelake.llm import decontaminate, langid, near_dedup, packing, quality
from tidelake.llm.common import DOCUMENT_COLUMNS, Saved
from tidelake.llm.queries import read, tokenizer_path

#: A language below this score counts as unknown. With two families of two languages no score is that low; what is foreign to all of
#: them is found by its distance.
LEAST_LANGUAGE_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, with hardly any, or far from every learned language, go; lang becomes what was found.

    So null, empty and blank texts go. Rows with a null doc_id are judged by their text, and repeated rows each. With no lang to learn from,
    nothing is known and every document goes.
    """
    ship(spark)
    model = langid.fit(langid.training_rows(docs))
    found = langid.identify(docs.select(*DOCUMENT_COLUMNS), model, reject=True)
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*DOCUMENT_COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier of low quality go.

    Null and empty texts are judged as texts without features, rows with a null doc_id by their text, and repeated rows each. Without a
    label to learn from all stay.
    """
    ship(spark)
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.classify(docs.select(*DOCUMENT_COLUMNS), model).where("predicted = 1").select(*DOCUMENT_COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that shingles of five words link at a similarity of 0.8, the one with the smallest doc_id stays.

    Rows without words and rows with a null doc_id stay. Rows that repeat a doc_id and text are one document and stay or go together; rows of
    one doc_id with different texts stay or go each for its own text.
    """
    return near_dedup.keep_one(docs.select(*DOCUMENT_COLUMNS), width=5, percent=80)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut from the texts; a document of which nothing is left goes.

    Texts without a passage, null and empty ones among them, keep every byte. n_chars follows a text that was cut. Repeated rows, and rows
    with a null doc_id, are each cut for themselves.
    """
    return decontaminate.decontaminate(docs.select(*DOCUMENT_COLUMNS), read(spark, sf_dir, "benchmark"), window=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in sequences of 4096 ids. Null and empty texts are their end id; repeated rows are packed each, and null
    doc_ids stay null. An empty table gives an empty result, here and in all stages; columns other than those of documents are dropped.
    """
    return packing.pack(docs, tokenizer_path(), end=2, window=4096)


STAGES = [("language", identify_language), ("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("decontamination", cut_benchmark), ("packing", pack)]

#: SQL cannot express the two learned stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = Saved(docs, name).df
    return docs
