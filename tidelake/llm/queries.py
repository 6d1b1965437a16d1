"""The operators' queries over the whole tables, with their production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embed_dedup, langid, licenses, lm_score, near_dedup, packing, quality, sharding, warc
from .common import fold


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontaminate_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_score_log_frequency_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = lm_score.score(docs, docs.where(fold("doc_id", 7) != 2))
    return found.withColumn("held_out", F.coalesce(fold("doc_id", 7) == 2, F.lit(False)))


def op3_pack_nnls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path(), end=2, window=4096)


def op4_quality_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.classify(docs, model).select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_embedding_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(read(spark, sf_dir, "embeddings"), threshold=0.93)


def op6_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op7_language_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(langid.training_rows(docs))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_shard_kd_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.kd_shards(read(spark, sf_dir, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "group_cut")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate_fm_index, op2_score_log_frequency_bloom, op3_pack_nnls, op4_quality_positive_unlabelled, op5_embedding_tiles,
        op6_license_sentences, op7_language_hierarchy, op8_warc_index, op9_shard_kd_tree, op10_near_duplicates,
    )
}

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_KNOWN = ", ".join(f"('{k}', '{v}')" for k, v in licenses.KNOWN.items())
_LICENCES = ", ".join(f"('{k}', '{v}')" for k, v in licenses.LICENCE_OF.items())
_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NORMAL = "replace(trim(regexp_replace({}, '[^a-z0-9]+', ' ', 'g')), 'licence', 'license')"

ORACLES: dict[str, str] = {
    "op5_embedding_tiles": """
        WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.label = y.label AND x.vec_id <> y.vec_id
                  WHERE list_dot_product(x.v, y.v) / (sqrt(list_dot_product(x.v, x.v)) * sqrt(list_dot_product(y.v, y.v))) >= 0.93),
        reach AS (SELECT vec_id AS node, vec_id AS other FROM e UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
        least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
        SELECT vec_id, CAST((SELECT count(*) FROM links WHERE links.a = e.vec_id) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
        FROM e JOIN least ON node = vec_id
    """,
    "op6_license_sentences": f"""
        WITH known(s2, id) AS (VALUES {_KNOWN}), rules(m, name) AS (VALUES {_LICENCES}),
        sentences AS (SELECT doc_id, i, l[i] AS s, {_NORMAL.format(_LOWERED.format("l[i]"))} AS n FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM
                  (SELECT doc_id, regexp_split_to_array(regexp_replace({licenses.kept_together_sql("coalesce(text, '')")}, '([.!?:])[ \\t\\n\\v\\f\\r]+', '\\1\n\n', 'g'), '\\n[ \\t\\r]*\\n') AS l FROM documents))),
        cued AS (SELECT doc_id, i, s, id FROM sentences LEFT JOIN known ON n = known.s2 WHERE regexp_matches(s, '(?i){licenses.CUE}')),
        pieces AS (SELECT doc_id, i, 0 AS j, id FROM cued WHERE id IS NOT NULL UNION ALL
                   SELECT doc_id, i, j, coalesce(known.id, '?') AS id FROM
                   (SELECT doc_id, i, j, p[j] AS line FROM (SELECT doc_id, i, p, unnest(range(1, len(p) + 1)) AS j FROM (SELECT doc_id, i, string_split(s, '\n') AS p FROM cued WHERE id IS NULL))) x
                   LEFT JOIN known ON {_NORMAL.format(_LOWERED.format("line"))} = known.s2 WHERE regexp_matches(line, '(?i){licenses.CUE}')),
        ids AS (SELECT doc_id, count(*) FILTER (id <> '?') AS n_known, string_agg('<' || id || '>', '' ORDER BY i, j) AS q FROM pieces GROUP BY doc_id),
        found AS (SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
                  FROM (SELECT doc_id, unnest(regexp_extract_all(q, '{licenses.PATTERN}')) AS m FROM ids) x JOIN rules ON x.m = rules.m GROUP BY doc_id)
        SELECT doc_id, CAST(coalesce(n_known, 0) AS BIGINT) AS n_known, coalesce(q, '') AS sentence_ids, coalesce(licenses, '') AS licenses
        FROM documents LEFT JOIN ids USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
    "op1_decontaminate_fm_index": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        windows AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
                    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM windows),
        grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
                  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
        hits AS (SELECT doc_id, item_id, i, grams.n AS n FROM grams JOIN windows ON grams.g = windows.g AND grams.n = windows.n),
        marks AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
        found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS s FROM hits GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN marks USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
    "op8_warc_index": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
        q AS (SELECT page_id, n, h, max(page_id) OVER (PARTITION BY h, n) AS last FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST(((CAST('0x' || substr(h, CAST(10 * (i // 8) + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31) AS BIGINT) + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < last THEN last END AS refers_to
        FROM q
    """,
    "op10_near_duplicates": f"""
        WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWERED.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
        half AS (SELECT a, b FROM both_ JOIN n m ON m.doc_id = a JOIN n o ON o.doc_id = b WHERE 100 * k >= 85 * (m.n + o.n - k)),
        links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
        reach AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
        least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
        SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM d JOIN least ON node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
    """,
}
