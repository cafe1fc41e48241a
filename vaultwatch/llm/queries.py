"""The operators applied to whole tables, and the same results in SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwatch.llm import bpe, decontaminate, embedding_dedup, exact_dedup, language, lexical_search, minhash_dedup, quality, sharding, substring_dedup, token_file, warc, whitening
from vaultwatch.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 16
RANKS = "byte_bpe_multi_50k.tiktoken"
WORDS = "word_bpe_49k.json"
END_ID = 1


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), SHARDS)


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link(table(spark, sf_dir, "embeddings"), limit=0.93)


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.link(table(spark, sf_dir, "documents"), width=2)


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", "content", "metadata", "score", "kept")


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold == 0, F.lit(False)))
    model = language.learn(docs.filter(fold != 0))
    return language.predict(docs, model, keep=("doc_id", "held_out"))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.roundtrip(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), END_ID)


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removed(table(spark, sf_dir, "documents"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        "op1_shards": _op1,
        "op2_decontaminate": _op2,
        "op3_pivots": _op3,
        "op4_minhash": _op4,
        "op5_warc": _op5,
        "op6_quality": _op6,
        "op7_byte_bpe": _op7,
        "op8_language": _op8,
        "op9_token_file": _op9,
        "op10_suffix_arrays": _op10,
        "op11_digest_index": _op11,
        "op12_whitening": _op12,
        "op13_norm_buckets": _op13,
    }


# All pairs of a label, and the smallest vec_id that links reach.
_OP3_SQL = """
    WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    g AS MATERIALIZED (SELECT * FROM e WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(v, lambda x: x <> 0)) > 0),
    links AS (SELECT a.r, b.r AS s FROM g a JOIN g b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
              WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= 0.93 END),
    reached AS (SELECT r, vec_id AS c FROM e UNION SELECT links.r, reached.c FROM links JOIN reached ON reached.r = links.s),
    component AS (SELECT r, min(c) AS c FROM reached GROUP BY r),
    degree AS (SELECT r, count(*) AS n FROM links GROUP BY r)
    SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id IS NOT DISTINCT FROM c AS kept
    FROM e JOIN component USING (r) LEFT JOIN degree USING (r)"""


_OP5_SQL = """
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    marked AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS largest FROM payloads)
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
           CASE WHEN strlen(html) >= 1000 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN strlen(html) >= 1000 AND page_id <> largest THEN largest END AS refers_to
    FROM marked"""


_OP11_SQL = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
           row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
    FROM d"""


def _terms_sql(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


_OP13_SQL = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms_sql('text')} AS terms FROM documents),
    s AS (SELECT CAST(count(*) AS BIGINT) AS all_docs, CAST(sum(len(terms)) AS BIGINT) AS all_terms FROM d WHERE len(terms) > 0),
    i AS (SELECT DISTINCT item_id, unnest({_terms_sql('text')}) AS term FROM benchmark),
    v AS (SELECT DISTINCT term FROM i),
    words AS (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM d),
    tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM words SEMI JOIN v USING (term) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
          FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
    p AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * all_docs) // all_terms)))) AS part
          FROM tf JOIN w USING (term), s),
    scored AS (SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM i JOIN p USING (term) GROUP BY ALL),
    ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                      doc_id, score FROM scored WHERE score > 0)
    SELECT * FROM ranked WHERE rank <= 50"""


def oracle_sql() -> dict[str, str]:
    return {"op3_pivots": _OP3_SQL, "op5_warc": _OP5_SQL, "op11_digest_index": _OP11_SQL, "op13_norm_buckets": _OP13_SQL}
