"""Queries of this folder, under the names of their contracts, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickflow.llm.exact_dedup import exact_groups
from tickflow.llm.langid import identify
from tickflow.llm.licenses import notices, scan, scan_sql
from tickflow.llm.main_text import main_text
from tickflow.llm.mixing import mixture
from tickflow.llm.ngram_join import similar_groups
from tickflow.llm.packing import pack_documents
from tickflow.llm.prefix_trie import prefix_trie, trie_sql
from tickflow.llm.quality import score
from tickflow.llm.secret_scan import secret_spans
from tickflow.llm.spelling import spelling_groups, spelling_sql
from tickflow.llm.topk import top_k
from tickflow.llm.urls import judge, judge_sql


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(_table(spark, sf_dir, "documents"), width=4, percent=85)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "pages"))


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_table(spark, sf_dir, "documents"))


def op3_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices(_table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-way from the sources' own entropy to equal weights, in blocks of 16,384 tokens, eight sequences."""
    return mixture(_table(spark, sf_dir, "documents"), evenness=0.5, block_tokens=1 << 14)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_topk": op1_exact_topk,
    "op2_html_extraction": op2_html_extraction,
    "op3_license_scan": op3_license_scan,
    "op3_license_notices": op3_license_notices,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_source_mixing": op5_source_mixing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_language_id": op8_language_id,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_secret_scan": op12_secret_scan,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op1_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
                   FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 20 = 0),
             r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op6_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
                   FROM documents),
             g AS (SELECT *, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
    """,
    "op3_license_scan": scan_sql(),
    "op7_url_filter": judge_sql(),
    "op11_prefix_trie": trie_sql(),
    "op13_spelling_variants": spelling_sql(),
}
