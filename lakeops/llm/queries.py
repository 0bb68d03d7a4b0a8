"""The llm operators as named queries over whole tables, with the DuckDB SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import ann, bpe, html_text, license_scan, lm_score, near_dup, packing, quality, simhash, suffix_dedup, token_align, va_clusters, warc
from lakeops.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=True)
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept_text").alias("text"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_align.align(table(spark, sf_dir, "documents"), a, b)


def op12_va_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_clusters.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dimension=64, scale=1024, seed="3:")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_fingerprints(table(spark, sf_dir, "documents"), words=3, distance=3)


def clusters_sql(k: int = 8, rounds: int = 10, dimension: int = 64, scale: int = 1024, seed: str = "3:") -> str:
    """The clusters of op12 by all distances, one pair of tables a round."""
    apart = "list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        f"""p AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) = {dimension} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimension})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, vec_id, v) - 1 AS c, v
            FROM (SELECT sha256('{seed}' || vec_id) AS h, vec_id, v FROM p ORDER BY h, vec_id, v LIMIT {k}))""",
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} AS MATERIALIZED (SELECT r, vec_id, v, c, d FROM (
                SELECT p.r, p.vec_id, p.v, c.c, {apart}::BIGINT AS d FROM p, c{n} AS c) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
        )
        if n < rounds:
            steps.append(
                f"""c{n + 1} AS MATERIALIZED (SELECT c{n}.c, coalesce(m.v, c{n}.v) AS v FROM c{n} LEFT JOIN (
                    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
                        SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range({dimension})) AS i FROM a{n}) GROUP BY c, i)
                    GROUP BY c) AS m ON m.c = c{n}.c)"""
            )
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
            (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{rounds} AS a JOIN c{rounds} AS c ON c.c = a.c"""


def records_sql() -> str:
    """The records of op8: of equal payloads the largest page is the response; the digest's letters are read off four groups of 40 bits."""
    letters = " || ".join(
        f"substr('{warc.BASE32}', (((('0x' || substr(h, {1 + 10 * g}, 10))::BIGINT >> {35 - 5 * i}) & 31) + 1)::INTEGER, 1)" for g in range(4) for i in range(8)
    )
    return f"""SELECT page_id, octet_length(encode(t)) AS payload_bytes, {letters} AS payload_digest,
            CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last_id THEN last_id END AS refers_to
        FROM (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last_id FROM pages)"""


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_near_dup, op2_suffix_dedup, op3_html_text, op4_nearest, op5_lm_score, op6_bpe, op7_license_scan, op8_warc, op9_packing, op10_quality_rules, op11_token_align, op12_va_clusters, op13_simhash)}


def oracle_sql() -> dict[str, str]:
    return {"op8_warc": records_sql(), "op12_va_clusters": clusters_sql()}
