"""The registered queries of the subpackage: operator N over its whole table as ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.llm import (align, centroids, embedding_dedup, exact_dedup, langid, mixing, near_dedup, packing, quality, secret_scan, sharding,
                        token_files, tokens, topk_search)
from vigilo.llm.common import documents, embeddings


def op1_ftrl_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", langid.held_out(F.col("doc_id")))
    learned = docs.where("not held_out").select("text", "lang", "doc_id")
    model = langid.train(learned, draw=F.xxhash64("doc_id", "text"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op2_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    docs = documents(spark, sf_dir).select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    placed = sharding.assign_shards(docs, ["doc_id", "text_crc32", "size"], shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op3_crf_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secret_scan.scan(docs, secret_scan.train(docs, draw=F.xxhash64("doc_id", "text")))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (near_dedup.near_duplicates(documents(spark, sf_dir), width=4)
            .select("doc_id", "n_shingles", "component_id", "kept"))


def op5_elias_fano_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = token_files.write_tokens(documents(spark, sf_dir), tokens.tokenizer_path("byte_bpe_50k.json"))
    return token_files.read_tokens(folder, manifest)


def op6_p_stable_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(embeddings(spark, sf_dir))


def op7_exponential_key_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.plan_mix(documents(spark, sf_dir))
            .select("doc_id", "size", "source_size", "target", "taken", "copies"))


def op8_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return quality.score(docs, quality.train(docs, draw=F.xxhash64("doc_id", "text"))).drop("text")


def op9_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokens.tokenizer_path("word_bpe_49k.json"))


def op10_norm_bucketed_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(embeddings(spark, sf_dir))


def op11_polynomial_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op12_galloping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.link_counts(documents(spark, sf_dir), tokens.tokenizer_path("byte_bpe_50k.json"),
                             tokens.tokenizer_path("piece_bpe_32k.model"))


def op13_incremental_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(embeddings(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ftrl_language_id, op2_feistel_sharding, op3_crf_secret_scan, op4_minhash_near_dedup, op5_elias_fano_tokens, op6_p_stable_embedding_dedup,
        op7_exponential_key_mixing, op8_weak_label_quality, op9_hierarchical_packing, op10_norm_bucketed_top_k,
        op11_polynomial_exact_dedup, op12_galloping_alignment, op13_incremental_centroids,
    )
}



def _centroid_rounds(rounds: int) -> str:
    """The rounds of the centroid clustering unrolled: assignment ``a<r>``, centroids ``c<r>``."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
            SELECT r, min(d) AS distance, CAST(arg_min(k, (d, k)) AS INTEGER) AS cluster
            FROM (SELECT v.r, c.k, CAST(list_dot_product(v.e, v.e) - 2 * list_dot_product(v.e, c.e)
                                        + list_dot_product(c.e, c.e) AS BIGINT) AS d FROM v, c{r} c)
            GROUP BY r)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
            SELECT c.k, coalesce(m.e, c.e) AS e
            FROM c{r} c LEFT JOIN (
                SELECT cluster, list(x ORDER BY i) AS e FROM (
                    SELECT a.cluster, i, floor(sum(v.e[i]) / count(*)) AS x
                    FROM a{r} a JOIN v ON v.r = a.r CROSS JOIN range(1, 65) g(i) GROUP BY a.cluster, i)
                GROUP BY cluster) m ON m.cluster = c.k)""")
    return ", ".join(steps)


#: The other queries hash with functions that DuckDB lacks, tokenise, sample or train models;
#: tests hold them against brute force.
ORACLE: dict[str, str] = {
    # brute force: all pairs that share a shingle
    "op4_minhash_near_dedup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS MATERIALIZED (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
            FROM words
        ), flat AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
        links AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
        ), reach AS (
            SELECT doc_id AS x, doc_id AS root FROM sets
            UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.x
        ), least AS (SELECT x, min(root) AS component_id FROM reach GROUP BY x)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
        FROM sets s JOIN least l ON l.x = s.doc_id
    """,
    "op6_p_stable_embedding_dedup": """
        WITH RECURSIVE v AS MATERIALIZED (
            SELECT vec_id, row_number() OVER () AS r, [CAST(x AS DOUBLE) FOR x IN embedding] AS e,
                   embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
                   AND len([x FOR x IN embedding IF x <> 0]) > 0 AS fit
            FROM embeddings
        ), links AS MATERIALIZED (
            SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.r <> b.r AND a.fit AND b.fit AND len(a.e) = len(b.e)
            WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95
        ), reach AS (
            SELECT r AS x, vec_id AS root FROM v
            UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.x
        ), least AS (SELECT x, min(root) AS component_id FROM reach GROUP BY x),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT v.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, v.vec_id = l.component_id AS kept
        FROM v JOIN least l ON l.x = v.r LEFT JOIN counts c ON c.a = v.r
    """,
    "op10_norm_bucketed_top_k": """
        WITH v AS (
            SELECT vec_id, row_number() OVER () AS r,
                   [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, p.vec_id, CAST(list_dot_product(q.e, p.e) AS BIGINT) AS score
            FROM v q JOIN v p ON q.r <> p.r
            WHERE q.vec_id % 100 = 0
        ), t AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM t WHERE rank <= 10
    """,
    "op11_polynomial_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(t) AS text_sha256
        FROM d WINDOW same AS (PARTITION BY t)
    """,
    "op13_incremental_centroids": f"""
        WITH v AS MATERIALIZED (
            SELECT vec_id, row_number() OVER () AS r, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
            FROM embeddings
            WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, e) - 1 AS k, e
            FROM (SELECT sha256('3:' || vec_id) AS h, e FROM v ORDER BY h, e LIMIT 8)
        ), {_centroid_rounds(10)}
        SELECT v.vec_id, a.cluster, a.distance,
               CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string([CAST(x AS BIGINT) FOR x IN c.e], ',')) AS centroid_sha256
        FROM a10 a JOIN v ON v.r = a.r JOIN c10 c ON c.k = a.cluster
    """,
}
