"""Registered queries of the corpus operators: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from signalyard.llm import (bagminhash, centroids, common, exact_dedup, fingerprint, mixing, packing, quantised, runs,
                            secret_scan, token_index, toxicity, warc, wordpiece)

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(common.documents(spark, sf_dir), public_tokenizers.path(WORD_BPE), end_id=0)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id shards with a perfect-hash index, written and read back."""
    return token_index.round_trip(spark, common.documents(spark, sf_dir), common.shared_path(spark, "token-store"),
                                  public_tokenizers.path(WORD_BPE), end_id=1)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text, by way of a fresh blob ledger."""
    return secret_scan.report(common.documents(spark, sf_dir), common.shared_path(spark, "secret-ledger"))


def op4_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as two WARC replicas, one of them damaged, and audited."""
    return warc.audited_copy(spark.read.parquet(f"{sf_dir}/pages.parquet"), common.shared_path(spark, "warc"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text by a grammar learned outside the held-out fold."""
    return toxicity.report(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 1, 2, 3."""
    return mixing.mix(common.documents(spark, sf_dir)).drop("row")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of identical texts."""
    return exact_dedup.exact_groups(common.documents(spark, sf_dir)).drop("row")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy longest-match word-piece counts of every text."""
    return wordpiece.count_pieces(common.documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicates by BagMinHash over five-word shingles."""
    return bagminhash.near_classes(common.documents(spark, sf_dir)).drop("row")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every text and its edited text, compared."""
    return fingerprint.edited_neighbours(common.documents(spark, sf_dir))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rounds of eight centroids over all 64-component vectors."""
    return centroids.clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors at a cosine of 0.95 or more, and their components."""
    return quantised.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every text, some of which get a periodic tail."""
    return runs.word_runs(common.documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_token_files, op3_secret_scans, op4_warc_audit, op5_toxicity,
    op6_source_mix, op7_exact_dedup, op8_token_counts, op9_near_dedup, op10_fingerprints,
    op11_centroids, op12_near_vectors, op13_runs,
)}

def _centroid_rounds(k: int = 8, rounds: int = 10) -> str:
    """DuckDB SQL of the clusters: a table of centroids for each round."""
    nearest = """SELECT v.row, min_by(struct_pack(c := c.cluster, d := e.d), struct_pack(d := e.d, c := c.cluster)) AS m
                 FROM vectors v CROSS JOIN c{t} c
                 CROSS JOIN LATERAL (SELECT list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d) e GROUP BY v.row"""
    parts = ["""vectors AS MATERIALIZED (
          SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda v: floor(1024 * v::DOUBLE)::BIGINT) AS x FROM embeddings
          WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v::DOUBLE))) = 64)""",
             f"""c0 AS MATERIALIZED (
          SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1)::INTEGER AS cluster, x FROM vectors
          QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id)) <= {k})"""]
    for t in range(rounds):
        parts.append(f"""a{t} AS MATERIALIZED ({nearest.format(t=t)})""")
        parts.append(f"""s{t} AS (SELECT m.c AS cluster, i, sum(x[i]) AS s, count(*) AS n
          FROM a{t} JOIN vectors USING (row) CROSS JOIN range(1, 65) r(i) GROUP BY 1, 2)""")
        parts.append(f"""m{t} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM s{t} GROUP BY 1)""")
        parts.append(f"""c{t + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{t}.x, c{t}.x) AS x FROM c{t} LEFT JOIN m{t} USING (cluster))""")
    parts.append(f"""fin AS MATERIALIZED ({nearest.format(t=rounds)})""")
    return "WITH " + ",\n        ".join(parts) + f"""
        SELECT vec_id, m.c AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia,
               (sum(m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
        FROM fin JOIN vectors USING (row) JOIN c{rounds} ON c{rounds}.cluster = m.c"""


ORACLE: dict[str, str] = {
    "op11_centroids": _centroid_rounds(),
    # all pairs by brute force; components by spreading the smallest id along links
    "op12_near_vectors": """
        WITH RECURSIVE good AS MATERIALIZED (
          SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings
          WHERE len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v::DOUBLE))) = len(embedding)
            AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
        links AS MATERIALIZED (
          SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
          AND list_cosine_similarity(a.x, b.x) >= 0.95),
        reached(id, c) AS (SELECT vec_id, vec_id FROM good UNION SELECT links.b, reached.c FROM reached JOIN links ON links.a = reached.id),
        component AS (SELECT id, min(c) AS c FROM reached GROUP BY id),
        counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
        FROM embeddings LEFT JOIN component ON id = vec_id LEFT JOIN counted ON a = vec_id""",
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
}
