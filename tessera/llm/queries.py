"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.decontamination import decontaminate

    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), width=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.quality_rules import judge

    found = judge(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "posterior",
    )


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.secrets import scan

    return scan(_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.quality_classifier import classify

    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.simhash import near_duplicates

    found = near_duplicates(_table(spark, sf_dir, "documents"), radius=4, shingle=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.sharding import shard

    return shard(_table(spark, sf_dir, "documents"), shards=24)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.toxicity import detect

    found = detect(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), "piece_bpe_32k.model", limit=4096)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.substrings import repeated_words

    return repeated_words(_table(spark, sf_dir, "documents"), width=35)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"), components=8)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.periodic_runs import detect

    return detect(_table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.languages import identify

    return identify(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_benchmark_decontamination,
        op3_quality_rules,
        op4_secret_scans,
        op5_quality_classifier,
        op6_simhash_near_dedup,
        op7_sharding,
        op8_toxicity,
        op9_token_counts,
        op10_substring_dedup,
        op11_embedding_whitening,
        op12_periodic_runs,
        op13_language_id,
    )
}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op2_benchmark_decontamination": r"""
WITH fold AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), wanted AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM wanted), there AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM fold, sizes WHERE len(w) >= n)
), hit AS (
  SELECT t.doc_id, t.i, t.n, q.item_id FROM there t JOIN wanted q ON t.n = q.n AND t.g = q.g
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id
)
SELECT f.doc_id, CAST(len(f.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM fold f LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
""",
    "op10_substring_dedup": r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM split WHERE len(w) >= 35)
), again AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM win) WHERE n > 1
), gone AS (SELECT doc_id, list(p) AS ps FROM again GROUP BY doc_id)
SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN ps IS NULL THEN array_to_string(w, ' ') ELSE
         coalesce((SELECT string_agg(x, ' ' ORDER BY i) FROM (SELECT unnest(s.w) AS x, unnest(range(1, len(s.w) + 1)) AS i) u
          WHERE NOT list_contains(g.ps, u.i)), '') END) AS kept_sha256
FROM split s LEFT JOIN gone g USING (doc_id)
""",
}
