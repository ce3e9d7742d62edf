"""Registered query of the Merkle manifest."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import merkle
from tessera.llm.common import documents
from tessera.llm.registry import register

#: The contract in SQL: levels by recursion over neighbours, paths by recursion over levels.
#: DuckDB has no crc32, so it is folded bit by bit over the digits of the id.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, text, source, n_chars,
         (xor(list_reduce([4294967295::BIGINT] || list_transform(
                range(1, 8 * length(doc_id::VARCHAR) + 1),
                lambda i: CASE WHEN (i - 1) % 8 = 0
                     THEN ascii(substr(doc_id::VARCHAR, ((i - 1) // 8 + 1)::INT, 1))::BIGINT
                     ELSE 0::BIGINT END),
            lambda a, b: CASE WHEN (xor(a, b) & 1) = 1
                THEN xor(xor(a, b) >> 1, 3988292384::BIGINT) ELSE xor(a, b) >> 1 END),
          4294967295::BIGINT)) % 7 = 0 AS forged
  FROM documents),
h AS (
  SELECT doc_id, lang, forged,
         coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
         || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
         || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') AS head,
         coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS size,
         coalesce(strlen((n_chars + 1)::VARCHAR)::VARCHAR || ':' || (n_chars + 1)::VARCHAR, '-') AS more,
         coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS tail FROM d),
leaf AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256(head || size || tail) AS leaf,
         sha256(head || CASE WHEN forged THEN more ELSE size END || tail) AS claim FROM h),
low(tree, level, idx, n, hash) AS (
  SELECT tree, 0, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1,
         count(*) OVER (PARTITION BY tree), leaf FROM leaf
  UNION ALL
  SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
  FROM low WHERE n > 1 GROUP BY tree, level, idx // 2, n),
top AS (SELECT tree, hash FROM low WHERE n = 1),
high(level, idx, n, hash) AS (
  SELECT 0, row_number() OVER (ORDER BY tree) - 1, count(*) OVER (), hash FROM top
  UNION ALL
  SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
  FROM high WHERE n > 1 GROUP BY level, idx // 2, n),
place AS (
  SELECT doc_id, tree, leaf, claim, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS idx
  FROM leaf),
walk(doc_id, leaf, tree, level, idx, acc, sibs) AS (
  SELECT doc_id, leaf, tree, 0, idx, claim, '' FROM place
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.level + 1, w.idx // 2,
         CASE WHEN s.hash IS NULL THEN sha256(w.acc) WHEN w.idx % 2 = 1 THEN sha256(s.hash || w.acc)
              ELSE sha256(w.acc || s.hash) END, w.sibs || coalesce(s.hash, '')
  FROM walk w JOIN low me ON me.tree = w.tree AND me.level = w.level AND me.idx = w.idx AND me.n > 1
  LEFT JOIN low s ON s.tree = w.tree AND s.level = w.level AND s.idx = xor(w.idx, 1)),
low_done AS (
  SELECT w.* FROM walk w JOIN low me ON me.tree = w.tree AND me.level = w.level AND me.n = 1),
trees AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS idx FROM top),
walk2(doc_id, leaf, tree, level, idx, acc, sibs) AS (
  SELECT doc_id, leaf, tree, 0, t.idx, acc, sibs FROM low_done JOIN trees t USING (tree)
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.level + 1, w.idx // 2,
         CASE WHEN s.hash IS NULL THEN sha256(w.acc) WHEN w.idx % 2 = 1 THEN sha256(s.hash || w.acc)
              ELSE sha256(w.acc || s.hash) END, w.sibs || coalesce(s.hash, '')
  FROM walk2 w JOIN high me ON me.level = w.level AND me.idx = w.idx AND me.n > 1
  LEFT JOIN high s ON s.level = w.level AND s.idx = xor(w.idx, 1))
SELECT w.doc_id, w.leaf, top.hash AS subroot, r.hash AS root, sha256(w.sibs) AS proof_sha256,
       w.acc AS folded_root, w.acc = r.hash AS verified
FROM walk2 w JOIN high me ON me.level = w.level AND me.n = 1
JOIN top ON top.tree = w.tree CROSS JOIN (SELECT hash FROM high WHERE n = 1) r
"""


@register("op13_merkle_manifest", ORACLE)
def op13_merkle_manifest(spark, sf_dir):
    docs = documents(spark, sf_dir)
    forged = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    size = F.when(forged, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    proofs = merkle.manifest(
        docs, F.col("lang"), ["doc_id"],
        merkle.leaf_digest("doc_id", "source", "lang", "n_chars", "text"),
        {"doc_id": F.col("doc_id"),
         "claim": F.when(forged, merkle.leaf_digest("doc_id", "source", "lang", size, "text"))})
    folded = merkle.folded(F.coalesce("claim", "leaf"), F.col("path"))
    return proofs.select(
        "doc_id", "leaf", F.col("top").alias("subroot"), "root",
        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
