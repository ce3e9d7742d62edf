"""Registered query of the near-duplicate operator."""

from __future__ import annotations

from tessera.llm import near_dup
from tessera.llm.common import documents
from tessera.llm.registry import register

#: The contract in SQL: all pairs that share a shingle, counted on the full sets, then the
#: closure of the links.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
           WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
           ELSE list_transform(range(1, len(words) - 3),
                               lambda i: array_to_string(words[i:i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
      FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * shared >= 85 * (nx.n + ny.n - shared)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x AS v, x AS c FROM e UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.v),
m AS (SELECT v, min(c) AS c FROM r GROUP BY v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id,
       d.doc_id = coalesce(m.c, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.v = d.doc_id
"""


@register("op7_near_dup", ORACLE)
def op7_near_dup(spark, sf_dir):
    found = near_dup.near_duplicates(documents(spark, sf_dir))
    return found.drop("cls").withColumnRenamed("id", "doc_id")
