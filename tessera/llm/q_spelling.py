"""Registered query of the spelling variants."""

from __future__ import annotations

from tessera.llm import spelling
from tessera.llm.common import documents
from tessera.llm.registry import register

#: The contract in SQL: crc32 folded bit by bit (DuckDB has none), near words through equal
#: strings after one deletion, roots by recursion.
ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
o AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w,
         count(*) AS c FROM t WHERE length(run) >= 6 GROUP BY 1, 2),
b AS (
  SELECT doc_id, w, c, list_concat(
           list_transform(string_split(doc_id::VARCHAR || ':', ''), lambda x: unicode(x)::BIGINT),
           flatten(list_transform(string_split(w, ''), lambda x:
             CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
                  ELSE [195::BIGINT, 128 + (unicode(x) & 63)::BIGINT] END))) AS bytes FROM o),
h AS (
  SELECT w, c, xor(list_reduce([4294967295::BIGINT] || list_transform(
             range(0, 8 * len(bytes)),
             lambda i: CASE WHEN i % 8 = 0 THEN bytes[(i // 8 + 1)::INT] ELSE 0::BIGINT END),
           lambda a, x: CASE WHEN (xor(a, x) & 1) = 1
                THEN xor(xor(a, x) >> 1, 3988292384::BIGINT) ELSE xor(a, x) >> 1 END),
         4294967295::BIGINT) AS h FROM b),
e AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, (h % length(w))::INT)
              || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, c FROM h),
v AS (
  SELECT word, sum(c)::BIGINT AS n FROM e WHERE length(word) >= 6
  GROUP BY word HAVING sum(c) >= 5),
d AS (
  SELECT word, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS less
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (
  SELECT a.word, z.word AS near FROM d a JOIN d z ON a.less = z.less AND a.i = z.i AND a.word <> z.word
  UNION SELECT d.word, v.word FROM d JOIN v ON d.less = v.word
  UNION SELECT v.word, d.word FROM d JOIN v ON d.less = v.word),
k AS (
  SELECT p.word, p.near, v.n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, p.near) AS place
  FROM p JOIN v ON v.word = p.near),
f AS (
  SELECT v.word, v.n, coalesce(k.n_near, 0) AS n_near,
         CASE WHEN k.n >= 5 * v.n THEN k.near END AS form,
         CASE WHEN k.n >= 5 * v.n THEN k.n END AS form_n
  FROM v LEFT JOIN k ON k.word = v.word AND k.place = 1),
r AS (
  SELECT word, word AS last, form AS next FROM f
  UNION ALL
  SELECT r.word, f.word, f.form FROM r JOIN f ON f.word = r.next)
SELECT f.word, f.form, r.last AS root, f.n, f.n_near, f.form_n
FROM f JOIN r ON r.word = f.word AND r.next IS NULL
"""


@register("op11_spelling_variants", ORACLE)
def op11_spelling_variants(spark, sf_dir):
    found = spelling.variants(spelling.vocabulary(documents(spark, sf_dir)))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
