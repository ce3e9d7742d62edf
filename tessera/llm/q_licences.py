"""Registered query of the licence scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import licences as lic
from tessera.llm.common import documents
from tessera.llm.registry import register


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _oracle() -> str:
    case = " ".join(f"WHEN regexp_matches(s, {_text(p)}) THEN {_text(n)}" for n, p in lic.SENTENCES)
    left, hits = "concat('|', array_to_string(ids, '|'), '|')", []
    for i, (name, ids) in enumerate(lic.RULES):
        seq = _text("|" + "|".join(ids) + "|")
        hits.append((f"x{i}", f"x{i + 1}", name, seq))
    steps = ["c0 AS (SELECT doc_id, sentences, ids, " + left + " AS x0 FROM i)"]
    for n, (a, b, _, seq) in enumerate(hits):
        steps.append(f"c{n + 1} AS (SELECT *, replace({a}, {seq}, '||') AS {b} FROM c{n})")
    found = ", ".join(f"CASE WHEN {a} <> {b} THEN {_text(name)} END" for a, b, name, _ in hits)
    order = "[" + ", ".join(_text(n) for n in dict.fromkeys(n for n, _ in lic.RULES)) + "]"
    return f"""
WITH s AS (
  SELECT doc_id, CASE WHEN regexp_matches(lower(text), {_text(lic.HINT)}) THEN list_filter(
    string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text),
      {_text(lic.LEADER)}, '\\1', 'g'), {_text(lic.QUOTES)}, '', 'g'),
      {_text(lic.LINE_BREAK)}, '\\1\\2' || chr(1), 'g'), {_text(lic.SPACE)}, ' ', 'g'), chr(1)),
    lambda s: regexp_matches(s, {_text(lic.HINT)})) ELSE [] END AS sentences FROM documents),
o AS (SELECT doc_id, sentences, flatten(list_transform(coalesce(sentences, []), lambda s:
  CASE WHEN regexp_matches(s, {_text(lic.EXPRESSION)}) THEN list_transform(
    string_split_regex(regexp_replace(regexp_extract(s, {_text(lic.EXPRESSION)}, 1), {_text(lic.EXCEPTION)}, '', 'g'),
      ' (or|and) '), lambda p: {_text(lic.SPDX_LEAD)} || regexp_replace(p, {_text(lic.BRACKETS)}, '', 'g'))
  ELSE [s] END)) AS parts FROM s),
i AS (SELECT doc_id, sentences, list_transform(parts, lambda s: CASE {case} ELSE 'unknown' END) AS ids FROM o),
{", ".join(steps)}
SELECT doc_id, CAST(len(coalesce(sentences, [])) AS BIGINT) AS n_sentences, array_to_string(ids, ',') AS identifiers,
  array_to_string(list_filter(named, lambda o: o <> {_text(lic.LAST)} OR len(named) = 1), ',') AS licences
FROM (SELECT *, list_filter({order}, lambda o: list_contains([{found}], o)) AS named FROM c{len(hits)})
"""


@register("op6_licence_scan", _oracle())
def op6_licence_scan(spark, sf_dir):
    found = lic.scan(documents(spark, sf_dir))
    order = F.array(*[F.lit(n) for n in dict.fromkeys(n for n, _ in lic.RULES)])
    return found.select(
        "doc_id", F.size("sentences").cast("long").alias("n_sentences"),
        F.array_join("identifiers", ",").alias("identifiers"),
        F.array_join(F.filter(order, lambda o: F.array_contains("licences", o)), ",").alias("licences"))
