"""Registered query of the language operator."""

from __future__ import annotations

from tessera.llm import language
from tessera.llm.common import documents
from tessera.llm.registry import register


@register("op4_language_id")
def op4_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    dictionaries = language.learn_dictionaries(docs.where(~language.held_out()))
    out = language.identify(docs.select("doc_id", "text"), dictionaries)
    return out.select("doc_id", language.held_out().alias("held_out"),
                      "lang_pred", "lang_score", "lang_rejected").withColumnsRenamed(
        {"lang_score": "score", "lang_rejected": "rejected"})
