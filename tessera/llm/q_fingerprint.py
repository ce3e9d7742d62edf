"""Registered query of the fingerprint operator."""

from __future__ import annotations

from tessera.llm import fingerprint
from tessera.llm.common import documents
from tessera.llm.registry import register


@register("op9_lz_fingerprint")
def op9_lz_fingerprint(spark, sf_dir):
    return fingerprint.compare_with_next(documents(spark, sf_dir))
