"""Registered query of the decontamination operator."""

from __future__ import annotations

from tessera.llm import decontaminate
from tessera.llm.common import documents
from tessera.llm.registry import register
from tessera.session import read_table


@register("op10_decontaminate")
def op10_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(documents(spark, sf_dir),
                                      read_table(spark, sf_dir, "benchmark"))
