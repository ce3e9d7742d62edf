"""Registered query of the token counter."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import tokens
from tessera.llm.common import documents
from tessera.llm.registry import register

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096


def model_bytes(name: str = MODEL) -> bytes:
    import public_tokenizers
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


@register("op8_token_count")
def op8_token_count(spark, sf_dir):
    counted = tokens.count_tokens(documents(spark, sf_dir), model_bytes())
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
