"""Importing this module registers the queries of the training-data operators."""

from tessera.llm import (q_chat, q_decontaminate, q_fingerprint,  # noqa: F401
                         q_language, q_licences, q_merkle,
                         q_mixing, q_near_dup, q_ngram_join, q_sharding,
                         q_spelling, q_suffix_dedup, q_tokens)
from tessera.llm.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
