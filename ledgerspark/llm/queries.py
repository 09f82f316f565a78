"""The operators' queries, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, divergence, embed_dedup, langid, licenses, merkle, mixing, order_minhash, quality, secrets, simhash, suffix_dedup, token_shards

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": langid.query,
    "op2_byte_bpe": bpe.query,
    "op3_quality": quality.query,
    "op4_order_minhash": order_minhash.query,
    "op5_secrets": secrets.query,
    "op6_suffix_dedup": suffix_dedup.query,
    "op7_embedding_dedup": embed_dedup.query,
    "op8_simhash": simhash.query,
    "op9_mixing": mixing.query,
    "op10_licenses": licenses.query,
    "op11_merkle": merkle.query,
    "op12_token_shards": token_shards.query,
    "op13_divergence": divergence.query,
}

ORACLE_SQL: dict[str, str] = {
    "op5_secrets": secrets.SQL,
    "op10_licenses": licenses.SQL,
    "op11_merkle": merkle.SQL,
    "op13_divergence": divergence.SQL,
}
