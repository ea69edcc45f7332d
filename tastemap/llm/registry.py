"""Registered training-data queries and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, contain, embjoin, langid, lmscore, minhash, pii, quality, runs, secrets, trie, wordpiece

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": bpe.op1,
    "op2_chat_format": chat.op2,
    "op3_minhash_dedup": minhash.op3,
    "op4_lm_score": lmscore.op4,
    "op5_pii": pii.op5,
    "op6_language_id": langid.op6,
    "op7_decontaminate": contain.op7,
    "op8_quality_rules": quality.op8,
    "op9_token_counts": wordpiece.op9,
    "op10_secrets": secrets.op10,
    "op11_periodic_runs": runs.op11,
    "op12_prefix_trie": trie.op12,
    "op13_embedding_dedup": embjoin.op13,
}

ORACLE: dict[str, str] = {
    "op2_chat_format": chat.OP2_SQL,
    "op7_decontaminate": contain.OP7_SQL,
    "op8_quality_rules": quality.OP8_SQL,
    "op12_prefix_trie": trie.OP12_SQL,
    "op13_embedding_dedup": embjoin.OP13_SQL,
}
