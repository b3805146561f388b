"""The queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareloom.llm import (
    chat_format, conversation_repair, decontamination, piece_tokens, quality_model, quality_rules, secret_scan, sharding, simhash,
    suffix_dedup, url_filter, warc, whitening,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name -> (spark, sf_dir) -> DataFrame."""
    found = (
        decontamination.op1_decontamination,
        secret_scan.op2_secret_scan,
        warc.op3_warc_revisits,
        piece_tokens.op4_sentencepiece,
        simhash.op5_simhash,
        sharding.op6_sharding,
        chat_format.op7_chat_format,
        quality_model.op8_quality_model,
        quality_rules.op9_quality_rules,
        suffix_dedup.op10_suffix_dedup,
        whitening.op11_embedding_whitening,
        conversation_repair.op12_conversation_repair,
        url_filter.op13_url_filter,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where SQL can express a query."""
    return {
        "op2_secret_scan": secret_scan.oracle_sql(),
        "op3_warc_revisits": warc.oracle_sql(),
        "op7_chat_format": chat_format.oracle_sql(),
        "op9_quality_rules": quality_rules.oracle_sql(),
        "op13_url_filter": url_filter.oracle_sql(),
    }
