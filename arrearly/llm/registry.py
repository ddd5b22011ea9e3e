"""Queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame,
and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat, decontaminate, divergence, hard_negatives, html_text, jaccard_join, language_id, line_dedup, lm_scores, nearest, packing, quality,
    token_counts,
)
from .common import ship, table


def _of(fn: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(*[table(ship(spark), sf_dir, t) for t in tables])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scores": _of(lm_scores.contract, "documents"),
    "op2_decontaminate": _of(decontaminate.contract, "documents", "benchmark"),
    "op3_nearest": _of(nearest.contract, "embeddings"),
    "op4_quality": _of(quality.contract, "documents", "labels"),
    "op5_jaccard_join": _of(jaccard_join.contract, "documents"),
    "op6_line_dedup": _of(line_dedup.contract, "documents"),
    "op7_chat_format": _of(chat.contract, "conversations"),
    "op8_token_counts": _of(lambda docs: token_counts.section_counts(docs, rule="majority"), "documents"),
    "op9_language_id": _of(language_id.contract, "documents"),
    "op10_packing": _of(packing.contract, "documents"),
    "op11_hard_negatives": _of(hard_negatives.contract, "embeddings"),
    "op12_html_text": _of(html_text.contract, "pages"),
    "op13_divergence": _of(divergence.contract, "documents"),
}

ORACLE: dict[str, str] = {
    "op1_lm_scores": lm_scores.SQL,
    "op2_decontaminate": decontaminate.SQL,
    "op5_jaccard_join": jaccard_join.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op7_chat_format": chat.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op13_divergence": divergence.SQL,
}
