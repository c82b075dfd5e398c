"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import binary, chat, interactions, lines, mixing, neardup, packing, periods, rules, substring, tokens, topk, toxicity
from .sql import SQL

Query = Callable[[SparkSession, str], DataFrame]


def _on(table: str, f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def _labelled(f: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": _on("documents", substring.op1),
        "op2_token_counts": _on("documents", tokens.token_counts),
        "op3_source_mixing": _on("documents", mixing.op3),
        "op4_toxicity": _labelled(toxicity.op4),
        "op5_packing": _on("documents", packing.op5),
        "op6_top_k": _on("embeddings", topk.op6),
        "op7_near_duplicates": _on("documents", neardup.op7),
        "op8_chat_format": _on("conversations", chat.op8),
        "op9_id_matrices": _on("documents", binary.op9),
        "op10_quality_rules": _on("documents", rules.op10),
        "op11_filter_interactions": _labelled(interactions.op11),
        "op12_periodic_runs": _on("documents", periods.op12),
        "op13_line_dedup": _on("documents", lines.op13),
    }


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
