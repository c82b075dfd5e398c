"""The corpus pipeline: five stages over documents, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillgraph.llm import mixing, neardup, packing, rules, substring
from quillgraph.llm.shared import written

STAGES = [
    ("quality_rules", rules.stage),
    ("near_dedup", neardup.stage),
    ("substring_dedup", substring.stage),
    ("source_mixing", mixing.stage),
    ("packing", packing.stage),
]

#: Token ids, banding and automata have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
