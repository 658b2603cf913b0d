"""Corpus pipeline: each stage works on what the stage before it kept."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattgrid.llm import exact_dedup, packing, pii_surrogates, simhash_dedup, toxicity
from wattgrid.llm.common import table, written

STAGES = [
    ("toxicity", toxicity.stage),
    ("exact dedup", exact_dedup.stage),
    ("simhash near-dedup", simhash_dedup.stage),
    ("pii", pii_surrogates.stage),
    ("best-fit packing", packing.stage),
]

# Stages that SQL cannot express make the whole inexpressible; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
