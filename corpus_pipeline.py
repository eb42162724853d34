"""A corpus pipeline: quality, line dedup, near-dedup, mixing and encoding, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lawtree.llm import bytecnn, linedup, mixing, pieces, simhash
from lawtree.llm.common import saved, table

STAGES = [
    ("quality_classifier", bytecnn.stage),
    ("line_dedup", linedup.stage),
    ("simhash_near_dedup", simhash.stage),
    ("mix_sources", mixing.stage),
    ("sentencepiece", pieces.stage),
]

# SQL can express neither the classifier nor the encoder; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads the table that the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
