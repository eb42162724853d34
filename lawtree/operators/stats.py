"""Counters over laws, elements and ingest outcomes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawtree import schema as S


def count_elems_by_law(elements: DataFrame, *carry: str) -> DataFrame:
    """Elements per law and type; ``carry`` names law columns to keep."""
    return elements.groupBy("law_id", *carry, "etype").agg(F.count(F.lit(1)).alias("n"))


def count_elems(elements: DataFrame, etypes: Iterable[str] = S.BASIC_ETYPES) -> DataFrame:
    """Elements per type, with 0 for types that do not occur."""
    names = list(etypes)
    zeros = elements.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, names))).alias("etype"), F.lit(0).alias("n")
    )
    ones = elements.where(F.col("etype").isin(*names)).select("etype", F.lit(1).alias("n"))
    return ones.unionByName(zeros).groupBy("etype").agg(F.sum("n").alias("n"))


def count_rollup(elements: DataFrame, *keys: str) -> DataFrame:
    """Counts per type within ``keys`` and for every prefix of them."""
    return elements.rollup(*keys, "etype").agg(F.count(F.lit(1)).alias("n"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Files in all, laws registered, errors and both kinds of skip, in one row."""

    def having(outcome: str):
        return F.count_if(F.col("outcome") == outcome).alias(outcome)

    return outcomes.agg(
        F.count(F.lit(1)).alias("files"),
        *map(having, ("registered", "skipped_known", "skipped_not_reiki", "error")),
    )


def distinct_strings(sentences: DataFrame) -> DataFrame:
    return sentences.select(F.col("sentence").alias("string")).distinct()
