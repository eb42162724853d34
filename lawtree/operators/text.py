"""Sentences into tokens and characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Runs of one script. No general letter class: it would swallow the 条 of 1条.
SCRIPT_RUNS = (
    r"\p{IsHan}+|\p{IsHiragana}+|[\p{IsKatakana}ー]+|\p{IsLatin}+|\p{Nd}+"
)


def script_runs(sentence: Column) -> Column:
    """Default segmentation. Dictionary segmenters plug in as a pandas UDF instead."""
    return F.regexp_extract_all(sentence, F.lit(SCRIPT_RUNS), F.lit(0))


def tokenize(sentences: DataFrame, segment=script_runs) -> DataFrame:
    """One row per token; ``segment`` maps the sentence column to an array of strings."""
    others = [c for c in sentences.columns if c != "sentence"]
    return sentences.select(*others, F.posexplode(segment(F.col("sentence"))).alias("pos", "token"))


def spaced(segment=script_runs):
    """A ``preprocess`` hook that rewrites a sentence as its tokens joined with spaces."""
    return lambda sentence: F.array_join(segment(sentence), " ")


def characters(sentences: DataFrame) -> DataFrame:
    """One row per character, ``pos`` from 0."""
    others = [c for c in sentences.columns if c != "sentence"]
    rows = sentences.where(F.col("sentence") != "")
    return rows.select(*others, F.posexplode(F.split("sentence", "")).alias("pos", "char"))
