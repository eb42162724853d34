"""Vectors in blocks, the unit of work of the vector operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null and without null, infinite or undefined components."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.coalesce(F.forall(vector, finite), F.lit(False))


def block_count(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def packed(rows: DataFrame, blocks: int, key: Column, *columns: str) -> DataFrame:
    """Rows dealt by the hash of ``key`` into ``blocks`` blocks of one row each.

    Every block holds about the same, chosen number of rows, so its size is bounded.
    """
    return (
        rows.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)))
        .groupBy("block")
        .agg(F.collect_list(F.struct(*columns)).alias("rows"))
    )
