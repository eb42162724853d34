"""Prefectures and municipalities, and the join that gives a law its place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawtree import schema as S
from lawtree.functions import scalars


def prefectures(rows: DataFrame) -> DataFrame:
    """One row per prefecture name; the last line that names it decides its code."""
    coded = rows.withColumn("pref_id", scalars.pref_of(F.col("code")))
    return (
        coded.groupBy(F.col("pref_name").alias("name"))
        .agg(F.max_by("pref_id", "row_no").alias("pref_id"))
        .select(*S.PREFECTURES.fieldNames())
    )


def municipalities(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("code").cast("int").alias("muni_id"),
        scalars.pref_of(F.col("code")).alias("pref_id"),
        F.col("muni_name").alias("name"),
    )


def with_place(laws: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Laws with the prefecture and name of their municipality.

    No broadcast hint: Spark broadcasts the list when its size allows, and otherwise splits
    a municipality that holds a large share of the laws (adaptive skew join).
    """
    places = municipalities.select("muni_id", "pref_id", F.col("name").alias("muni_name"))
    return laws.drop("pref_id").join(places, "muni_id")


def check(prefectures: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Problems of both lists as rows ``(table_name, problem, value)``."""

    def found(rows: DataFrame, table: str, problem: str, value) -> DataFrame:
        return rows.select(
            F.lit(table).alias("table_name"), F.lit(problem).alias("problem"),
            value.cast("string").alias("value"),
        )

    out = []
    for table, rows, key in (
        ("prefectures", prefectures, "pref_id"), ("municipalities", municipalities, "muni_id"),
    ):
        doubles = rows.groupBy(key).count().where("count > 1")
        out.append(found(doubles, table, "duplicate key", F.col(key)))
        too_long = rows.where(F.length("name") > S.NAME_LIMIT)
        out.append(found(too_long, table, "name too long", F.col("name")))
        out.append(found(rows.where(F.col("name").isNull()), table, "no name", F.col(key)))
    orphans = municipalities.join(prefectures, "pref_id", "left_anti")
    out.append(found(orphans, "municipalities", "unknown prefecture", F.col("muni_id")))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
