"""A law and its tree from the stored tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lawtree import schema as S
from lawtree.functions import scalars
from lawtree.operators import dims


def law_header(laws: DataFrame, municipalities: DataFrame, law_id: int | None = None) -> DataFrame:
    """File, municipality and prefecture codes, name and number of one law, or of all."""
    rows = laws if law_id is None else laws.where(F.col("law_id") == law_id)
    placed = dims.with_place(rows, municipalities)
    return placed.select("law_id", "file_id", "muni_id", "pref_id", "name", "num")


def name_and_num(laws: DataFrame, law_id: int) -> DataFrame:
    return laws.where(F.col("law_id") == law_id).select("name", "num")


def provisions(
    elements: DataFrame, law_id: int, etypes: Iterable[str] = S.BASIC_ETYPES
) -> DataFrame:
    """Top-level elements of a law by number."""
    wanted = [e for e in etypes if e in S.PROVISIONS]
    rows = elements.where((F.col("law_id") == law_id) & F.col("etype").isin(*wanted))
    return rows.orderBy("num", "ord")


def children_of(elements: DataFrame, law_id: int, elem_id: int) -> DataFrame:
    """Children of one element by number."""
    own = (F.col("law_id") == law_id) & (F.col("parent_id") == elem_id)
    return elements.where(own).orderBy("num", "ord")


def in_order(elements: DataFrame) -> DataFrame:
    """``elements`` with ``place``: 0, 1, 2... among the children of one parent, by number."""
    siblings = Window.partitionBy("law_id", "parent_id").orderBy("num", "num_path", "ord")
    return elements.withColumn("place", F.row_number().over(siblings) - 1)


def element_content(elements: DataFrame, law_id: int, elem_id: int) -> DataFrame:
    own = (F.col("law_id") == law_id) & (F.col("elem_id") == elem_id)
    return elements.where(own).select(scalars.content(F.col("texts")).alias("content"))


def law_tree(elements: DataFrame, etypes: Iterable[str] = S.BASIC_ETYPES) -> DataFrame:
    """Stored trees without further checks; only provisions are held against ``etypes``."""
    wanted = [e for e in etypes if e in S.PROVISIONS]
    top = F.coalesce(F.get("lineage", F.lit(0))["etype"], F.col("etype"))
    return elements.where(top.isin(*wanted))
