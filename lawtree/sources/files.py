"""Corpus files: a directory tree ``<pref>/<muni>/<file>.xml`` or a table of documents."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree import schema as S
from lawtree.functions import scalars


def _part(path: Column, position: int) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(position))


def with_codes(files: DataFrame) -> DataFrame:
    """Prefecture, municipality and file codes from the last three parts of ``path``.

    A part that is no number gives a NULL code, which registration reports as an error.
    """
    path = F.col("path")
    stem = F.regexp_replace(_part(path, -1), r"(?<=.)\.[^.]*$", "")
    coded = files.withColumns(
        {
            "pref_id": _part(path, -3).try_cast("smallint"),
            "muni_id": _part(path, -2).try_cast("int"),
            "file_id": stem.try_cast("int"),
        }
    )
    return coded.withColumn("code", scalars.law_code(*map(F.col, ("pref_id", "muni_id", "file_id"))))


def in_municipality(files: DataFrame, root: str = "") -> DataFrame:
    """Files somewhere below a directory whose name starts with six digits.

    Directories above ``root`` do not count. A file in a subdirectory has no municipality code of
    its own; registration reports it.
    """
    path = F.col("path")
    below = re.sub("^[a-z]+:/+(?=/)", "", root.rstrip("/"))
    inner = F.substring(path, F.locate(below, path) + len(below), F.length(path)) if below else path
    folders = F.split(inner, "/")
    named = F.slice(folders, F.lit(1), F.greatest(F.size(folders) - 1, F.lit(0)))
    return files.where(F.exists(named, lambda d: d.rlike("^[0-9]{6}")))


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Use every core on an input of few splits; an input with enough of them stays as it is."""
    if rows.isStreaming:
        return rows
    wanted = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= wanted else rows.repartition(wanted, key)


def _layout(listing: DataFrame) -> DataFrame:
    named = listing.withColumnRenamed("modificationTime", "modification_time")
    return with_codes(named).select(*S.FILES.fieldNames())


def _reader(reader, extensions: Iterable[str] | None):
    reader = reader.format("binaryFile").option("recursiveFileLookup", True)
    if extensions is None:
        return reader
    return reader.option("pathGlobFilter", "{" + ",".join(f"*{e}" for e in extensions) + "}")


def corpus_files(
    spark: SparkSession, root: str, extensions: Iterable[str] | None = (".xml",)
) -> DataFrame:
    """All files below ``root`` with one of the extensions, or all files if None.

    Content is read only where it is used.
    """
    return _layout(_reader(spark.read, extensions).load(root))


def corpus_stream(
    spark: SparkSession,
    root: str,
    extensions: Iterable[str] | None = (".xml",),
    max_files: int | None = None,
) -> DataFrame:
    """The same listing as a file stream; ``max_files`` bounds one micro-batch."""
    reader = _reader(spark.readStream, extensions).schema(
        "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _layout(reader.load(root))


# Columns of the municipality list; the first line is a header.
MUNICIPALITY_CSV = "code INT, pref_name STRING, muni_name STRING, extra1 STRING, extra2 STRING"


def municipality_csv(spark: SparkSession, path: str) -> DataFrame:
    """Municipality list ``(row_no, code, pref_name, muni_name)`` in line order."""
    rows = (
        spark.read.schema(MUNICIPALITY_CSV)
        .option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )
    return rows.select(
        F.monotonically_increasing_id().alias("row_no"), "code", "pref_name", "muni_name"
    )
