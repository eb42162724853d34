"""Shared helpers: tables, stored intermediate results, words, connected components."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The white space that parts words, as a regular expression class.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; without it one below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


# Whether the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there.

    Nothing reads the shuffles behind it again, so their files go with the end of the write.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def freed(df: DataFrame) -> None:
    """Delete the files of a table that ``saved`` wrote and nothing needs any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case. Bytes know no other white space or letter case."""
    return text.encode().lower().split() if text else []


def text_words(text: Column) -> Column:
    """Number of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the given fold; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def mapped(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    return df.mapInArrow(function, schema)


def numbered(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``idx``, each row's place from 0 in its group by ``order``, and ``total``, the group's rows.

    Rows are sorted by range partitions and numbered inside them; only the number of rows per
    partition and group is summed up, so no group has to pass through one task. Group columns must
    not be null. Columns that begin with ``__`` are left to this function.
    """
    spread = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    rows = saved(spread.withColumn("__at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("__at", 33).alias("__part")
    held = rows.groupBy(*group, part).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    whole = Window.partitionBy(*group)  # a row per partition and group
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(
        *group, "__part", (F.col("__first") - F.coalesce(F.sum("__n").over(before), F.lit(0))).alias("__offset"),
        F.sum("__n").over(whole).alias("total"),
    )
    # Stored, so that its size is known when it is joined.
    placed = rows.withColumn("__part", part).join(saved(offsets, "offsets"), [*group, "__part"])
    return placed.select(*df.columns, (F.col("__at") - F.col("__offset")).alias("idx"), "total")


def _star(edges: DataFrame) -> DataFrame:
    """One round: first every larger neighbour, then every smaller one moves to the least."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    large = (
        both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
    )
    least = large.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.withColumnRenamed("m", "lo")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b): the smallest node it can reach.

    Alternating large and small stars: the number of rounds grows with the logarithm of the
    longest path, edges never grow in number, and a node of high degree is an aggregation key
    or the side of a join that can be split. Edges stay in Spark; the driver sees a checksum.
    """

    def sum_of(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())

    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    now = saved(pairs.distinct(), "edges")
    before, after = None, sum_of(now)
    while before != after:
        last, now = now, saved(_star(now), "edges")
        freed(last)
        before, after = after, sum_of(now)
    roots = now.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("component"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)


# DuckDB has no crc32. Its table of 256 steps, each eight shifts of a register, as two recursive tables.
CRC_TABLE = """
crc_steps AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS steps FROM crc_steps WHERE k = 8)
"""


def crc_sql(text: str, steps: str) -> str:
    """SQL: crc32 of a text's UTF-8 bytes; ``steps``: the list in ``crc_table``."""
    digits = f"hex(encode({text}))"
    numbers = f"list_transform(range(0, length({digits}) // 2), lambda k: ('0x' || substr({digits}, k * 2 + 1, 2))::BIGINT)"
    start = f"list_concat([4294967295::BIGINT], {numbers})"
    return f"xor(list_reduce({start}, lambda c, b: xor(c >> 8, {steps}[(xor(c, b) & 255) + 1])), 4294967295)"
