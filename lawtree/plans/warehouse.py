"""Stored tables: one folder per table, one subfolder per batch, visible once committed."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawtree import schema as S
from lawtree.operators import dims, validate

BATCHED = {
    "laws": S.LAWS,
    # pref_id is the partition column of the elements.
    "elements": T.StructType([*S.ELEMENTS.fields, S.LAWS["pref_id"]]),
    "strings": S.STRINGS,
    "string_edges": S.STRING_EDGES,
    "errors": S.ERRORS,
    "outcomes": S.OUTCOMES,
}
DIMENSIONS = {"prefectures": S.PREFECTURES, "municipalities": S.MUNICIPALITIES}
# The column that single rows are looked up by.
LOOKED_UP = {"laws": "law_id", "elements": "law_id", "string_edges": "law_id", "strings": "string_id"}
_BATCH = T.StructField("batch_id", T.StringType())


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that Spark knows to be empty: joins with it vanish, and no Python worker starts for it."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).select(*columns).where(F.lit(False))


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def reset(self) -> Warehouse:
        """Drop and recreate all tables. Tables that are missing read as empty without this."""
        for name, schema in DIMENSIONS.items():
            no_rows(self.spark, schema).write.mode("overwrite").parquet(self._path(name))
        for name, schema in {**BATCHED, "manifest": S.MANIFEST}.items():
            full = T.StructType([*(f for f in schema if f.name != "batch_id"), _BATCH])
            empty = no_rows(self.spark, full)
            # Partitioned, so that an empty table has a folder and no file.
            empty.write.mode("overwrite").partitionBy("batch_id").parquet(self._path(name))
        return self

    def _read(self, schema: T.StructType, path: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return no_rows(self.spark, schema)

    def _path(self, name: str, batch_id: str | None = None) -> str:
        return f"{self.root}/{name}" + (f"/batch_id={batch_id}" if batch_id else "")

    def committed(self) -> DataFrame:
        return self._read(S.MANIFEST, self._path("manifest"))

    def batches(self) -> dict[str, list[str]]:
        """Tables per committed batch: one entry per run since the tables were compacted."""
        rows = self.committed().collect()
        replaced = {b for row in rows for b in row.replaces or ()}
        return {row.batch_id: row.tables for row in rows if row.batch_id not in replaced}

    def committed_ids(self) -> set[str]:
        """Every batch that was ever committed, compacted ones included."""
        rows = self.committed().collect()
        return {row.batch_id for row in rows}.union(*(row.replaces or () for row in rows))

    def commit(self, batch_id: str, tables: Iterable[str], replaces: Iterable[str] = ()) -> None:
        """Make these tables of a batch visible, with the last write of the batch.

        Batches that it ``replaces`` vanish with the same write.
        """
        row = self.spark.range(1).select(
            F.array(*map(F.lit, tables)).alias("tables"), F.current_timestamp().alias("committed_at"),
            F.array(*map(F.lit, replaces)).cast("array<string>").alias("replaces"),
        )
        row.write.mode("overwrite").parquet(self._path("manifest", batch_id))

    def compact(self, batch_id: str, only: Iterable[str] | None = None) -> None:
        """Rewrite all batches, or ``only`` those, as one. Of their outcomes only the latest of each file is kept."""
        chosen = None if only is None else set(only)
        batches = {b: tables for b, tables in self.batches().items() if chosen is None or b in chosen}
        tables = sorted({t for names in batches.values() for t in names})
        for name in tables:
            rows = self.file_states(batches) if name == "outcomes" else self.table(name, batches)
            self.write(name, batch_id, rows)
        # Ids stay known, so that a batch that comes again is not run again.
        replaced = [row for row in self.committed().collect() if row.batch_id in batches]
        before = {b for row in replaced for b in (row.batch_id, *(row.replaces or ()))}
        self.commit(batch_id, tables, sorted(before))

    def vacuum(self) -> None:
        """Delete what compaction has replaced. Readers that began before it lose their files."""
        visible, jvm = self.batches(), self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for row in self.committed().collect():
            if row.batch_id not in visible:
                for name in (*row.tables, "manifest"):
                    path = jvm.org.apache.hadoop.fs.Path(self._path(name, row.batch_id))
                    path.getFileSystem(conf).delete(path, True)

    def file_states(self, batches: dict[str, list[str]] | None = None) -> DataFrame:
        """The latest outcome of each file, one ``OUTCOMES`` row per path."""
        columns = S.OUTCOMES.fieldNames()
        latest = F.max_by(F.struct(*columns), F.struct("decided_at", "outcome")).alias("latest")
        return self.table("outcomes", batches).groupBy("path").agg(latest).select("latest.*")

    def write(self, name: str, batch_id: str, rows: DataFrame, mode: str = "overwrite") -> None:
        """Write one batch of a table; a batch that is run again replaces its own folder."""
        rows = rows.select(*BATCHED[name].fieldNames())
        writer = rows.write.mode(mode)
        if name == "elements":
            # Even-sized files per prefecture: a large prefecture is split, small ones share.
            packed = rows.hint("rebalance", "pref_id")
            ordered = packed.sortWithinPartitions("pref_id", "law_id", "ord")
            writer = ordered.write.mode(mode).partitionBy("pref_id")
        elif name in LOOKED_UP:
            writer = rows.sortWithinPartitions(LOOKED_UP[name]).write.mode(mode)
        if name in LOOKED_UP:
            # Looking up one id skips every row group that its filter rules out.
            writer = writer.option(f"parquet.bloom.filter.enabled#{LOOKED_UP[name]}", "true")
        writer.parquet(self._path(name, batch_id))

    def batch(self, name: str, batch_id: str) -> DataFrame:
        """One batch as written, committed or not."""
        return self._read(BATCHED[name], self._path(name, batch_id))

    def table(self, name: str, batches: dict[str, list[str]] | None = None) -> DataFrame:
        """Rows of all committed batches (or of those given), or a dimension table.

        The manifest names the folders to scan, so reading takes no join and keeps every
        pushed-down filter.
        """
        if name in DIMENSIONS:
            return self._read(DIMENSIONS[name], self._path(name))
        batches = self.batches() if batches is None else batches
        folders = [self._path(name, b) for b, tables in sorted(batches.items()) if name in tables]
        if not folders:
            return no_rows(self.spark, BATCHED[name])
        reader = self.spark.read.schema(BATCHED[name]).option("basePath", self._path(name))
        return reader.parquet(*folders).select(*BATCHED[name].fieldNames())

    def load_dimensions(self, rows: DataFrame) -> None:
        """Replace both dimension tables by ``(row_no, code, pref_name, muni_name)`` rows.

        All problems of a list that is refused are in the table ``dimension_problems``.
        """
        tables = {"prefectures": dims.prefectures(rows), "municipalities": dims.municipalities(rows)}
        problems = dims.check(**tables)
        if not problems.isEmpty():
            problems.write.mode("overwrite").parquet(self._path("dimension_problems"))
            # One row per kind of problem and table, whatever the length of the list.
            kinds = problems.select("table_name", "problem").distinct().orderBy("table_name", "problem").collect()
            named = ", ".join(f"{k.table_name}: {k.problem}" for k in kinds)
            raise ValueError(f"municipality list: {named}; all problems in {self._path('dimension_problems')}")
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(self._path(name))

    def check(self) -> DataFrame:
        """Broken keys and references over all tables, as rows ``(problem, value)``.

        Registration keeps tables free of them; this verifies it.
        """
        laws, elements = self.table("laws"), self.table("elements")
        strings, edges = self.table("strings"), self.table("string_edges")
        numbered = elements.where(F.col("etype") != "SupplProvision")
        keys = [
            ("laws", laws, ["law_id"]),
            ("laws", laws, ["muni_id", "num"]),
            ("elements", elements, ["law_id", "elem_id"]),
            ("elements", numbered, ["law_id", "parent_id", "etype", "num"]),
            ("strings", strings, ["string_id"]),
            ("strings", strings, ["string"]),
            ("string_edges", edges, ["law_id", "elem_id", "sentence_num"]),
        ]
        references = [
            ("elements", elements, "law_id", laws, "law_id"),
            ("string_edges", edges, "string_id", strings, "string_id"),
            ("laws", laws, "muni_id", self.table("municipalities"), "muni_id"),
        ]
        found = [
            validate.key_violations(rows, *key).select(
                F.lit(f"{table}: several rows per {', '.join(key)}").alias("problem"),
                F.to_json(F.struct(*key)).alias("value"),
            )
            for table, rows, key in keys
        ] + [
            validate.reference_violations(rows, key, referred, referred_key).select(
                F.lit(f"{table}: unknown {key}").alias("problem"),
                F.to_json(F.struct(key)).alias("value"),
            )
            for table, rows, key, referred, referred_key in references
        ]
        return reduce(DataFrame.unionByName, found)
