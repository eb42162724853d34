"""Near-duplicate vectors: int8 tile products decide most pairs, full precision the rest.

Equal vectors are one row with a count. Distinct vectors are dealt into blocks of bounded
size; a tile is a pair of blocks. In a tile every vector x is split into s*q + e, q in int8 and
e the known rest. For two vectors of length one

    |x.y - s_x s_y q_x.q_y|  <=  |s_x q_x| |e_y| + |e_x|

so the integer product alone accepts or refuses all pairs outside that margin; the remaining
ones are computed again in double precision. A tile returns link counts and a spanning forest
of its links, at most one row for each of its vectors, however many pairs are linked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree.llm.common import components, saved, table
from lawtree.llm.vectors import block_count, packed, usable

THRESHOLD = 0.9
BLOCK = 4096
STRIP = 256
# Integer products of so many components are exact in single precision: 1024 * 127 * 127 < 2**24.
SLAB = 1024
SLACK = 1e-6


class Quantised:
    """Unit vectors, their int8 form and the length of what that leaves out."""

    def __init__(self, vectors: np.ndarray):
        # A power of two brings the largest component near one: squares of very large and small ones stay finite.
        _, exponents = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
        vectors = np.ldexp(vectors, -exponents)
        self.unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.scale = np.abs(self.unit).max(axis=1) / 127
        self.codes = np.rint(self.unit / self.scale[:, None]).astype(np.int8)
        approx = self.codes * self.scale[:, None]
        self.length = np.linalg.norm(approx, axis=1)
        self.error = np.linalg.norm(self.unit - approx, axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of two int8 matrices."""
    parts = [
        a[:, i:i + SLAB].astype(np.float32) @ b[:, i:i + SLAB].astype(np.float32).T
        for i in range(0, a.shape[1], SLAB)
    ]
    return parts[0] if len(parts) == 1 else sum(p.astype(np.float64) for p in parts)


def strip_links(a: Quantised, b: Quantised, rows: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked (row, column) pairs of a strip of ``a`` with all of ``b``."""
    scaled = products(a.codes[rows], b.codes)
    scaled *= a.scale[rows, None]
    scaled *= b.scale[None, :]
    widest = float(a.length[rows].max() * b.error.max() + a.error[rows].max()) + SLACK
    i, j = np.nonzero(scaled >= threshold - widest)
    near, i = scaled[i, j].astype(np.float64), i + rows.start
    margin = a.length[i] * b.error[j] + a.error[i] + SLACK
    linked = near - margin >= threshold
    unsure = np.nonzero(~linked & (near + margin >= threshold))[0]
    for part in np.array_split(unsure, max(1, len(unsure) // 65536 + 1)):
        linked[part] = np.einsum("ij,ij->i", a.unit[i[part]], b.unit[j[part]]) >= threshold
    return i[linked], j[linked]


def root(parents: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    up = parents[nodes]
    while (parents[up] != up).any():
        up = parents[up]
    parents[nodes] = up
    return up


def tile(ids_a, mult_a, a, ids_b, mult_b, b, same: bool, threshold: float):
    """(node, links, root) of every vector of a tile that has a link in it."""
    a, b = Quantised(a), Quantised(b)
    n = len(ids_a)
    offset = 0 if same else n
    nodes = ids_a if same else np.concatenate([ids_a, ids_b])
    links, parents = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    for start in range(0, n, STRIP):
        i, j = strip_links(a, b, slice(start, min(n, start + STRIP)), threshold)
        if same:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        np.add.at(links, i, mult_b[j])
        np.add.at(links, j + offset, mult_a[i])
        for row, others in zip(*_groups(i, j + offset)):
            roots = root(parents, np.append(others, row))
            parents[roots] = roots.min()
    touched = np.nonzero(links)[0]
    return nodes[touched], links[touched], nodes[root(parents, touched)]


def _groups(i: np.ndarray, j: np.ndarray):
    """Rows, which come in order, and the columns of each."""
    rows, first = np.unique(i, return_index=True)
    return rows, np.split(j, first[1:])


def _block(rows: pa.StructArray) -> tuple:
    values = rows.field("embedding")
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ids = rows.field("node").to_numpy(zero_copy_only=False)
    return ids, rows.field("mult").to_numpy(zero_copy_only=False), flat.reshape(len(ids), -1)


def _tiles(threshold: float):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                left = _block(batch.column("left")[k].values)
                right = _block(batch.column("right")[k].values)
                same = batch.column("i")[k].as_py() == batch.column("j")[k].as_py()
                out = tile(*left, *right, same, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["node", "links", "root"])

    return run


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id`` and ``kept``.

    Every row counts as a vector of its own, so rows that repeat an id or a vector link with
    each other. Vectors that are null, zero, empty or hold null or non-finite components link
    with nothing, nor do vectors of different length. An empty table gives no rows; other
    columns are ignored. A null id is never the component of a vector that reaches another id.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    linkable = usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("embedding", F.when(linkable, F.col("embedding")))
    distinct = saved(
        rows.where("embedding IS NOT NULL")
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult"))
        .withColumns({"node": F.monotonically_increasing_id(), "size": F.size("embedding")}),
        "vectors",
    )
    sizes = [r[0] for r in distinct.select("size").distinct().collect()]
    found = None
    for size in sizes:
        part = distinct.where(F.col("size") == size)
        blocks = block_count(part.count(), block)
        packs = packed(part, blocks, F.col("node"), "node", "mult", "embedding")
        left = packs.select(
            F.col("block").alias("i"), F.explode(F.expr(f"sequence(block, {blocks - 1}L)")).alias("j"),
            F.col("rows").alias("left"),
        )
        right = packs.select(
            F.explode(F.expr("sequence(0L, block)")).alias("i"), F.col("block").alias("j"),
            F.col("rows").alias("right"),
        )
        some = left.join(right, ["i", "j"]).mapInArrow(_tiles(threshold), "node long, links long, root long")
        found = some if found is None else found.unionByName(some)
    if found is None:
        spark = vectors.sparkSession
        found = spark.createDataFrame([], "node long, links long, root long")
    found = saved(found, "tiles")
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    members = distinct.select("embedding", "node", "mult", "rep").join(groups, "node", "left")
    members = members.withColumn("component", F.coalesce("component", "node"))
    least = members.groupBy("component").agg(F.min("rep").alias("least"))
    known = members.join(links, "node", "left").join(least, "component").select(
        "embedding", "least", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links")
    )
    component = F.coalesce("least", "vec_id")
    return rows.join(known, "embedding", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def op10_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, [x::DOUBLE for x in embedding] AS e FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.9
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM comp LEFT JOIN n USING (vec_id)
"""
