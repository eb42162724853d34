"""Exact top-k inner products by MaxScore over shards of postings.

A vector is a document, a component a term: the postings of a term hold the vectors in which it
is not zero, with their signed integer weights. A query takes its terms in the order of the most
that each can add to a score in a shard. As long as the weakest ones together cannot reach the
current k-th score they are non-essential: only postings of the others are traversed, and the
vectors found there are looked up in the weak terms one by one while they can still compete.
A task carries the k-th scores of its queries from shard to shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lawtree.llm.common import saved, table
from lawtree.llm.vectors import block_count, packed, usable

K = 5
SHARD = 4096
QUERIES = 512
SEEDS = 32
STRIP = 32  # queries that traverse a shard together
LOOKUPS = 2  # weak terms looked up before vectors are dropped
EXACT = 2.0**53  # whole numbers below are exact as doubles
TOGETHER = 8  # blocks of queries that meet a shard in one task, at least


class Shard:
    """Postings of the vectors of one block: a column for each term, with a place for every vector."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, weights: np.ndarray):
        order = np.lexsort((rows, ids))
        self.rows, self.ids, self.columns = rows[order], ids[order], np.ascontiguousarray(weights[order].T)
        self.doubles = self.columns.astype(np.float64)
        self.most = self.columns.max(axis=1, initial=0)
        self.least = self.columns.min(axis=1, initial=0)
        self.largest = np.abs(self.doubles).max(axis=1, initial=0)
        ranks = np.argsort(self.columns, axis=1)
        self.lowest, self.highest = ranks[:, :SEEDS], ranks[:, -SEEDS:]

    def search(
        self, queries: np.ndarray, own: np.ndarray, k: int, reached: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query, place, position, score) of the k best for each query, ties to the smaller id.

        The row ``own`` of a query is left out, and what is below the score that it has ``reached`` k times elsewhere.
        """
        width = min(queries.shape[1], len(self.columns))
        queries = queries[:, :width]
        exact = (np.abs(queries.astype(np.float64)) @ self.largest[:width]).max(initial=0) < EXACT
        columns = (self.doubles if exact else self.columns)[:width]
        queries = queries.astype(columns.dtype)
        bounds = np.maximum(np.maximum(queries * self.most[:width], queries * self.least[:width]), 0)
        terms = np.argsort(bounds, axis=1, kind="stable")
        reach = np.zeros((len(queries), width + 1), columns.dtype)  # what the first terms can add
        np.cumsum(np.take_along_axis(bounds, terms, 1), axis=1, out=reach[:, 1:])
        floor = np.full(len(queries), -np.inf)
        if exact and width:
            floor = np.maximum(reached, self._floor(queries, columns, terms[:, -1], own, k))
        weak = (reach[:, 1:] < floor[:, None]).sum(axis=1)
        strong = np.argsort(terms, axis=1) >= weak[:, None]
        some = strong.any(axis=0)
        sums = np.where(strong, queries, 0)[:, some] @ columns[some]
        needs = floor[:, None] - reach  # to be able to reach the floor by the first terms
        able = (sums >= np.take_along_axis(needs, weak[:, None], 1)) & (self.rows != own[:, None])
        out = [[np.zeros(0, np.int64)] for _ in range(4)]
        for j in range(len(queries)):
            found = np.flatnonzero(able[j])
            scores = sums[j].take(found)
            for at in range(weak[j] - 1, -1, -1):
                scores += queries[j, terms[j, at]] * columns[terms[j, at]].take(found)
                if at % LOOKUPS == 0:
                    left = np.flatnonzero(scores >= needs[j, at])
                    found, scores = found.take(left), scores.take(left)
            if len(found) > k:
                left = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
                found, scores = found.take(left), scores.take(left)
            order = np.lexsort((found, -scores))[:k]  # positions are in the order of ids
            values = (np.full(len(order), j), np.arange(len(order)), found[order], scores[order].astype(np.int64))
            for column, value in zip(out, values):
                column.append(value)
        return tuple(np.concatenate(column) for column in out)

    def _floor(self, queries: np.ndarray, columns: np.ndarray, top: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
        """A k-th score that is surely reached: that of some vectors that are high in the top term."""
        up = queries[np.arange(len(queries)), top] > 0
        seeds = np.where(up[:, None], self.highest[top], self.lowest[top])
        if seeds.shape[1] < k:
            return np.full(len(queries), -np.inf)
        scores = np.einsum("dgs,gd->gs", columns[:, seeds], queries)
        scores[self.rows[seeds] == own[:, None]] = -np.inf
        return np.partition(scores, -k, axis=1)[:, -k]


def _matrix(rows: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids and weights; a shorter vector has zeros at its end."""
    vectors = rows.field("weights")
    sizes = np.diff(vectors.offsets.to_numpy())
    weights = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    weights[np.arange(weights.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    number, ids = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("row", "vec_id"))
    return number, ids, weights


def _searcher(k: int):
    def run(batches):
        held, shard, tops = None, None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                if (number := batch.column("block")[i].as_py()) != held:
                    held, shard = number, Shard(*_matrix(batch.column("rows")[i].values))
                rows, ids, weights = _matrix(batch.column("queries")[i].values)
                # The k best scores of each query in the shards that this task has seen.
                top = tops.setdefault(batch.column("asked")[i].as_py(), np.full((len(rows), k), -np.inf))
                out = [[], [], [], []]
                for start in range(0, len(rows), STRIP):
                    part = slice(start, start + STRIP)
                    query, place, best, scores = shard.search(weights[part], rows[part], k, top[part, 0])
                    here = np.full((len(rows[part]), k), -np.inf)
                    here[query, place] = scores
                    top[part] = np.sort(np.concatenate([top[part], here], axis=1), axis=1)[:, -k:]
                    for column, values in zip(out, (rows[part][query], ids[part][query], shard.ids[best], scores)):
                        column.append(values)
                columns = [pa.array(np.concatenate(c)) for c in out]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, is_query: Column, k: int = K, shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """The k best (query_id, rank, vec_id, score) of each query among all other rows.

    ``vectors`` has vec_id and weights, an array of integers. A query is a row; rows that repeat
    an id or a vector are queries and candidates of their own. Vectors of different lengths
    meet in the components that both have. A query without any candidate gives no row.
    """
    rows = saved(
        vectors.select("vec_id", "weights").withColumn("row", F.monotonically_increasing_id()), "weights"
    )
    asked = rows.where(is_query)
    shards, blocks = block_count(rows.count(), shard), block_count(asked.count(), queries)
    shard_rows = packed(rows, shards, F.col("row"), "row", "vec_id", "weights")
    query_rows = packed(asked, blocks, F.col("row"), "row", "vec_id", "weights").select(
        F.col("block").alias("asked"), F.col("rows").alias("queries")
    )
    # A copy of the queries for each shard would be written, or broadcast: Spark counts the copies as one. A product of
    # partitions reads them again instead, shard by shard; by the hint whatever sizes are estimated.
    every = query_rows.coalesce(block_count(blocks, TOGETHER)).hint("shuffle_replicate_nl")
    found = shard_rows.crossJoin(every).mapInArrow(_searcher(k), "row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op1_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose vec_id is divisible by 50 against all rows. A null id is no query or candidate."""
    vectors = table(spark, folder, "embeddings").where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    weights = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    return search(vectors.select("vec_id", weights.alias("weights")), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS e FROM embeddings
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""
