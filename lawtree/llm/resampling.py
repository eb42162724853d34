"""Importance resampling towards a target distribution, weighed by bit-sliced aggregation.

Words, or runs of them, are hashed into buckets. A bucket's gain is the logarithm of how much more
often the target's features fall into it than the corpus', as a whole number of thousandths. A
document's weight is the mean gain of its features. The sum behind it is bit-sliced: the counts of a
document become planes of one bit per bucket, one plane for each binary digit; so do the gains, apart
by sign. The digits of two planes meet where their AND has a bit, so its population count times the
power of two of both digits, summed over all pairs of planes, is the exact sum.

Documents are drawn without replacement: a Gumbel number made of a hash of the id is added to the
weight and the highest sums win. Places in that order come from a range partitioning, not from one task.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree.llm.common import CRC_TABLE, crc_sql, numbered, saved, table

BUCKETS = 10_000
NGRAMS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Features whose bucket a task remembers before it starts anew; this saves time only.
REMEMBERED = 200_000

# Bytes of words: digits, letters and everything beyond ASCII; A-Z in lower case, all others part words.
KEPT = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


class Features:
    """Buckets of the features of texts: all runs of 1 to ``ngrams`` words."""

    def __init__(self, buckets: int = BUCKETS, ngrams: int = NGRAMS):
        self.buckets, self.ngrams, self.known = buckets, ngrams, {}

    def _bucket(self, feature: bytes) -> int:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = self.known[feature] = zlib.crc32(feature) % self.buckets
        return found

    def of(self, text: bytes | None) -> tuple[int, np.ndarray]:
        """(number of words, the bucket of each feature)."""
        words = text.translate(KEPT).split() if text else []
        features = list(words)
        for n in range(2, self.ngrams + 1):
            features += [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
        known, bucket = self.known.get, self._bucket
        found = [b if (b := known(f)) is not None else bucket(f) for f in features]
        return len(words), np.array(found, np.int64)


def bit_planes(index: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """One row of bits for each binary digit of the non-negative ``values`` at places ``index``, as uint64."""
    digits = int(values.max()).bit_length() if len(values) else 0
    bits = np.zeros((digits, -(-width // 64) * 64), np.uint8)
    bits[:, index] = values >> np.arange(digits)[:, None] & 1
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


class Gains:
    """Signed planes of the gains, to be multiplied by the planes of counts."""

    def __init__(self, gains: list[int]):
        self.width = len(gains)
        values = np.array(gains, np.int64)
        every = np.arange(self.width)
        up, down = (bit_planes(every, np.maximum(sign * values, 0), self.width) for sign in (1, -1))
        self.planes = np.concatenate([up, down])
        self.powers = np.array([1 << k for k in range(len(up))] + [-(1 << k) for k in range(len(down))], np.int64)

    def total(self, buckets: np.ndarray) -> int:
        """Sum of the gains of all features, each given by its bucket."""
        index, counts = np.unique(buckets, return_counts=True)
        planes = bit_planes(index, counts, self.width)
        common = np.bitwise_count(planes[:, None] & self.planes).sum(axis=2, dtype=np.int64)
        return int((common @ self.powers) @ (1 << np.arange(len(planes), dtype=np.int64)))


def _counts(buckets: int, ngrams: int):
    def run(batches):
        features, total = Features(buckets, ngrams), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total += np.bincount(features.of(text)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, ngrams: int = NGRAMS) -> list[int]:
    """Features of all of ``docs`` in each bucket. Each task adds up its own; the driver gets ``buckets`` numbers."""
    rows = docs.select(F.col("text").cast("string").cast("binary").alias("text"))
    parts = rows.mapInArrow(_counts(buckets, ngrams), "bucket long, n long")
    out = [0] * buckets
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandths of the natural logarithm of target share by source share, each count one higher."""
    buckets = len(source)
    s_all, t_all = float(sum(source) + buckets), float(sum(target) + buckets)
    return [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source, target)]


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel number made of a hash of the id; a null id counts as no digits."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weights(values: list[int], ngrams: int, seed: int):
    def run(batches):
        features, model = Features(len(values), ngrams), Gains(values)
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), []
            for doc_id, text in zip(ids, batch.column("text").to_pylist()):
                n_words, buckets = features.of(text)
                weight = model.total(buckets) // len(buckets) if len(buckets) else 0
                rows.append((n_words, len(buckets), weight, weight + gumbel(doc_id, seed)))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), *columns],
                names=["doc_id", "row", "n_words", "n_features", "weight", "score"],
            )

    return run


def weighed(
    docs: DataFrame, target: DataFrame, *, buckets: int = BUCKETS, ngrams: int = NGRAMS, seed: int = SEED
) -> DataFrame:
    """(doc_id, row, n_words, n_features, weight, score) of every row of ``docs``; ``row``: a hash of its columns.

    ``target`` has the texts that the draw should resemble. Null and empty texts have no features and
    weight 0. An empty target leaves every gain to the corpus' own counts.
    """
    values = gains(bucket_counts(docs, buckets, ngrams), bucket_counts(target, buckets, ngrams))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(*docs.columns).alias("row"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    schema = "doc_id long, row long, n_words long, n_features long, weight long, score long"
    return rows.mapInArrow(_weights(values, ngrams, seed), schema)


def ranked(weights: DataFrame, *, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``weights`` with ``rank``: 1, 2, 3... for the drawn, by score, then smaller doc_id (null first).

    Of the documents with enough words so many percent are drawn, rounded down. Rows alike in doc_id
    and score go by their hash; copies of one row take neighbouring ranks.
    """
    weights = saved(weights, "weights")
    able = weights.where(F.col("n_words") >= least_words)
    placed = numbered(able.withColumn("down", -F.col("score")), [], ["down", "doc_id", "row"]).drop("down")
    rank = F.when(F.expr(f"idx < total * {percent} div 100"), F.col("idx") + 1)
    others = weights.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.select(*weights.columns, rank.cast("long").alias("rank")).unionByName(others)


def resample(docs: DataFrame, target: DataFrame, *, least_words: int = LEAST_WORDS, percent: int = PERCENT, **options) -> DataFrame:
    """The drawn rows of ``docs``, all columns as they are; a row that repeats is there as often as it is drawn."""
    drawn = ranked(weighed(docs, target, **options), least_words=least_words, percent=percent).where("rank IS NOT NULL")
    times = drawn.groupBy(F.col("doc_id").alias("__d"), F.col("row").alias("__r")).agg(F.count("*").cast("int").alias("__times"))
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__row": F.xxhash64(*docs.columns)})
    keyed = keyed.dropDuplicates(["__id", "__row"])
    joined = keyed.join(times, F.col("__id").eqNullSafe(F.col("__d")) & (F.col("__row") == F.col("__r")))
    repeated = joined.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return repeated.select(docs.columns)


def op13_target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its weight, score and rank, drawn towards the texts of ``benchmark``."""
    docs, target = (table(spark, folder, name) for name in ("documents", "benchmark"))
    return ranked(weighed(docs, target)).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = rf"""
WITH RECURSIVE {CRC_TABLE}, texts AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS (
  SELECT side, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts
), counted AS (SELECT side, id, word, count(*) AS n FROM words GROUP BY ALL
), hashed AS (
  SELECT word, ({crc_sql('word', 'steps')} % {BUCKETS})::BIGINT AS bucket
  FROM (SELECT DISTINCT word FROM counted), crc_table
), features AS (SELECT side, id, bucket, n FROM counted JOIN hashed USING (word)
), sums AS (
  SELECT b.bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t
  FROM (SELECT unnest(range({BUCKETS})) AS bucket) b LEFT JOIN features f ON f.bucket = b.bucket GROUP BY b.bucket
), alls AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums
), gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (s_all + {BUCKETS}) / ((s + 1) * (t_all + {BUCKETS}))))::BIGINT AS g FROM sums, alls
), weighed AS (
  SELECT id AS doc_id, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS gains
  FROM features JOIN gain USING (bucket) WHERE side = 0 GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features,
    coalesce((gains - ((gains % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT AS h
  FROM (SELECT doc_id FROM documents) LEFT JOIN weighed USING (doc_id)
), final AS (
  SELECT doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))))::BIGINT AS score FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {LEAST_WORDS} AND
  row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id)
  <= (SELECT count(*) FROM final WHERE n_features >= {LEAST_WORDS}) * {PERCENT} // 100
  THEN row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) END AS rank
FROM final
"""
