"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into chunks of CHUNK bytes that overlap by WIDTH - 1, so every window of WIDTH
bytes of the whole text lies in a chunk. Learned filters slide over each chunk and are max-pooled
in it; over the chunks of a document the pooled values are combined as mean, maximum and minimum
(a repeated passage gives few different windows, hence low maxima) and a dense layer returns one
probability. Filters work on single bytes, so a filter is a table of 256 values per position.

Training uses a bounded sample: SAMPLE labelled documents, PIECES chunks spread over each. Scoring
reads all bytes of all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree.llm.common import held_out, table

WIDTH = 6
FILTERS = 24
CHUNK = 512
STEP = CHUNK - WIDTH + 1
# Chunks convolved at once: bounds the memory of a long document.
AT_ONCE = 32

SAMPLE = 3000
PIECES = 10
# Batches of training, whatever the size of the sample.
STEPS = 900
BATCH = 32
RATE = 0.01
THRESHOLD = 0.3
FOLDS = 5


def chunks(data: bytes) -> np.ndarray:
    """Overlapping chunks of a text, zero-padded at its end; an empty text is one empty chunk."""
    n = max(1, -(-max(0, len(data) - WIDTH + 1) // STEP))
    padded = np.zeros(n * STEP + WIDTH - 1, np.uint8)
    padded[:len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


class Network:
    def __init__(self, filters: np.ndarray, bias: np.ndarray, dense: np.ndarray, offset: float):
        self.filters, self.bias, self.dense, self.offset = filters, bias, dense, offset
        self._pairs = None

    @classmethod
    def initial(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        filters = rng.normal(0, 0.4, (WIDTH, 256, FILTERS)).astype(np.float32)
        dense = rng.normal(0, 0.1, 3 * FILTERS).astype(np.float32)
        return cls(filters, np.zeros(FILTERS, np.float32), dense, 0.0)

    def __getstate__(self):
        return self.filters, self.bias, self.dense, self.offset

    def __setstate__(self, state):
        self.__init__(*state)

    def convolved(self, part: np.ndarray) -> np.ndarray:
        """Filter values (chunk, position, filter); two neighbouring bytes are one table lookup."""
        if self._pairs is None:
            first, second = self.filters[0::2], self.filters[1::2]
            self._pairs = (first[:, :, None, :] + second[:, None, :, :]).reshape(WIDTH // 2, 65536, FILTERS)
        pair = part[:, :-1].astype(np.uint16) << 8 | part[:, 1:]
        out = self._pairs[0][pair[:, :STEP]]
        for k in range(1, WIDTH // 2):
            out += self._pairs[k][pair[:, 2 * k:2 * k + STEP]]
        return out

    def pooled(self, pieces: np.ndarray, where: bool = False):
        """Largest value of each filter in each chunk, after tanh; ``where``: its position too."""
        top, at = [], []
        for start in range(0, len(pieces), AT_ONCE):
            values = self.convolved(pieces[start:start + AT_ONCE])
            if where:
                at.append(values.argmax(axis=1))
                top.append(np.take_along_axis(values, at[-1][:, None], axis=1)[:, 0])
            else:
                top.append(values.max(axis=1))
        top = np.tanh(np.concatenate(top) + self.bias)
        return (top, np.concatenate(at)) if where else top

    def probability(self, data: bytes) -> float:
        top = self.pooled(chunks(data))
        features = np.concatenate([top.mean(axis=0), top.max(axis=0), top.min(axis=0)])
        return float(1 / (1 + np.exp(-(features.astype(np.float64) @ self.dense + self.offset))))


class Adam:
    def __init__(self, *shapes):
        self.moments = [(np.zeros(s, np.float32), np.zeros(s, np.float32)) for s in shapes]
        self.step = 0

    def steps(self, gradients, rate: float):
        self.step += 1
        for (m, v), g in zip(self.moments, gradients):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            yield rate * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.99 ** self.step)) + 1e-6)


def train(samples: list[tuple[np.ndarray, int]], steps: int = STEPS, batch: int = BATCH) -> Network:
    """Fit a network to (chunks, label) pairs; deterministic. Without pairs the initial one."""
    net, rng = Network.initial(), np.random.default_rng(11)
    if not samples:
        return net
    share = (sum(y for _, y in samples) + 1) / (len(samples) + 2)
    net.offset = float(np.log(share / (1 - share)))
    adam = Adam(net.filters.shape, net.bias.shape, net.dense.shape, ())
    epochs = -(-steps * batch // len(samples))
    for epoch in range(epochs):
        order = rng.permutation(len(samples))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs)) + 1e-4
        for start in range(0, len(order), batch):
            some = [samples[i] for i in order[start:start + batch]]
            pieces = np.concatenate([c for c, _ in some])
            sizes = np.array([len(c) for c, _ in some])
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            label = np.array([y for _, y in some], np.float32)
            net._pairs = None
            top, at = _single(net, pieces)
            mean = np.add.reduceat(top, first) / sizes[:, None]
            high, low = np.maximum.reduceat(top, first), np.minimum.reduceat(top, first)
            features = np.concatenate([mean, high, low], axis=1)
            error = (1 / (1 + np.exp(-(features @ net.dense + net.offset))) - label) / len(some)
            back = error[:, None] * net.dense
            doc = np.repeat(np.arange(len(some)), sizes)
            by_mean, by_high, by_low = back[:, :FILTERS], back[:, FILTERS:2 * FILTERS], back[:, 2 * FILTERS:]
            to_top = (by_mean / sizes[:, None])[doc]
            to_top = to_top + (top == high[doc]) * by_high[doc] + (top == low[doc]) * by_low[doc]
            to_value = to_top * (1 - top * top)
            to_filters = np.zeros_like(net.filters)
            row, column = np.arange(len(pieces))[:, None], np.arange(FILTERS)[None, :]
            for k in range(WIDTH):
                np.add.at(to_filters[k], (pieces[row, at + k], np.broadcast_to(column, at.shape)), to_value)
            gradients = [
                to_filters + 1e-5 * net.filters, to_value.sum(axis=0), error @ features + 1e-4 * net.dense,
                np.float32(error.sum()),
            ]
            moves = list(adam.steps(gradients, rate))
            net.filters -= moves[0]
            net.bias -= moves[1]
            net.dense -= moves[2]
            net.offset -= float(moves[3])
    net._pairs = None
    return net


def _single(net: Network, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``pooled`` with positions, without the pair tables, which each training step would change."""
    tops, ats = [], []
    for start in range(0, len(pieces), AT_ONCE):
        part = pieces[start:start + AT_ONCE]
        values = net.filters[0][part[:, :STEP]]
        for k in range(1, WIDTH):
            values += net.filters[k][part[:, k:k + STEP]]
        at = values.argmax(axis=1)
        ats.append(at)
        tops.append(np.take_along_axis(values, at[:, None], axis=1)[:, 0])
    return np.tanh(np.concatenate(tops) + net.bias), np.concatenate(ats)


def _sampled(batches):
    """(pieces, label) of labelled documents: PIECES chunks spread evenly over each."""
    for batch in batches:
        out = []
        for text in batch.column("text"):
            pieces = chunks((text.as_py() or "").encode())
            take = np.unique(np.linspace(0, len(pieces) - 1, min(PIECES, len(pieces))).astype(int))
            out.append(np.ascontiguousarray(pieces[take]).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column("label")], names=["pieces", "label"])


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    """Train on at most ``sample`` labelled documents (doc_id, label), chosen by a hash of the id.

    Null ids and labels take no part. The sample, bounded in rows and in chunks of each, is the
    only text that comes to the driver.
    """
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(
        F.max("label").cast("int").alias("label")
    )
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(some), "doc_id")  # at most ``sample`` rows of two numbers
        .select("text", "label")
        .mapInArrow(_sampled, "pieces binary, label int")
        .orderBy(F.xxhash64("pieces"))
        .limit(2 * sample)  # rows that repeat an id may add some
        .collect()
    )
    return train([(np.frombuffer(r.pieces, np.uint8).reshape(-1, CHUNK), int(r.label == 1)) for r in rows])


def _scorer(net: Network):
    def run(batches):
        for batch in batches:
            scores = [net.probability((t.as_py() or "").encode()) for t in batch.column("text")]
            rest = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(scores, pa.float64())], names=[*rest.schema.names, "score"])

    return run


def score(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, score) of every row of ``docs``: the probability of label 1 for its whole text.

    A null text scores like an empty one. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scorer(net), "doc_id long, score double")


def quality_model(spark: SparkSession, folder: str, docs: DataFrame) -> Network:
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return fitted(docs, labels.where(~held_out(F.col("doc_id"), FOLDS, 0)))


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = score(docs, quality_model(spark, folder, docs))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def _filter(net: Network, at: int):
    def run(batches):
        for batch in batches:
            keep = [net.probability((t.as_py() or "").encode()) >= THRESHOLD for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier accepts, with all their columns; one pass over the texts."""
    net = quality_model(spark, folder, docs)
    return docs.mapInArrow(_filter(net, docs.columns.index("text")), docs.schema)
