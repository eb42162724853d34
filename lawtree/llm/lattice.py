"""Language-model scoring by the likelihood of a subword lattice.

A word is a lattice: one arc spans it whole, with the share of the word in the training texts, and
arcs of an existing subword vocabulary, weighted by the vocabulary's scores, cover it in all
segmentations; one forward-backward pass over the training words adapts these weights. The forward recursion in log space adds up all paths, so a word has its marginal
probability however it is cut. A text is the product of its words and an end; texts are written in
one of several languages, each with word shares of its own, and the text's probability is the sum
over the languages, as its language is not known.

Words of the training texts are counted by Spark. The FREQUENT most common ones are a table of
bounded size that every task has; all others of a document meet their counts in a join.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree.llm.common import held_out, saved, table, words
from lawtree.llm.pieces import MARK, MODEL, vocabulary

FOLDS, FOLD = 7, 2
# Languages with word shares of their own; all further ones share the last.
CLASSES = 6
# Bounds of the table of common words: rows and bytes of a word.
FREQUENT, LONGEST = 100_000, 48
# Words counted in memory before they are handed on.
COUNTED = 400_000
# Before fitting: the probability that a word ends after a piece, and what is added to a piece's
# rank, so that shares fall with the rank as those of words do. KEPT: their part after fitting.
STOP, SHIFT, KEPT = 0.4, 10.0, 0.02
END = b""


def shares_of(entries: list[tuple[str, float, bool]]) -> tuple[dict[bytes, float], dict[bytes, float]]:
    """Weights of the pieces that begin a word, and of those that go on, from the vocabulary's scores.

    The scores are merge ranks below zero; a piece weighs in inverse proportion to its rank.
    """
    worst = max((-s for p, s, b in entries if p and not b and s > -1e8), default=0.0) + 1
    begin: dict[bytes, float] = {}
    inner: dict[bytes, float] = {}
    for piece, score, is_byte in entries:
        if is_byte:
            inner.setdefault(bytes([int(piece[3:5], 16)]), 1 / (worst + SHIFT))
        elif piece and score > -1e8 and MARK not in piece[1:]:
            (begin if piece[0] == MARK else inner)[piece.removeprefix(MARK).encode()] = 1 / (SHIFT - score)
    # The mark alone, which may be marked unusable, lets any character begin a word.
    begin.setdefault(b"", 1 / (worst + SHIFT))
    return begin, inner


class Lattice:
    """Tries of pieces as byte strings, with the log share of those that begin a word or go on."""

    def __init__(self, begin: dict[bytes, float], inner: dict[bytes, float], stop: float):
        self.begin = self._trie(begin, 1.0)
        self.inner = self._trie(inner, 1 - stop)
        self.stop = math.log(stop)

    @staticmethod
    def _trie(shares: dict[bytes, float], mass: float) -> dict:
        """Nested dicts by byte; key -1 holds the log share of the piece that ends there."""
        total, trie = sum(shares.values()), {}
        for text, share in shares.items():
            node = trie
            for byte in text:
                node = node.setdefault(byte, {})
            node[-1] = math.log(mass * share / total)
        return trie

    def arcs(self, word: bytes) -> tuple[list[list[tuple[int, float, float]]], list[float]]:
        """The forward recursion: arcs into each position, as (start, share, sum so far), and its log sums.

        Start -1 is the piece that begins the word; it may be empty.
        """
        n = len(word)
        into: list[list[tuple[int, float, float]]] = [[] for _ in range(n + 1)]
        node = self.begin
        if -1 in node:
            into[0].append((-1, node[-1], node[-1]))
        for end in range(n):
            if (node := node.get(word[end])) is None:
                break
            if -1 in node:
                into[end + 1].append((-1, node[-1], node[-1]))
        sums = [float("-inf")] * (n + 1)
        for start in range(n + 1):
            if not into[start]:
                continue
            here = sums[start] = _log_sum([a[2] for a in into[start]])
            node = self.inner
            for end in range(start, n):
                if (node := node.get(word[end])) is None:
                    break
                if -1 in node:
                    into[end + 1].append((start, node[-1], here + node[-1]))
        return into, sums

    def log_probability(self, word: bytes) -> float:
        """Natural log of the sum over all segmentations of the word."""
        return self.arcs(word)[1][-1] + self.stop

    def expect(self, word: bytes, begin: dict[bytes, float], inner: dict[bytes, float]) -> None:
        """Add the expected number of times that each piece is used in the word."""
        into, sums = self.arcs(word)
        if sums[-1] == float("-inf"):
            return
        share = [0.0] * len(sums)  # posterior probability that a path meets the position
        share[-1] = 1.0
        for end in range(len(word), -1, -1):
            if share[end] < 1e-6:
                continue
            for start, _, total in into[end]:
                weight = share[end] * math.exp(total - sums[end])
                if start < 0:
                    piece = word[:end]
                    begin[piece] = begin.get(piece, 0.0) + weight
                else:
                    piece = word[start:end]
                    inner[piece] = inner.get(piece, 0.0) + weight
                    share[start] += weight


def _log_sum(terms: list[float]) -> float:
    if len(terms) == 1:
        return terms[0]
    top = max(terms)
    return top + math.log(sum(math.exp(t - top) for t in terms))


def _counts(batches):
    """Partial (word, class, n) of training texts."""
    counters: dict[int, Counter] = {}

    def emit():
        for number, counter in counters.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(counter.keys(), pa.binary()), pa.array([number] * len(counter), pa.int32()),
                    pa.array(counter.values(), pa.int64()),
                ],
                names=["word", "class", "n"],
            )
        counters.clear()

    for batch in batches:
        for text, number in zip(batch.column("text"), batch.column("class")):
            counter = counters.setdefault(number.as_py(), Counter())
            counter.update(words(text.as_py()))
            counter[END] += 1
            if sum(map(len, counters.values())) > COUNTED:
                yield from emit()
    yield from emit()


def _expected(begin, inner):
    def run(batches):
        lattice, begins, inners = Lattice(begin, inner, STOP), {}, {}
        for batch in batches:
            for word in batch.column("word").to_pylist():
                if word != END:
                    lattice.expect(word, begins, inners)
        for first, counts in ((True, begins), (False, inners)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([first] * len(counts), pa.bool_()), pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.float64())],
                names=["first", "piece", "n"],
            )

    return run


def _class(languages: list[str]):
    number = F.lit(len(languages))
    for i, language in enumerate(languages):
        number = F.when(F.col("lang") == language, i).otherwise(number)
    return number.cast("int")


class Model:
    """Word counts of the training texts and what follows from them.

    ``counts``: (word, c, c0, c1, ...), the word's count in all texts and in those of each language.
    """

    def __init__(self, docs: DataFrame, entries: list):
        self.entries = entries
        train = docs.where(~F.col("held_out"))
        common = (
            train.where("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "lang").limit(CLASSES - 1).collect()
        )
        languages = [r.lang for r in common]
        self.classes = len(languages) + 1
        partial = train.select("text", _class(languages).alias("class")).mapInArrow(
            _counts, "word binary, class int, n long"
        )
        of = [F.sum(F.when(F.col("class") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(self.classes)]
        self.counts = saved(partial.groupBy("word").agg(F.sum("n").alias("c"), *of), "words")
        ks = range(self.classes)
        sums = self.counts.agg(
            F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
            *[F.coalesce(F.sum(f"c{k}"), F.lit(0)).alias(f"n{k}") for k in ks],
            *[F.count_if(F.col(f"c{k}") > 0).alias(f"v{k}") for k in ks],
            *[F.count_if(F.col(f"c{k}") == 1).alias(f"one{k}") for k in ks],
            *[F.count_if(F.col(f"c{k}") == 2).alias(f"two{k}") for k in ks],
            *[F.coalesce(F.max(F.when(F.col("word") == END, F.col(f"c{k}"))), F.lit(0)).alias(f"docs{k}") for k in ks],
        ).first()
        self.n, self.v = sums.n, sums.v
        # Absolute discounting: what each seen word gives up is the share of the subword paths.
        self.shares = []
        for k in ks:
            n, v, one, two, docs_k = (sums[f"{x}{k}"] for x in ("n", "v", "one", "two", "docs"))
            discount = min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.5
            paths = discount * v / n if n else 1.0
            self.shares.append((n, discount, paths, (docs_k + 1) / (sum(sums[f"docs{j}"] for j in ks) + self.classes)))

        self.lattice = self._fitted()

    def _fitted(self) -> tuple:
        """Shares of the pieces in the distinct training words, starting from the vocabulary's scores.

        One forward-backward pass. The vocabulary itself stays as it is; its size bounds what is collected.
        """
        given = shares_of(self.entries)
        rows = self.counts.select("word").mapInArrow(_expected(*given), "first boolean, piece binary, n double")
        found = rows.groupBy("first", "piece").agg(F.sum("n").alias("n")).collect()
        if not found:
            return *given, STOP
        fitted, totals = [], []
        for first, prior in zip((True, False), given):
            met = {bytes(r.piece): r.n for r in found if r["first"] == first}
            total, mass = sum(met.values()), sum(prior.values())
            totals.append(total)
            fitted.append({p: (1 - KEPT) * met.get(p, 0.0) / max(total, 1e-9) + KEPT * w / mass for p, w in prior.items()})
        return *fitted, min(0.9, max(0.1, totals[0] / sum(totals)))

    def rated(self, rows: DataFrame) -> DataFrame:
        """(word, c, base, logs) of rows with word and counts: log10 of the base and of each class."""
        rows = rows.select("word", *[F.coalesce(c, F.lit(0)).alias(c) for c in ["c"] + [f"c{k}" for k in range(self.classes)]])
        return rows.mapInArrow(_rater(self.lattice, self.shares, self.n, self.v), "word binary, c long, base double, logs array<double>")


def _rater(fitted, shares, n_all, v_all):
    def run(batches):
        lattice, ln10 = Lattice(*fitted), math.log(10)
        lowest = math.log(1e-300)
        for batch in batches:
            names = batch.column("word").to_pylist()
            c = batch.column("c").to_numpy()
            paths = np.array([lattice.log_probability(w) if w != END else lowest for w in names])
            logs = []
            for k, (n, discount, mass, _) in enumerate(shares):
                seen = np.maximum(batch.column(f"c{k}").to_numpy() - discount, 0) / max(1, n)
                with np.errstate(divide="ignore"):
                    logs.append(np.logaddexp(np.log(seen), math.log(mass) + paths) / ln10)
            base = np.log10((c + 1) / (n_all + v_all + 1))
            table_ = np.stack(logs, axis=1)
            offsets = pa.array(np.arange(len(names) + 1) * len(shares), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(base), pa.ListArray.from_arrays(offsets, pa.array(table_.ravel()))],
                names=["word", "c", "base", "logs"],
            )

    return run


def _documents(frequent: tuple):
    """Sums over the common words of each document, and its other words with their counts."""
    known, table_ = frequent

    def run(batches):
        index = {w: i for i, w in enumerate(known)}
        get = index.get
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                n_tokens, sums, rest, times, offsets = [], [], [], [], [0]
                for text in part.column("text"):
                    counter = Counter(words(text.as_py()))
                    counter[END] += 1
                    n_tokens.append(counter.total())
                    places = np.fromiter((get(w, -1) for w in counter), np.int64, len(counter))
                    n = np.fromiter(counter.values(), np.int64, len(counter))
                    common = places >= 0
                    sums.append(n[common] @ table_[places[common]])
                    if not common.all():
                        names = list(counter)
                        for i in np.nonzero(~common)[0]:
                            rest.append(names[i])
                        times.extend(n[~common].tolist())
                    offsets.append(len(rest))
                sums = np.array(sums)
                pairs = pa.StructArray.from_arrays([pa.array(rest, pa.binary()), pa.array(times, pa.int64())], ["word", "n"])
                logs = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sums) + 1) * (sums.shape[1] - 2), pa.int32()), pa.array(sums[:, 2:].ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("held_out"), pa.array(n_tokens, pa.int64()),
                        pa.array(sums[:, 0].astype(np.int64)), pa.array(sums[:, 1]), logs,
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "logs", "rest"],
                )

    return run


def score(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text, lang, held_out), learning from those not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score. ``lang`` is
    read of training texts only. Null texts count as empty: their one token is the end. Rows that
    repeat an id are texts of their own; other columns are ignored. Without training texts words
    are scored by their pieces alone.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"), "held_out",
    )
    model = Model(docs, vocabulary(model_path))
    top = model.counts.where(F.length("word") <= LONGEST).orderBy(F.desc("c"), "word").limit(FREQUENT)
    frequent = model.rated(top).toArrow()
    logs = np.array(frequent.column("logs").to_pylist(), float).reshape(-1, model.classes)
    c, base = frequent.column("c").to_numpy(), frequent.column("base").to_numpy()
    values = np.column_stack([(c > 0).astype(float), base, logs])
    common = (frequent.column("word").to_pylist(), values)
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, logs array<double>, "
        "rest array<struct<word: binary, n: long>>"
    )
    parts = docs.drop("lang").mapInArrow(_documents(common), schema).withColumn("row", F.monotonically_increasing_id())
    parts = saved(parts, "parts")
    rest = parts.select("row", F.inline("rest"))
    rated = model.rated(rest.select("word").distinct().join(model.counts, "word", "left"))
    ks = range(model.classes)
    met = rest.join(rated, "word").select(
        "row", F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"),
        (F.col("n") * F.col("base")).alias("base_score"), *[(F.col("n") * F.get("logs", F.lit(k))).alias(f"s{k}") for k in ks],
    )
    own = parts.select("row", "n_known", "base_score", *[F.get("logs", F.lit(k)).alias(f"s{k}") for k in ks])
    added = [F.sum(x).alias(x) for x in ["n_known", "base_score"] + [f"s{k}" for k in ks]]
    sums = met.unionByName(own).groupBy("row").agg(*added)
    # log10 of the sum over languages, from the largest term.
    weighted = [F.col(f"s{k}") + F.lit(math.log10(share[3])) for k, share in enumerate(model.shares)]
    largest = F.greatest(*weighted) if len(weighted) > 1 else weighted[0]
    total = sum((F.pow(F.lit(10.0), w - F.col("top")) for w in weighted), F.lit(0.0))
    scored = sums.withColumn("top", largest).withColumn("score", F.col("top") + F.log10(total))
    return parts.select("row", "doc_id", "held_out", "n_tokens").join(scored, "row").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op2_lattice_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score(docs.withColumn("held_out", held_out(F.col("doc_id"), FOLDS, FOLD)))
