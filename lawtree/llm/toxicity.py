"""Toxicity by a lexicon, misspellings included, and the context of each hit.

The lexicon is learned: words, and stems of words, that stand out in documents labelled toxic. Its terms form a trie;
intersecting the trie with Levenshtein automata of the terms gives one automaton that reads a word
and knows every term within the term's edit bound. Its states are sets of (trie node, edits) and
are made when first met, so most words end after a few letters. Every hit is scored by a window of
tokens around it: quotation marks and reporting verbs speak for quotation, address in the second
person for abuse. A logistic model combines these scores into one probability.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree.llm.common import held_out, table

FOLDS = 5
THRESHOLD = 0.5
# Labelled documents to learn from, of either label.
SAMPLE = 3000
# A term must be in so much of the toxic sample, in so many different texts, and be so exclusive to it.
SUPPORT, TEXTS, PRECISION = 0.02, 4, 0.85
WINDOW = 8
REMEMBERED = 200_000

# Words of reporting and of address.
REPORTING = frozenset(
    "said says say wrote writes quoted quote reported reports called calls term word dit écrit selon "
    "sagte sagt schrieb zitiert dijo dice escribió llamó".split()
)
ADDRESS = frozenset("you your you're u ur tu toi vous ton ta du dich dir dein sie ihr te ti tú usted".split())
QUOTES = "\"'“”„«»‘’"

# Ends a term that stands for all words that begin with it; the lengths such a stem can have.
STEM = "*"
STEMS = range(5, 9)

EDGES = re.compile(r"^[\W_]+|[\W_]+$")
FEATURES = ("exact", "fuzzy", "stems", "terms", "density", "stem_density", "quoted", "addressed")
# Before any data: what one unit of each feature adds, and how firmly that is believed.
PRIOR = np.array([-4.0, 4.0, 2.5, 1.0, 1.0, 0.5, 0.5, -1.0, 0.5])
FIRMNESS = np.array([0.05, 0.1, 0.3, 0.1, 0.1, 0.3, 0.1, 1.0, 1.0])


def allowed(term: str) -> int:
    """Edit bound of a term: none for stems and below five letters, one below nine, else two."""
    return 0 if term.endswith(STEM) else 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Levenshtein automata of all terms, intersected with their trie."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term = [-1]
        self.most = [0]  # largest edit bound of the terms below a node
        self.terms = terms
        for i, term in enumerate(terms):
            node = 0
            for c in term.removesuffix(STEM):
                self.most[node] = max(self.most[node], allowed(term))
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                    self.most.append(0)
                node = self.children[node][c]
            self.most[node] = max(self.most[node], allowed(term))
            self.term[node] = i
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.stems: list[tuple[int, int] | None] = []
        self.dead = self._state({})
        self.start = self._state(self._closed({0: 0}))

    def _closed(self, places: dict[int, int]) -> dict[int, int]:
        """Add the nodes reached by leaving out letters of a term. Node -> fewest edits."""
        todo = list(places.items())
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits + 1 <= self.most[child] and places.get(child, 9) > edits + 1:
                    places[child] = edits + 1
                    todo.append((child, edits + 1))
        return places

    def _state(self, places: dict[int, int]) -> int:
        key = frozenset(places.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            hits = [
                (edits, self.term[node]) for node, edits in places.items()
                if self.term[node] >= 0 and edits <= allowed(self.terms[self.term[node]])
            ]
            self.accepts.append(min(hits)[::-1] if hits else None)
            begun = [term for _, term in hits if self.terms[term].endswith(STEM)]
            self.stems.append((min(begun), 0) if begun else None)
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        places: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.most[node] and places.get(node, 9) > edits:
                places[node] = edits

        for node, edits in self.sets[state]:
            for letter, child in self.children[node].items():
                reach(child, edits + (letter != c))
            reach(node, edits + 1)
        target = self._state(self._closed(places))
        self.moves[state][c] = target
        return target

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the closest term within its bound, the first one among equals.

        A stem counts only if the word is no other term.
        """
        state, stem = self.start, None
        for c in word:
            state = self.moves[state].get(c, -1) if c in self.moves[state] else self._step(state, c)
            if state == self.dead:
                return stem
            stem = stem or self.stems[state]
        return self.accepts[state] or stem


class Scanner:
    """Features of whole texts."""

    def __init__(self, terms: list[str]):
        self.automaton = Automaton(terms)
        self.known: dict[str, tuple[int, int] | None] = {}

    def match(self, token: str) -> tuple[int, int] | None:
        found = self.known.get(token, 0)
        if found == 0:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[token] = self.automaton.match(EDGES.sub("", token))
        return found

    def features(self, text: str | None) -> list[float]:
        tokens = (text or "").lower().split()
        match = self.match
        hits = [(i, found) for i, t in enumerate(tokens) if (found := match(t)) is not None]
        if not hits:
            return [0.0] * len(FEATURES)
        quoted = addressed = 0.0
        for i, _ in hits:
            left, right = tokens[max(0, i - WINDOW):i], tokens[i + 1:i + 1 + WINDOW]
            marks = _inside(left, tokens[i], right)
            around = {EDGES.sub("", t) for t in left + right}
            quoted += 0.5 * marks + 0.5 * bool(around & REPORTING)
            addressed += bool(around & ADDRESS)
        kinds = [(self.automaton.terms[t].endswith(STEM), edits) for _, (t, edits) in hits]
        stems, exact = sum(k[0] for k in kinds), sum(k == (False, 0) for k in kinds)
        n = len(hits)
        return [
            float(np.log1p(exact)), float(np.log1p(n - stems - exact)), float(np.log1p(stems)),
            float(np.log1p(len({t for _, (t, _) in hits}))), min(1.0, 20 * (n - stems) / len(tokens)),
            min(3.0, 100 * stems / len(tokens)), quoted / n, addressed / n,
        ]


def _marks(token: str) -> tuple[bool, bool]:
    """Whether a quotation mark opens and closes with the token, sentence signs aside."""
    return token[0] in QUOTES, token.rstrip(".,!?;:").endswith(tuple(QUOTES))


def _inside(left: list[str], token: str, right: list[str]) -> bool:
    """Whether a quotation is opened at or before the token and closed at or after it.

    The nearest mark on each side decides: one that closes before, or opens after, belongs to another quotation.
    """
    opens, closes = _marks(token)
    before = next((not m[1] for t in reversed(left) if any(m := _marks(t))), False)
    after = next((not m[0] for t in right if any(m := _marks(t))), False)
    return (opens or before) and (closes or after)


def _vocabulary(batches):
    """(word, label, print) of every distinct word and stem of a document; near copies share their print."""
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            found = sorted({w for t in (text or "").lower().split() if (w := EDGES.sub("", t))})
            if found:
                stems = {w[:n] + STEM for w in found for n in STEMS if len(w) > n}
                least = min(zlib.crc32(w.encode()) for w in found)
                found += sorted(stems)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array([toxic] * len(found), pa.int32()), pa.array([least] * len(found), pa.int64())],
                    names=["word", "label", "print"],
                )


def learned_terms(sample: DataFrame) -> list[str]:
    """Words of the documents (text, label) that tell toxic ones from others.

    Candidates are frequent in toxic texts and rare in others. Of these a greedy cover takes the
    words that are needed to find each toxic text twice over: words that merely occur along with
    others, as in copies and long texts, add nothing to it.
    """
    totals = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    counts = sample.select("text", "label").mapInArrow(_vocabulary, "word string, label int, print long").groupBy("word").agg(
        F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"),
        F.collect_set(F.when(F.col("label") == 1, F.col("print"))).alias("texts"),  # at most the toxic sample
    )
    rate = F.col("t") / max(1, toxic)
    counts = counts.withColumn("precision", rate / (rate + (F.col("c") + 0.5) / (clean + 1)))
    rows = (
        counts.where((rate >= SUPPORT) & (F.size("texts") >= TEXTS) & (F.col("precision") >= PRECISION))
        .orderBy(F.desc(F.col("t") * F.col("precision")), "word").select("word", "texts", "t").collect()
    )
    candidates, found, terms = {r.word: set(r.texts) for r in rows}, Counter(), []
    least = max(TEXTS, round(SUPPORT * toxic))
    while candidates:
        gains = {w: sum(found[p] < 2 for p in texts) for w, texts in candidates.items()}
        word = max(gains, key=lambda w: (gains[w], not w.endswith(STEM), len(w), w))
        if gains[word] < least:
            break
        terms.append(word)
        found.update(candidates.pop(word))
    # Whole words about as frequent as the most frequent one chosen, though always among others.
    most = max((r.t for r in rows if r.word in terms and not r.word.endswith(STEM)), default=0)
    return terms + [r.word for r in rows if r.word in candidates and not r.word.endswith(STEM) and 2 * r.t >= most > 0]


def _features(terms: list[str]):
    def run(batches):
        scanner = Scanner(terms)
        for batch in batches:
            rows = [scanner.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], names=["label", "features"]
            )

    return run


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Most likely weights, the constant first, given the prior; Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + FIRMNESS * (w - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(FIRMNESS)
        move = np.linalg.solve(curve, gradient)
        w -= move / max(1.0, np.abs(move).max() / 2)
    return w


class Model:
    def __init__(self, terms: list[str], weights: np.ndarray):
        self.terms, self.weights = terms, weights

    def probability(self, features: list[float]) -> float:
        return float(1 / (1 + np.exp(-(self.weights[0] + np.dot(self.weights[1:], features)))))


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` documents of either label (doc_id, label), chosen by a hash.

    Null ids and labels take no part. Texts stay in Spark; the driver gets the terms and a few
    numbers of each sampled document. Without toxic documents nothing scores above the prior.
    """
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(
        F.max("label").cast("int").alias("label")
    )
    some = [
        known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for value in (0, 1)
    ]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(some[0].unionByName(some[1])), "doc_id")  # 2 * sample rows of two numbers
    terms = learned_terms(rows)
    found = rows.select("text", "label").mapInArrow(_features(terms), "label int, features array<double>").collect()
    if not found:
        return Model(terms, PRIOR)
    x, y = np.array([r.features for r in found]), np.array([r.label for r in found], float)
    return Model(terms, logistic(x, y))


def _scorer(model: Model):
    def run(batches):
        scanner = Scanner(model.terms)
        for batch in batches:
            scores = [model.probability(scanner.features(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs``; a null text scores like an empty one."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scorer(model), "doc_id long, score double")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    scored = score(docs, fitted(docs, labels.where(~held_out(F.col("doc_id"), FOLDS, 0))))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
