"""Mix sources to target weights from fixed-length blocks of words.

The words of a source, document after document, are packed into blocks of one length. The mix is
a sequence of slots, dealt over output shards of one size. Every shard draws how many of its slots
each source fills: multinomial counts, given that all shards together use up every source's number
of slots (the multivariate hypergeometric law). The draw halves the range of shards again and again,
each half by a generator seeded with its bounds, so any task finds the counts of its shards, and the
slots before them, alone.
Slot j of a source takes block perm(j mod blocks) of pass j div blocks, with a pseudorandom
permutation per source and pass; blocks join by index.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lawtree.llm.common import saved, table, text_words

BLOCK = 64
SHARD = 256
PASSES = 3
# Shards that one task fills.
TASK = 2_000
SEED = 20
# Documents of a source that are put in order together.
BUCKET = 4_000


def targets(sizes: list[int]) -> list[float]:
    """Words wanted of each source, in order: weights 1, 2, 3 repeating, at most PASSES sizes each."""
    weights = [1 + i % 3 for i in range(len(sizes))]
    wanted = [0.0] * len(sizes)
    free, rest = set(range(len(sizes))), float(sum(sizes))
    while free:
        share = rest / sum(weights[i] for i in free)
        full = {i for i in free if weights[i] * share > PASSES * sizes[i]}
        for i in full or free:
            wanted[i] = float(PASSES * sizes[i]) if full else weights[i] * share
        if not full:
            break
        rest -= sum(wanted[i] for i in full)
        free -= full
    return wanted


def taken_slots(size: int, target: float, block: int) -> tuple[int, int]:
    """(blocks, slots) of a source."""
    blocks = -(-size // block)
    return blocks, min(PASSES * blocks, round(target * blocks / size)) if size else 0


def half(counts: np.ndarray, take: int, rng: np.random.Generator) -> np.ndarray:
    """How many of ``take`` slots fall to each source, if any of the ``counts`` slots may be among them alike.

    Every slot is first taken by chance, so that each source has a binomial count; what is taken too
    many or too few goes back, or comes after, in the same way. All slots are alike in every step,
    so this is the hypergeometric law at any size; a step leaves about the root of the last.
    """
    out, sign = np.zeros_like(counts), 1
    free = counts
    while take:
        drawn = rng.binomial(free, take / int(free.sum()))
        out = out + sign * drawn
        over = int(drawn.sum()) - take
        # Too many: some of those just drawn go back. Too few: some of the others follow.
        free, sign = (drawn, -sign) if over > 0 else (free - drawn, sign)
        take = abs(over)
    return out


class Draw:
    """Source counts of each shard."""

    def __init__(self, slots: list[int], shard: int, seed: int):
        self.slots, self.shard, self.seed = np.array(slots, np.int64), shard, seed
        self.shards = -(-int(self.slots.sum()) // shard)
        self._halves: dict[tuple, np.ndarray] = {}  # neighbours share the upper ones

    def bounds(self, lo: int, hi: int) -> int:
        return min(hi * self.shard, int(self.slots.sum())) - lo * self.shard

    def of(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(slots of each source before the shard, slots in it)."""
        lo, hi, counts, before = 0, self.shards, self.slots, np.zeros_like(self.slots)
        while hi - lo > 1:
            middle = (lo + hi) // 2
            left = self._left(lo, middle, hi, tuple(counts.tolist()))
            if number < middle:
                hi, counts = middle, left
            else:
                lo, counts, before = middle, counts - left, before + left
        return before, counts

    def _left(self, lo: int, middle: int, hi: int, counts: tuple) -> np.ndarray:
        key = (lo, hi, counts)
        if key not in self._halves:
            if len(self._halves) >= 64:
                self._halves.clear()
            rng = np.random.default_rng((self.seed, lo, hi))
            self._halves[key] = half(np.array(counts, np.int64), self.bounds(lo, middle), rng)
        return self._halves[key]


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1: a Feistel network, walked until it falls below n."""
    bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << bits) - 1)
    rounds = np.random.default_rng(key).integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(bits), out[todo] & mask
        for k in range(0, 8, 2):
            mixed = (right + rounds[k]) * rounds[k + 1]
            mixed ^= mixed >> np.uint64(29)
            left, right = right, left ^ (mixed * rounds[k] >> np.uint64(17) & mask)
        out[todo] = left << np.uint64(bits) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _slots(slots: list[int], blocks: list[int], shard: int, seed: int):
    def run(batches):
        draw = Draw(slots, shard, seed)
        for batch in batches:
            for number in batch["shard"]:
                before, counts = draw.of(number)
                n = int(counts.sum())
                src = np.repeat(np.arange(len(counts)), counts)
                slot = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts) + before[src]
                size = np.array(blocks)[src]
                turn, index = slot // size, slot % size
                block = np.empty_like(slot)
                for s, t in sorted(set(zip(src.tolist(), turn.tolist()))):
                    own = (src == s) & (turn == t)
                    block[own] = permuted(index[own], blocks[s], (seed, s, t))
                place = np.random.default_rng((seed, number)).permutation(n)
                yield pd.DataFrame({"shard": number, "place": place, "src": src, "turn": turn, "block": block})

    return run


def documents(docs: DataFrame) -> DataFrame:
    """One row per document without its text: doc_id, a hash of the text, copy, source and size."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "source",
        text_words(F.col("text")).alias("size"),
    )
    same = Window.partitionBy("doc_id", "hash").orderBy("source")
    return rows.withColumn("copy", F.row_number().over(same))


class Mix:
    """The tables of a mix of ``docs``.

    ``docs``: one row per document with its source (its rank ``src``), its size and first word's
    place in the source. ``sources``: name, size and target of each source, by rank; their list is
    the one thing the driver holds. ``slots``: the blocks of each shard in order. ``spans``: the
    words of documents in each block. ``words``: the mix, slots joined with spans.
    """

    def __init__(self, docs: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED):
        spark = docs.sparkSession
        rows = saved(documents(docs), "sizes")
        ranked = rows.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("docs"))
        ranked = ranked.orderBy(F.asc_nulls_last("source")).collect()
        self.sizes = [r.n for r in ranked]
        self.targets = targets(self.sizes)
        pairs = [taken_slots(n, t, block) for n, t in zip(self.sizes, self.targets)]
        blocks, slots = [p[0] for p in pairs], [p[1] for p in pairs]
        names = [(r.source, i, n, t) for i, (r, n, t) in enumerate(zip(ranked, self.sizes, self.targets))]
        schema = f"source {rows.schema['source'].dataType.simpleString()}, src int, source_size long, target double"
        self.sources = spark.createDataFrame(names, schema)
        buckets = max(1, -(-sum(r.docs for r in ranked) // BUCKET))
        known = rows.join(self.sources, rows.source.eqNullSafe(self.sources.source)).drop("source")
        known = known.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "hash", "copy"), F.lit(buckets)))
        # Words before a document: those of earlier buckets of its source, and in its own bucket.
        earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = known.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
        sums = sums.select("src", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
        inside = Window.partitionBy("src", "bucket").orderBy("doc_id", "hash", "copy")
        inside = inside.rowsBetween(Window.unboundedPreceding, -1)
        placed = known.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(sums, ["src", "bucket"])
        self.docs = saved(placed.withColumn("start", F.col("base") + F.col("inner")).drop("base", "inner", "bucket"), "placed")
        shards = Draw(slots, shard, seed).shards
        # A number is small and its slots are many, so the numbers are dealt by count, not by their bytes.
        tasks = max(1, min(shards, spark.sparkContext.defaultParallelism), -(-shards // TASK))
        numbers = spark.range(0, shards, 1, tasks).withColumnRenamed("id", "shard")
        dealt = numbers.mapInPandas(
            _slots(slots, blocks, shard, seed), "shard long, place long, src int, turn long, block long"
        )
        # Stored, so that its size is known when it is joined.
        self.slots = saved(dealt, "slots")
        last = F.expr(f"(start + size - 1) div {block}")
        spans = self.docs.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), last)))
        spans = spans.select(
            "src", "block", "doc_id", "hash", "copy", "size",
            F.greatest(F.expr(f"block * {block} - start"), F.lit(0)).alias("first"),
            F.least(F.expr(f"(block + 1) * {block} - start"), F.col("size")).alias("end"),
        )
        self.spans = spans
        self.words = self.slots.join(spans, ["src", "block"])

    def taken(self) -> DataFrame:
        """Every document with the words that the mix takes of it, repeats counted."""
        key = ["doc_id", "hash", "copy"]
        some = self.words.groupBy(*key).agg(F.sum(F.col("end") - F.col("first")).alias("taken"))
        pairs = [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in key]
        joined = self.docs.alias("d").join(some.alias("t"), pairs, "left")
        return joined.select("d.*", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix as documents: a row for each document and pass that takes words of it.

    A document taken whole keeps its text; else the text is the words taken, in order. Documents
    without words are in no mix. Rows that agree in doc_id, source and text are documents of their own;
    so are rows that agree in doc_id and text and come from different sources.
    """
    mix = Mix(docs)
    part = F.struct("first", "end")
    some = (
        mix.words.groupBy("doc_id", "hash", "copy", "turn")
        .agg(F.sort_array(F.collect_list(part)).alias("parts"), F.sum(F.expr("end - first")).alias("n"), F.first("size").alias("size"), F.first("src").alias("src"))
        .join(mix.sources.select("src", F.col("source").alias("name")), "src").withColumnRenamed("doc_id", "id")
    )
    whole = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__hash": F.xxhash64("text")})
    whole = whole.dropDuplicates(["__id", "__hash", "source"])
    joined = whole.join(
        some, whole.__id.eqNullSafe(some.id) & (whole.__hash == some.hash) & whole.source.eqNullSafe(some.name)
    )
    # A text that starts with white space has an empty first piece. The one-element array binds the
    # words, so that a text is split once and not once for each of its parts.
    cut = F.expr(
        r"""array_join(flatten(flatten(transform(
              array(filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')),
              words -> transform(parts, p -> slice(words, int(p.first) + 1, int(p.end - p.first)))))), ' ')"""
    )
    text = F.when(F.col("n") == F.col("size"), F.col("text")).otherwise(cut)
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    taken = Mix(table(spark, folder, "documents")).taken()
    return taken.select("doc_id", "size", "source_size", "target", "taken")
