"""SimHash near-duplicates over a byte-position inverted index with count filtering.

Fingerprints at most two bits apart differ in at most two of their eight bytes, so they share at
least six bytes at the same positions. Tallying single positional bytes pair by pair would build
all pairs of a long posting list; the index is therefore keyed by six positional bytes at once.
A pair meets under one of its 28 keys exactly if its tally reaches the guaranteed six. All members
of a posting list differ in two bytes only, so a list holds at most 65,536 fingerprints: its links
are verified within one row, by looking up the 136 values one or two bits away, and returned as a
spanning forest, never as all pairs.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree.llm.common import components, saved, table, words

SHINGLE = 3
SEED = 42
# The index below is made for this bound.
MAX_BITS = 2
SMALL = 24

FREE_BYTES = list(itertools.combinations(range(8), 2))


def fingerprint(text: str | None) -> int:
    """Bits set in over half of the shingle hashes; 0 without words."""
    tokens = words(text)
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(tokens) < SHINGLE:
        hashes = [digest(b" ".join(tokens), SEED)]
    else:
        hashes = [digest(b"%b %b %b" % t, SEED) for t in zip(tokens, tokens[1:], tokens[2:])]
    ones, n = np.zeros(64, np.int64), len(hashes)
    for start in range(0, n, 8192):
        part = np.array(hashes[start:start + 8192], np.uint64).view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def _fingerprints(batches):
    for batch in batches:
        prints = [fingerprint(t.as_py()) for t in batch.column("text")]
        names = [n for n in batch.schema.names if n != "text"]
        columns = [batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(prints, pa.int64())], names=[*names, "fp"])


def fingerprints(docs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keys, fp) of every row; ``keys``: columns of longs."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keys, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints, ", ".join(f"{c} long" for c in ("doc_id", *keys, "fp")))


def _near_masks() -> np.ndarray:
    bits = [1 << b for b in range(16)]
    return np.array(bits + [a | b for a, b in itertools.combinations(bits, 2)])


def forest(members: np.ndarray, free: tuple[int, int]) -> list[tuple[int, int]]:
    """Edges that connect what links within one posting list connect; ``free``: its two other bytes."""
    if len(members) <= SMALL:
        values = members.tolist()
        return [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= MAX_BITS]
    raw = members.astype(np.int64).view(np.uint8).reshape(-1, 8)
    codes = raw[:, free[0]].astype(np.int64) << 8 | raw[:, free[1]]
    label = np.full(1 << 16, 1 << 16)
    label[codes] = np.arange(len(codes))
    masks = _near_masks()
    while True:
        old = label[codes]
        for mask in masks:
            label[codes] = np.minimum(label[codes], label[codes ^ mask])
        if (label[codes] == old).all():
            break
    return [(a, b) for a, b in zip(members.tolist(), members[label[codes]].tolist()) if a != b]


def _links(batches):
    for batch in batches:
        a, b = [], []
        for key, members in zip(batch.column("key"), batch.column("members")):
            edges = forest(members.values.to_numpy(zero_copy_only=False), FREE_BYTES[key.as_py()])
            a += [e[0] for e in edges]
            b += [e[1] for e in edges]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _kept_bytes(free: tuple[int, int]) -> int:
    """Signed 64-bit mask of the six other bytes."""
    return int(np.array([~sum(0xFF << 8 * i for i in free) & (1 << 64) - 1], np.uint64).view(np.int64)[0])


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of all links; ``prints``: distinct values of fp."""
    keys = [
        F.struct(
            F.lit(k).alias("key"),
            F.col("fp").bitwiseAND(F.lit(_kept_bytes(free))).alias("bytes"),
        )
        for k, free in enumerate(FREE_BYTES)
    ]
    index = prints.select("fp", F.explode(F.array(*keys)).alias("at")).select("fp", "at.*")
    lists = index.groupBy("key", "bytes").agg(F.collect_list("fp").alias("members"))
    return lists.where(F.size("members") > 1).select("key", "members").mapInArrow(_links, "a long, b long")


def _grouped(docs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keys, fp, component, component_id) of every row; components may share a component_id."""
    prints = saved(fingerprints(docs, keys), "prints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    groups = components(links(distinct))
    members = distinct.join(groups, distinct.fp == groups.node, "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component")
    )
    least = members.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = members.join(least, "component").select("fp", "component", "component_id")
    return prints.join(known, "fp").select("doc_id", *keys, "fp", "component", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text, others are ignored).

    Null texts count as empty: their fingerprint is zero and links like any other. Rows with
    equal fingerprints are linked whatever their number. A null doc_id is in its component, which
    takes the smallest other id. An empty table gives no rows.
    """
    return _grouped(docs).select("doc_id", "fp", "component_id")


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each component stays: the one with the smallest id, a null id last.

    Of rows that share this id the one with the least hash of the text stays, then the one with the
    least hash of all columns, so that reruns agree.
    """
    keys = ("__hash", "__row")
    keyed = docs.withColumns({"__hash": F.xxhash64("text"), "__row": F.xxhash64(*docs.columns)})
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", *keys)
    kept = _grouped(keyed, keys).groupBy("component").agg(F.min(order).alias("row")).select("row.*")
    kept = kept.select(F.col("doc_id").alias("__id"), *[F.col(k).alias(f"{k}2") for k in keys])
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__hash2")) & (F.col("__row") == F.col("__row2"))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", *keys]).select(docs.columns)


def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
