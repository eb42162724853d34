"""Merkle manifest of a dataset: a SHA-256 tree whose parents keep the hash state before each child.

A leaf is the hash of a row's columns, and every node the hash of up to ARITY consecutive ones below
it: first within each source, then over the sources' subroots. A digest as hex text is exactly one
block of SHA-256, so the state before a child slot is eight words. Parents retain a copy of it for
each slot, and a changed leaf is folded upwards by resuming the state of its slot with the new digest
and the siblings to its right; those to its left are not hashed again.

Leaves are numbered in order without passing through one task and cut into chunks of SPAN leaves, each a
subtree built in one go with its states. The roots of chunks are the leaves of the next round, until
one per source is left. Every round is a stored table, so a large source is as many tasks as it has
chunks. Back down, each chunk gets the path above it, and its leaves are folded and proved together.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree.llm.common import CRC_TABLE, crc_sql, numbered, saved, table

ARITY = 3
# Levels of a chunk; it has at most ARITY ** LEVELS leaves.
LEVELS = 6
SPAN = ARITY**LEVELS
# Nodes that a task works on together.
TOGETHER = 8_192

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# One entry per level above a chunk, the lowest first.
PATH = "array<struct<state binary, left array<binary>, right array<binary>>>"


def _primes(count: int) -> list[int]:
    found: list[int] = []
    n = 2
    while len(found) < count:
        if all(n % p for p in found):
            found.append(n)
        n += 1
    return found


def _root_bits(n: int, power: int) -> int:
    """First 32 bits of the fraction of the root of n."""
    scaled, low, high = n << 32 * power, 0, 1 << 40
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**power <= scaled else (low, middle - 1)
    return low & 0xFFFFFFFF


# The constants of SHA-256 by their definition: roots of the first primes.
START = np.array([_root_bits(p, 2) for p in _primes(8)], np.uint32)
ROUNDS = [np.uint32(_root_bits(p, 3)) for p in _primes(64)]
HEX = np.frombuffer(bytes(range(256)).hex().encode(), np.uint8).reshape(256, 2)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x >> np.uint32(bits) | x << np.uint32(32 - bits)


def compress(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States (n, 8) after one more block (n, 16) each, or after one block (1, 16) for all."""
    words = list(np.ascontiguousarray(blocks.T))
    for t in range(16, 64):
        x, y = words[t - 15], words[t - 2]
        small = _turned(x, 7) ^ _turned(x, 18) ^ x >> np.uint32(3)
        large = _turned(y, 17) ^ _turned(y, 19) ^ y >> np.uint32(10)
        words.append(words[t - 16] + small + words[t - 7] + large)
    before = np.ascontiguousarray(states.T)
    a, b, c, d, e, f, g, h = before
    for word, constant in zip(words, ROUNDS):
        one = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + (g ^ e & (f ^ g)) + constant + word
        two = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + (a & b | c & (a | b))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return np.ascontiguousarray((np.stack([a, b, c, d, e, f, g, h]) + before).T)


def hex_text(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 32) as hex text (n, 64)."""
    return HEX[digests].reshape(len(digests), 64)


def _blocks(digests: np.ndarray) -> np.ndarray:
    return hex_text(digests).view(">u4").astype(np.uint32)


def _padding(children: int) -> np.ndarray:
    """The last block of a message of so many digests."""
    return np.array([[0x80000000] + [0] * 14 + [children * 512]], np.uint32)


def _finished(states: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of states that have taken in so many children."""
    out = np.empty((len(states), 32), np.uint8)
    for count in range(1, ARITY + 1):
        own = children == count
        if own.any():
            out[own] = compress(states[own], _padding(count)).astype(">u4").view(np.uint8)
    return out


def height(nodes: int) -> int:
    """Levels from so many nodes up to one."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // ARITY), levels + 1
    return levels


def level_sizes(nodes: int, levels: int) -> list[int]:
    sizes = [nodes]
    for _ in range(levels):
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes


def chunk_height(total: int) -> int:
    """Levels of a chunk of a group of ``total`` nodes: a lone chunk ends at one node, others are all alike."""
    return height(total) if total <= SPAN else LEVELS


def build(digests: np.ndarray, sizes: list[int], levels: list[int]) -> tuple[list, list, np.ndarray]:
    """Levels of several chunks at once, from the digests (n, 32) of their nodes, chunk after chunk.

    Gives for each level the digests and states of its nodes, and the root of each chunk. A level
    has the nodes of those chunks only that go on above it.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.concatenate([np.arange(n) for n in sizes]) if sizes else np.zeros(0, int)
    tall, roots = np.array(levels), np.empty((len(sizes), 32), np.uint8)
    kept, states_kept, level = [], [], 0
    while len(owner):
        done = tall[owner] == level
        roots[owner[done]] = digests[done]
        owner, place, digests = owner[~done], place[~done], digests[~done]
        if not len(owner):
            break
        slot, blocks = place % ARITY, _blocks(digests)
        states = np.tile(START, (len(owner), 1))
        for k in range(1, ARITY):
            here = np.flatnonzero(slot == k)
            states[here] = compress(states[here - 1], blocks[here - 1])
        kept.append(digests)
        states_kept.append(states)
        last = np.append((slot[1:] == 0) | (owner[1:] != owner[:-1]), True)
        digests = _finished(compress(states[last], blocks[last]), slot[last] + 1)
        owner, place = owner[last], place[last] // ARITY
        level += 1
    return kept, states_kept, roots


def fold(digests: np.ndarray, states: np.ndarray, right: np.ndarray, n_right: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Parents' digests: the states of the nodes' slots resumed with their digests and right siblings."""
    states = compress(states, _blocks(digests))
    for k in range(ARITY - 1):
        more = n_right > k
        if more.any():
            states[more] = compress(states[more], _blocks(right[more, k]))
    return _finished(states, children)


def _stacked(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 32)


def _states(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint32).reshape(-1, 8)


def _portions(counts: list[int]):
    """Ranges of consecutive chunks of about TOGETHER nodes."""
    start = held = 0
    for i, n in enumerate(counts):
        if held and held + n > TOGETHER:
            yield start, i
            start, held = i, 0
        held += n
    if counts:
        yield start, len(counts)


def _built(batches):
    """Chunks with the digests and states of their levels, one level after another, and their roots."""
    for batch in batches:
        totals, counts = batch.column("total").to_pylist(), batch.column("n").to_pylist()
        nodes = batch.column("nodes")
        for start, end in _portions(counts):
            sizes, levels = counts[start:end], [chunk_height(t) for t in totals[start:end]]
            flat = [d for row in nodes.slice(start, end - start).to_pylist() for d in row]
            kept, states, roots = build(_stacked(flat), sizes, levels)
            at = [0] * len(kept)
            out_digests, out_states = [], []
            for n, tall in zip(sizes, levels):
                mine, own = [], []
                for level, size in enumerate(level_sizes(n, tall)[:tall]):
                    part = slice(at[level], at[level] + size)
                    mine.append(kept[level][part].tobytes())
                    own.append(states[level][part].tobytes())
                    at[level] += size
                out_digests.append(b"".join(mine))
                out_states.append(b"".join(own))
            rows = batch.slice(start, end - start).drop_columns(["nodes"])
            added = [
                pa.array(levels, pa.int32()), pa.array(out_digests, pa.binary()), pa.array(out_states, pa.binary()),
                pa.array([r.tobytes() for r in roots], pa.binary()),
            ]
            names = ["levels", "digests", "states", "root"]
            yield pa.RecordBatch.from_arrays([*rows.columns, *added], names=[*rows.schema.names, *names])


def _paths(batches):
    """The path above each node of the chunks: its own levels, then those above its chunk."""
    for batch in batches:
        for row in batch.to_pylist():
            sizes, digests, states = level_sizes(row["n"], row["levels"]), row["digests"], row["states"]
            starts = np.concatenate([[0], np.cumsum(sizes)])
            out = []
            for place in range(row["n"]):
                path, node = [], place
                for level in range(row["levels"]):
                    first = node - node % ARITY
                    run = range(first, min(first + ARITY, sizes[level]))
                    cell = [bytes(digests[32 * (starts[level] + i):32 * (starts[level] + i + 1)]) for i in run]
                    at = 32 * (starts[level] + node)
                    path.append({"state": bytes(states[at:at + 32]), "left": cell[:node - first], "right": cell[node - first + 1:]})
                    node //= ARITY
                out.append(path + row["path"])
            n = row["n"]
            yield pa.RecordBatch.from_pydict({
                "grp": [row["grp"]] * n, "chunk": [row["chunk"] * SPAN + i for i in range(n)], "path": out,
                "subroot": [row["subroot"]] * n,
            }, schema=pa.schema([
                ("grp", pa.string()), ("chunk", pa.int64()),
                ("path", pa.list_(pa.struct([
                    ("state", pa.binary()), ("left", pa.list_(pa.binary())), ("right", pa.list_(pa.binary())),
                ]))), ("subroot", pa.binary()),
            ]))


class Tree:
    """Trees over the nodes (grp, idx, total, digest, others) of each group; others are carried by the first round.

    ``rounds``: the chunks of each round. ``roots``: (grp, root).
    """

    def __init__(self, nodes: DataFrame, carried: tuple[str, ...] = ()):
        self.rounds, ends = [], []
        while True:
            member = F.struct("idx", "digest", *carried)
            chunks = nodes.groupBy("grp", F.expr(f"idx div {SPAN}").alias("chunk")).agg(
                F.first("total").alias("total"), F.count("*").cast("int").alias("n"),
                F.sort_array(F.collect_list(member)).alias("members"),  # at most SPAN
            )
            chunks = chunks.select(
                "grp", "chunk", "total", "n", F.col("members.digest").alias("nodes"), *[F.col(f"members.{c}").alias(c) for c in carried]
            )
            kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunks.schema if f.name != "nodes")
            built = chunks.mapInArrow(_built, kept + ", levels int, digests binary, states binary, root binary")
            self.rounds.append(saved(built, "chunks"))
            carried = ()
            ends.append(self.rounds[-1].where(F.col("total") <= SPAN).select("grp", "root"))
            more = self.rounds[-1].where(F.col("total") > SPAN)
            if more.isEmpty():
                break
            nodes = more.select(
                "grp", F.col("chunk").alias("idx"), F.expr(f"(total + {SPAN - 1}) div {SPAN}").alias("total"), F.col("root").alias("digest")
            )
        self.roots = reduce(DataFrame.unionByName, ends)

    def chunks_with_paths(self, above: DataFrame, number: int = 0) -> DataFrame:
        """Chunks of a round with the path over each; ``above``: (grp, path, subroot) for the whole groups."""
        chunks = self.rounds[number]
        lone = chunks.where(F.col("total") <= SPAN).join(above, "grp")
        if number + 1 == len(self.rounds):
            return lone
        paths = saved(self.node_paths(above, number + 1), "paths")
        return lone.unionByName(chunks.where(F.col("total") > SPAN).join(paths, ["grp", "chunk"]).select(lone.columns))

    def node_paths(self, above: DataFrame, number: int) -> DataFrame:
        """(grp, chunk, path, subroot): the path over each node of a round, that is, over each chunk of the one before."""
        chunks = self.chunks_with_paths(above, number)
        needed = chunks.select("grp", "chunk", "n", "levels", "digests", "states", "path", "subroot")
        return needed.mapInArrow(_paths, f"grp string, chunk long, path {PATH}, subroot binary")


def _proofs(top: bytes):
    """Every leaf's proof and the root that its replacement folds to; ``top``: the root of all."""

    def run(batches):
        for batch in batches:
            counts = batch.column("n").to_pylist()
            for start, end in _portions(counts):
                yield _proved(batch.slice(start, end - start).to_pylist(), top)

    return run


def _proved(chunks: list[dict], top: bytes) -> pa.RecordBatch:
    sizes = [c["n"] for c in chunks]
    owner = np.repeat(np.arange(len(chunks)), sizes)
    node = np.concatenate([np.arange(n) for n in sizes])
    now = _stacked([d for c in chunks for d in c["replaced"]]).copy()
    leaves = [d for c in chunks for d in c["leaf"]]
    all_digests, all_states = _stacked([c["digests"] for c in chunks]), np.concatenate([_states(c["states"]) for c in chunks])
    base = np.concatenate([[0], np.cumsum([len(c["digests"]) // 32 for c in chunks])])[:-1]
    tall, proof = np.array([c["levels"] for c in chunks]), [[] for _ in owner]
    level_size = np.array(sizes)
    for level in range(tall.max(initial=0)):
        some = np.flatnonzero(tall[owner] > level)
        o, at = owner[some], node[some]
        slot = at % ARITY
        first = at - slot
        children = np.minimum(ARITY, level_size[o] - first)
        place = base[o] + at
        right, n_right = np.zeros((len(some), ARITY - 1, 32), np.uint8), children - 1 - slot
        for k in range(ARITY):
            sibling = np.flatnonzero((k != slot) & (k < children))
            found = all_digests[base[o[sibling]] + first[sibling] + k]
            for i, text in zip(some[sibling].tolist(), hex_text(found)):
                proof[i].append(text.tobytes())
            after = k > slot[sibling]
            right[sibling[after], k - 1 - slot[sibling[after]]] = found[after]
        now[some] = fold(now[some], all_states[place], right, n_right, children)
        going = tall > level
        base[going] += level_size[going]
        level_size[going] = -(-level_size[going] // ARITY)
        node[some] //= ARITY
    paths = [c["path"] for c in chunks]
    length = np.array([len(p) for p in paths])
    upper = [b"".join(d.hex().encode() for step in p for d in step["left"] + step["right"]) for p in paths]
    for level in range(length.max(initial=0)):
        going = length > level
        steps = [p[level] if len(p) > level else None for p in paths]
        states, right = np.zeros((len(paths), 8), np.uint32), np.zeros((len(paths), ARITY - 1, 32), np.uint8)
        n_right, children = np.zeros(len(paths), int), np.zeros(len(paths), int)
        for i, step in enumerate(steps):
            if step:
                states[i] = np.frombuffer(step["state"], np.uint32)
                n_right[i], children[i] = len(step["right"]), len(step["left"]) + 1 + len(step["right"])
                for k, d in enumerate(step["right"]):
                    right[i, k] = np.frombuffer(d, np.uint8)
        some = np.flatnonzero(going[owner])
        o = owner[some]
        now[some] = fold(now[some], states[o], right[o], n_right[o], children[o])
    proofs = [hashlib.sha256(b"".join([*own, upper[o]])).hexdigest() for own, o in zip(proof, owner.tolist())]
    folded = [row.tobytes() for row in now]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for c in chunks for i in c["doc_id"]], pa.int64()), pa.array([d.hex() for d in leaves]),
            pa.array([chunks[o]["subroot"].hex() for o in owner]), pa.array([top.hex()] * len(owner)),
            pa.array(proofs), pa.array([d.hex() for d in folded]), pa.array([d == top for d in folded]),
        ],
        names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    )


_RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf(columns: tuple[str | Column, ...]) -> Column:
    """Digest of a row: each column as its number of bytes and its value, '-' for null."""
    def field(value: str | Column) -> Column:
        text = (F.col(value) if isinstance(value, str) else value).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(field, columns)), 256))


def subroot_group(source: str) -> Column:
    """A source as a non-null key in the same order, null first."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit(""))


class Manifest:
    """The tree over ``rows`` (grp, doc_id, leaf, replaced): ``replaced`` is the leaf found when verifying.

    Rows that repeat are leaves of their own; rows alike in doc_id go by their leaf.
    """

    def __init__(self, rows: DataFrame):
        placed = numbered(rows, ["grp"], ["doc_id", "leaf"])
        self.sources = Tree(placed.withColumn("digest", F.col("leaf")), ("doc_id", "leaf", "replaced"))
        subroots = saved(self.sources.roots, "subroots")
        ordered = numbered(subroots, [], ["grp"]).select(
            F.lit("").alias("grp"), "idx", "total", F.col("root").alias("digest"), F.col("grp").alias("name")
        )
        self.top = Tree(ordered, ("name",))
        root = self.top.roots.first()
        #: None without rows.
        self.root = bytes(root.root) if root else None
        self._subroots = subroots

    def proofs(self) -> DataFrame:
        """Every row's leaf, subroot and root, the hash of its proof, and what its replaced leaf folds to."""
        spark = self._subroots.sparkSession
        if self.root is None:
            return spark.createDataFrame([], _RESULT)
        # One row, stored so that the join below has a key on both sides.
        nothing = spark.range(1).select(F.lit("").alias("grp"), F.array().cast(PATH).alias("path"), F.lit(self.root).alias("subroot"))
        nothing = saved(nothing, "nothing")
        over = self.top.node_paths(nothing, 0).select(F.col("chunk").alias("idx"), "path")
        names = self.top.rounds[0].select(F.posexplode("name").alias("i", "grp"), "chunk")
        names = names.select("grp", (F.col("chunk") * SPAN + F.col("i")).alias("idx"))
        above = saved(
            over.join(names, "idx").join(self._subroots.withColumnRenamed("root", "subroot"), "grp").select("grp", "path", "subroot"), "above"
        )
        chunks = self.sources.chunks_with_paths(above).select(
            "n", "levels", "digests", "states", "path", "subroot", "doc_id", "leaf", "replaced"
        )
        return chunks.mapInArrow(_proofs(self.root), _RESULT)


def manifest(docs: DataFrame, columns: tuple[str | Column, ...] = COLUMNS, changed: tuple[str | Column, ...] | None = None) -> Manifest:
    """Manifest of ``docs`` per source; ``changed``: the columns as they are found when verifying."""
    own = leaf(columns)
    rows = docs.select(
        subroot_group("source").alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), own.alias("leaf"),
        (own if changed is None else leaf(changed)).alias("replaced"),
    )
    return Manifest(rows)


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents, verified against texts that lost their line ends where the id's crc32 is even."""
    docs = table(spark, folder, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest(docs, COLUMNS, (*COLUMNS[:-1], text)).proofs()


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _walk(name: str, start: str, tree: str) -> str:
    """From each row of ``start`` up its tree: siblings collected, the changed digest folded."""
    return f"""{name} AS (
  SELECT * FROM {start}
  UNION ALL
  SELECT w.doc_id, w.k, w.source, w.level + 1, w.idx // {ARITY},
    w.proof || coalesce(string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx <> w.idx), ''),
    sha256(string_agg(CASE WHEN t.idx = w.idx THEN w.digest ELSE t.digest END, '' ORDER BY t.idx))
  FROM {name} w JOIN {tree} t ON t.source IS NOT DISTINCT FROM w.source AND t.level = w.level AND t.idx // {ARITY} = w.idx // {ARITY}
  WHERE t.total > 1 GROUP BY w.doc_id, w.k, w.source, w.level, w.idx, w.proof, w.digest
)"""


def _tree(name: str, start: str) -> str:
    return f"""{name} AS (
  SELECT source, 0 AS level, idx, total, digest FROM {start}
  UNION ALL
  SELECT source, level + 1, idx // {ARITY}, (max(total) + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name} WHERE total > 1 GROUP BY source, level, idx // {ARITY}
)"""


_FIELDS = " || ".join(map(_field, COLUMNS[:-1]))

ORACLE = f"""
WITH RECURSIVE {CRC_TABLE}, hashed AS (
  SELECT doc_id, source, sha256({_FIELDS} || {_field('text')}) AS digest, sha256({_FIELDS} || {_field('changed')}) AS changed
  FROM (SELECT *, CASE WHEN {crc_sql('doc_id::VARCHAR', 'steps')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed
        FROM documents, crc_table)
), leaves AS (
  SELECT *, row_number() OVER (ORDER BY doc_id, digest) AS k,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx, count(*) OVER (PARTITION BY source) AS total
  FROM hashed
), {_tree('tree', 'leaves')}, tops AS (
  SELECT 0 AS source, source AS name, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS total
  FROM tree WHERE total = 1
), {_tree('top', 'tops')}, begun AS (
  SELECT doc_id, k, source, 0 AS level, idx, '' AS proof, changed AS digest FROM leaves
), {_walk('walk', 'begun', 'tree')}, highest AS (
  SELECT source, max(level) AS level FROM tree GROUP BY source
), over AS (
  SELECT w.doc_id, w.k, 0 AS source, 0 AS level, t.idx, w.proof, w.digest
  FROM walk w JOIN highest h ON h.source IS NOT DISTINCT FROM w.source AND h.level = w.level
  JOIN tops t ON t.name IS NOT DISTINCT FROM w.source
), {_walk('ends', 'over', 'top')}
SELECT l.doc_id, l.digest AS leaf, t.digest AS subroot, r.digest AS root, sha256(e.proof) AS proof_sha256,
  e.digest AS folded_root, e.digest = r.digest AS verified
FROM leaves l JOIN tops t ON t.name IS NOT DISTINCT FROM l.source
JOIN ends e ON e.k = l.k JOIN (SELECT digest, level FROM top WHERE total = 1) r ON e.level = r.level
"""
