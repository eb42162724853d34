"""Secret scans: fixed patterns, and the guess cost of values in credential contexts.

The patterns find assignments, access keys and hexadecimal digests whatever they look like. Beyond
them, a value that stands where a credential would (after a password's name, in a URL's user part, as a
bearer token) is a secret if guessing it is dear enough: its cost is that of the cheapest way to cut it
into words, dates, repeats, keyboard walks and single characters tried by brute force. That tells a
secret from placeholders and prose, such as ``password: required``.

How easily a word is guessed depends on how common it is in the documents themselves, all of them, outside
credential contexts: its rank is the number of words whose count has at least as many binary digits.
Only the parts of candidate values are looked up, by a join; no dictionary is sent around.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree.llm.common import saved, table

# The patterns, in the order of kinds.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "guess")

# Where a credential stands, and its value in the group of that name: quoted, or up to white space.
_VALUE = r"""(?:"(?P<double>[^"\n]+)"|'(?P<single>[^'\n]+)'|(?P<bare>[^\s"'<>]+))"""
_NAMES = (
    "pass(?:word|wd|phrase|code)?|pwd|passwort|contraseña|mot de passe|secret|token|credentials?|auth(?:orization)?"
    "|(?:api|access|private|client|signing)[ _-]?(?:key|secret)"
)
CONTEXTS = (
    re.compile(rf"""(?i:(?<![^\W_])(?:{_NAMES})(?![^\W_])["']?\s{{0,4}}(?::=|=>|[:=])\s{{0,4}}(?:bearer\s|basic\s)?){_VALUE}"""),
    re.compile(rf"(?i:--(?:password|pass|token|secret)[\s=]){_VALUE}"),
    re.compile(rf"(?i:\bbearer\s){_VALUE}"),
    re.compile(r"://[^\s/:@]+:(?P<bare>[^\s/@]+)@"),
)
# A shorter value is no secret, nor one that names where the secret is kept.
LEAST_VALUE = 8
REFERENCE = re.compile(r"^(?:[$%{<(\[]|\w+://)")
TRAILING = ".,;:!?)]}"
# Guesses, as a power of ten, beyond which a value is not found by trying.
GUESSES = 10.0

SHORTEST_WORD, LONGEST_WORD = 3, 20
WORDS = re.compile(rf"[^\W\d_]{{{SHORTEST_WORD},{LONGEST_WORD}}}")
# Signs that stand for letters, and the rows of a keyboard.
LEET = str.maketrans("013457@$!", "oieastasi")
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
KEYS = {c: (x, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
DATES = (
    re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"),
    re.compile(r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1(?:19|20)\d\d"),
    re.compile(r"(?:19|20)\d\d"),
)
DAYS, YEARS = math.log10(365 * 200), math.log10(200)
SEGMENT = math.log10(2)  # each segment doubles the ways to put a guess together
UNIT = 8  # longest part that repeats
FLUSH = 200_000  # words that a task counts before it hands them on
PARTS = 10_000  # parts of a value that a task hands on at once


def character_cost(c: str) -> float:
    """Guesses for one character, as a power of ten, from the set it belongs to."""
    return math.log10(10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 1000)


def folded(value: str) -> str:
    """In lower case, signs that stand for letters replaced; as long as the value itself."""
    lower = "".join(low if len(low := c.lower()) == 1 else c for c in value)
    return lower.translate(LEET)


def parts(value: str, most: int = PARTS) -> Iterator[set[str]]:
    """Every part of a value that could be a word, in sets of some ``most``; a part may be in several."""
    found: set[str] = set()
    for m in re.finditer(r"[^\W\d_]+", folded(value)):
        run = m.group()
        for i in range(len(run)):
            found.update(run[i:i + n] for n in range(SHORTEST_WORD, min(LONGEST_WORD, len(run) - i) + 1))
            if len(found) >= most:
                yield found
                found = set()
    yield found


def word_cost(shown: str, rank: float) -> float:
    """Guesses for a word of this rank as it is shown: capitals and signs for letters double them."""
    lower, upper = shown.lower(), sum(c.isupper() for c in shown)
    capitals = 0 if not upper else 1 if shown[0].isupper() and upper == 1 or upper == len(shown) else upper
    signs = sum(a != b for a, b in zip(lower, lower.translate(LEET)))
    return math.log10(max(rank, 1)) + SEGMENT * (capitals + signs)


def _repeats(value: str) -> list[tuple[int, float]]:
    """(end, cost) of the cheapest repeat that begins at each place, as far as it goes."""
    n, brute = len(value), [character_cost(c) for c in value]
    best = [(0, math.inf)] * n
    for unit in range(1, UNIT + 1):
        same = 0
        for i in range(n - unit - 1, -1, -1):
            same = same + 1 if value[i] == value[i + unit] else 0
            times = same // unit + 1
            if times >= (3 if unit == 1 else 2):
                end, cost = i + unit * times, sum(brute[i:i + unit]) + math.log10(times)
                # The longest counts, then the shortest unit.
                if end > best[i][0]:
                    best[i] = (end, cost)
    return best


def _walks(value: str) -> list[tuple[int, float]]:
    """(end, cost) of the keyboard walk that begins at each place, as far as it goes."""
    # Character by character: some have two in lower case.
    keys = [KEYS.get(c.lower()) for c in value]
    out, length, turns, last = [(0, math.inf)] * len(keys), 1, 0, None
    for i in range(len(keys) - 2, -1, -1):
        a, b = keys[i], keys[i + 1]
        step = (b[0] - a[0], b[1] - a[1]) if a and b else None
        if step is None or step == (0, 0) or max(map(abs, step)) > 1:
            length, turns, last = 1, 0, None
            continue
        length, turns, last = length + 1, turns + (last is not None and step != last), step
        if length >= 3:
            out[i] = (i + length, math.log10(len(KEYS) * length) + turns * math.log10(8))
    return out


def segments(value: str, ranks: dict[str, float]) -> Iterator[list[tuple[int, float]]]:
    """For each place the segments that begin there, as (end, cost), but for single characters."""
    text, repeats, walks = folded(value), _repeats(value), _walks(value)
    for i in range(len(value)):
        found = [x for x in (repeats[i], walks[i]) if x[0]]
        for n in range(SHORTEST_WORD, min(LONGEST_WORD, len(value) - i) + 1):
            rank = ranks.get(text[i:i + n])
            if rank is not None:
                found.append((i + n, word_cost(value[i:i + n], rank)))
        for k, pattern in enumerate(DATES):
            m = pattern.match(value, i)
            if m:
                found.append((m.end(), YEARS if k == 2 else DAYS))
        yield found


def guess_cost(value: str, ranks: dict[str, float]) -> float:
    """Guesses that the cheapest segmentation takes, as a power of ten; ``ranks``: those of its parts."""
    best = [0.0] + [math.inf] * len(value)
    for i, found in enumerate(segments(value, ranks)):
        best[i + 1] = min(best[i + 1], best[i] + character_cost(value[i]))
        for end, cost in found:
            best[end] = min(best[end], best[i] + cost + SEGMENT)
    return best[-1]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind, end) by the patterns: leftmost matches of each kind, short ones left out."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of the values in credential contexts."""
    found = set()
    for pattern in CONTEXTS:
        for m in pattern.finditer(text):
            group = m.lastgroup
            start, value = m.start(group), m.group(group)
            if group == "bare":
                value = value.rstrip(TRAILING)
            if len(value) >= LEAST_VALUE and not REFERENCE.match(value):
                found.add((start, start + len(value)))
    return sorted(found)


_SCANNED = (
    "doc_id long, hash long, base array<struct<start:long,kind:int,end:long>>, "
    "values array<struct<start:long,end:long,value:string>>"
)


def _scan(batches):
    spans = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    values = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
    for batch in batches:
        base, cands = [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in base_spans(text)])
            cands.append([{"start": s, "end": e, "value": text[s:e]} for s, e in candidates(text)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("hash"), pa.array(base, spans), pa.array(cands, values)],
            names=["doc_id", "hash", "base", "values"],
        )


def _vocabulary(batches):
    """Words of the texts outside candidate values, with counts; a word may come several times."""
    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text"):
            text, at = text.as_py() or "", 0
            for start, end in [*candidates(text), (len(text), len(text))]:
                counts.update(WORDS.findall(text[at:start].lower()))
                at = max(at, end)
            if len(counts) >= FLUSH:
                yield rows(counts)
                counts.clear()
    yield rows(counts)


def _parts(batches):
    for batch in batches:
        for key, value in zip(batch.column("key").to_pylist(), batch.column("value")):
            for found in parts(value.as_py()):
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(found), pa.string()), pa.array(found, pa.string())], names=["key", "word"])


def _costs(ranks: dict[int, int]):
    def run(batches):
        for batch in batches:
            out = []
            for value, words in zip(batch.column("value").to_pylist(), batch.column("words").to_pylist()):
                out.append(guess_cost(value, {w["word"]: ranks[w["digits"]] for w in words or []}))
            yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(out, pa.float64())], names=["value", "guesses"])

    return run


def value_costs(docs: DataFrame, values: DataFrame) -> DataFrame:
    """(value, guesses) of the distinct ``values`` (value), with the words of all ``docs``."""
    text = docs.select(F.col("text").cast("string").alias("text"))
    counts = text.mapInArrow(_vocabulary, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = saved(counts.select("word", F.length(F.bin("n")).alias("digits")), "vocabulary")
    # At most 64 classes of counts.
    ranks, total = {}, 0
    for r in counts.groupBy("digits").agg(F.count("*").alias("n")).orderBy(F.desc("digits")).collect():
        total += r.n
        ranks[r.digits] = total
    # Parts go by a key, since a value can be long and has some twenty parts a character.
    values = saved(values.distinct().select(F.sha2("value", 256).alias("key"), "value"), "values")
    met = values.mapInArrow(_parts, "key string, word string").join(counts, "word")
    known = met.groupBy("key").agg(F.collect_set(F.struct("word", "digits")).alias("words"))  # the parts of one value
    return values.join(known, "key", "left").mapInArrow(_costs(ranks), "value string, guesses double")


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, base, values) of every row: spans by the patterns, and values in credential contexts."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(_scan, _SCANNED)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row of ``docs`` (doc_id, text): ``spans`` an array of (start, kind, end, guesses).

    ``kind`` is the place in KINDS; places count characters, the end is exclusive. A span found by a
    pattern stays whatever it costs; ``guesses`` is then that of the dearest candidate value in it, if
    it has one. A candidate that touches no such span is added as a span if its guesses reach GUESSES.
    Null texts are empty; rows that repeat have the same spans each.
    """
    rows = saved(scanned(docs), "scanned")
    keyed = rows.where(F.size("values") > 0).select("doc_id", "hash", "base", "values").distinct()
    each = keyed.select("doc_id", "hash", "base", F.inline("values"))
    costs = saved(value_costs(docs, each.select("value")), "costs")
    met = each.join(costs, "value")
    touched = F.filter("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
    cost = F.col("guesses")
    own = F.when(
        (F.size(touched) == 0) & (cost >= GUESSES),
        F.array(F.struct("start", F.lit(3).alias("kind"), "end", cost.alias("guesses"))),
    ).otherwise(F.transform(touched, lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end"), cost.alias("guesses"))))
    pieces = met.select("doc_id", "hash", F.inline(own))
    best = pieces.groupBy("doc_id", "hash", "start", "kind", "end").agg(F.max("guesses").alias("guesses"))
    priced = best.groupBy(F.col("doc_id").alias("d"), F.col("hash").alias("h")).agg(
        F.collect_list(F.struct("start", "kind", "end", "guesses")).alias("priced")
    )
    joined = rows.join(priced, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h")), "left")
    spans = F.expr(
        """array_sort(concat(coalesce(priced, array()), transform(
             filter(base, b -> NOT exists(coalesce(priced, array()), p -> p.start = b.start AND p.kind = b.kind)),
             b -> named_struct('start', b.start, 'kind', b.kind, 'end', b.end, 'guesses', cast(null AS double)))))"""
    )
    return joined.select("doc_id", spans.alias("spans"))


def _listed(spans: str):
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', array({names})[s.kind], s.start, s.end)), ',')")


def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = find(table(spark, folder, "documents"))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = {k})) AS long)").alias(f"n_{KINDS[k]}") for k in range(3)]
    base = F.sha2(_listed("filter(spans, s -> s.kind < 3)"), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), _listed("spans").alias("spans"))
