"""The corpus operators against plain Python and SQL, with the awkward inputs of each."""

import itertools
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lawtree.llm import (
    bytecnn, embeddup, lattice, licenses, linedup, mixing, pieces, queries, simhash, topk, toxicity,
)
from lawtree.llm.common import components, held_out

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, component string"


def documents(spark, rows):
    """Documents with two columns whose names clash with those of the operators."""
    full = [(i, t, "en", s, None if t is None else len(t), "x", "y") for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


AWKWARD = [
    (1, "one two three four five six", "b"), (2, "one two three four five seven", "a"),
    (2, "one two three four five seven", "a"), (3, None, None), (4, "", "a"), (None, "alpha beta", "b"),
    (5, " \n\t\n", None), (6, "word " * 30_000, "b"), (7, "ÄÖ ▁▁ 日本 \x00 😀", "é"), (8, "x", "a"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return documents(spark, AWKWARD).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark, [])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cursor = db.execute(queries.ORACLES[name])
    names = [c[0] for c in cursor.description]
    df = queries.QUERIES[name](spark, FOLDER)
    assert sorted(names) == sorted(df.columns)
    assert Counter(map(tuple, df.select(names).collect())) == Counter(cursor.fetchall())


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for a, b in edges if a != b for n in (a, b)}


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")


def test_topk(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-9, 9, 6).tolist()) for i in range(120)] + [(50, [0] * 6), (50, [1, 2]), (200, [0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, weights array<long>")
    got = topk.search(df, F.col("vec_id") % 50 == 0, shard=40, queries=2).collect()
    want = Counter()
    for q, (own, x) in enumerate(rows):
        if own % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for c, (i, y) in enumerate(rows) if c != q)
            want.update((own, k, i, -s) for k, (s, i) in enumerate(scored[:5], 1))
    assert Counter((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want
    assert topk.search(df.limit(0), F.lit(True)).count() == 0
    assert topk.search(df.limit(1), F.lit(True)).count() == 0


@pytest.mark.parametrize("factor", [1, 2**26])
def test_topk_of_strips(spark, factor):
    """More queries than traverse a shard together; with the factor, sums of weights that doubles would round."""
    rng = np.random.default_rng(4)
    rows = [(i, [int(x) * factor + int(y) for x, y in rng.integers(-9, 9, (6, 2))]) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, weights array<long>")
    got = topk.search(df, F.lit(True), k=3, shard=60, queries=80).collect()
    want = Counter()
    for own, x in rows:
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != own)
        want.update((own, k, i, -s) for k, (s, i) in enumerate(scored[:3], 1))
    assert Counter((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want


def test_topk_copies_no_queries(spark):
    """Blocks of queries meet all shards without a copy for each, which Spark would broadcast as if it were one."""
    rows = [(i, [i % 7, -(i % 5), i % 3]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, weights array<long>")
    found = topk.search(df, F.col("vec_id") % 50 == 0, shard=8, queries=2)
    got = Counter((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan
    want = Counter()
    for own, x in rows[::50]:
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != own)
        want.update((own, k, i, -s) for k, (s, i) in enumerate(scored[:5], 1))
    assert got == want


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 8))
    near = [(base[i % 12] + rng.normal(scale=0.2, size=8)).tolist() for i in range(150)]
    rows = [(i, v) for i, v in enumerate(near)] + [
        (900, None), (901, [0.0] * 8), (902, [math.nan] + [1.0] * 7), (903, [None] + [1.0] * 7), (904, []),
        (905, near[0]), (905, near[0]), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (None, near[5]),
    ]
    got = embeddup.near_duplicates(vectors(spark, rows), block=32).collect()
    linkable = [v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    parent = list(range(len(rows)))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    links = Counter()
    for i, j in itertools.combinations([k for k, ok in enumerate(linkable) if ok], 2):
        x, y = np.array(rows[i][1]), np.array(rows[j][1])
        if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
            links[i] += 1
            links[j] += 1
            parent[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for k, (i, _) in enumerate(rows):
        ids.setdefault(find(k), []).append(i)
    want = Counter()
    for k, (i, _) in enumerate(rows):
        component = min((x for x in ids[find(k)] if x is not None), default=None)
        want[(i, links[k], component, i == component)] += 1
    assert Counter(map(tuple, got)) == want
    assert embeddup.near_duplicates(vectors(spark, [])).count() == 0


def test_embeddings_of_any_length(spark):
    """Squares of these components overflow or vanish in double precision."""
    rows = [(1, [1e200, 2e200]), (2, [1e200, 2.001e200]), (3, [1e-200, 2e-200]), (4, [5e-324, 0.0]), (5, [3e307, 0.0]), (6, [0.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddup.near_duplicates(vectors(spark, rows)).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6)}


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, awkward, nothing):
    got = {(r.doc_id, r.fp & (1 << 64) - 1): r.component_id for r in simhash.near_duplicates(awkward).collect()}
    assert {k for k in got} == {(i, plain_fingerprint(t)) for i, t, _ in AWKWARD}
    assert got[(3, 0)] == got[(4, 0)] == got[(5, 0)] == 3
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.stage(spark, awkward, FOLDER)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [1, 2, 3, 6, 7, 8]


def test_simhash_shared_ids(spark):
    """Rows that share an id and differ in text, in two components or beside a smaller id."""
    rng = np.random.default_rng(9)
    a, b, c = (" ".join(f"w{x}" for x in rng.integers(0, 999, 80)) for _ in range(3))
    rows = [(1, a, "s"), (1, b, "s"), (2, a, "s"), (2, c, "s"), (3, c, "t"), (3, c, "s")]
    for order in (rows, rows[::-1]):
        kept = simhash.stage(spark, documents(spark, order).repartition(3), FOLDER)
        assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, a), (1, b), (2, c)])
    twice = [[r.source for r in simhash.stage(spark, documents(spark, x), FOLDER).collect()] for x in (rows[4:], rows[:3:-1])]
    assert twice[0] == twice[1] and len(twice[0]) == 1


def test_simhash_null_ids(spark):
    """A null id gives way to any other; of a component without ids one row stays."""
    rng = np.random.default_rng(12)
    a, b = (" ".join(f"w{x}" for x in rng.integers(0, 999, 80)) for _ in range(2))
    rows = [(1, a, "s"), (None, a, "s"), (None, a, "t"), (None, b, "t"), (None, b, "s")]
    kept = simhash.stage(spark, documents(spark, rows), FOLDER).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, a), (0, b)])


def test_simhash_links(spark):
    rng = np.random.default_rng(4)
    prints = {int(x) for x in rng.integers(-(1 << 62), 1 << 62, 300)}
    for p in list(prints)[:40]:
        for _ in range(12):
            p ^= 1 << int(rng.integers(0, 62))
            prints.add(p)
    prints |= {x << 1 for x in range(200)}
    values = sorted(prints)
    found = components(simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"))).collect()
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 2:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {v: v for v in values} | {r.node: r.component for r in found}
    assert got == {v: find(v) for v in values}


def test_lattice_sums_all_segmentations():
    begin, inner = {b"a": 0.5, b"ab": 0.3, b"": 0.2}, {b"a": 0.25, b"b": 0.5, b"ba": 0.25}
    model = lattice.Lattice(begin, inner, 0.4)

    def total(word, shares):
        if not word:
            return 0.4
        return sum(0.6 * p * total(word[len(x):], inner) for x, p in shares.items() if word.startswith(x))

    for word in (b"a", b"ab", b"aba", b"abab", b"bbbb"):
        want = sum(p * total(word[len(x):], inner) for x, p in begin.items() if word.startswith(x))
        assert math.isclose(math.exp(model.log_probability(word)), want, rel_tol=1e-9)
    used = ({}, {})
    model.expect(b"aba", *used)
    assert math.isclose(sum(used[0].values()), 1.0)
    assert model.log_probability(b"z") == float("-inf")


def test_lattice_score(spark, awkward, nothing):
    got = lattice.score(awkward.withColumn("held_out", held_out(F.col("doc_id"), 7, 2))).collect()
    counts = Counter()
    for i, t, _ in AWKWARD:
        if zlib.crc32(str(i).encode()) % 7 != 2 or i is None:
            counts.update((t or "").encode().lower().split() + [None])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t, _ in AWKWARD:
        tokens = (t or "").encode().lower().split() + [None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        want[(i, len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 6))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(-1e6 < r.score <= 0 for r in got)
    assert lattice.score(nothing.withColumn("held_out", F.lit(False))).count() == 0


def test_lattice_beats_the_base(spark):
    rows = queries.QUERIES["op2_lattice_score"](spark, "/root/testdata/sf0.1").where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def labelled(spark, name):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return queries.QUERIES[name](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out").collect()


def test_quality(spark, awkward, nothing):
    rows = labelled(spark, "op3_quality_classifier")
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows)
    net = bytecnn.Network.initial()
    for text in ("", "a", "ab" * 300, "x" * 5000):
        data = text.encode()
        pieces_ = bytecnn.chunks(data)
        windows = {bytes(p[i:i + bytecnn.WIDTH]) for p in pieces_ for i in range(bytecnn.STEP)}
        assert all(data[i:i + bytecnn.WIDTH] in windows for i in range(max(0, len(data) - bytecnn.WIDTH + 1)))
        slow = sum(net.filters[k][pieces_[:, k:k + bytecnn.STEP]] for k in range(bytecnn.WIDTH)).max(axis=1)
        assert np.allclose(np.tanh(slow + net.bias), net.pooled(pieces_), atol=1e-5)
    scores = bytecnn.score(awkward, net).collect()
    assert len(scores) == len(AWKWARD) and all(0 <= r.score <= 1 for r in scores)
    assert bytecnn.score(nothing, net).count() == 0
    no_labels = spark.createDataFrame([], "doc_id long, label int")
    assert bytecnn.fitted(awkward, no_labels).offset == 0.0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton():
    terms = ["idiot", "scum", "worthless", "loser", "idle"]
    automaton, rng = toxicity.Automaton(terms), np.random.default_rng(5)
    words = ["idiot", "idot", "idioot", "scum", "scm", "wrthles", "worthles", "losers", "", "ido"]
    for _ in range(400):
        w = list(terms[rng.integers(5)])
        for _ in range(rng.integers(4)):
            at = int(rng.integers(len(w) + 1))
            w[at:at + int(rng.integers(2))] = "abcdeilorst"[rng.integers(11)] * int(rng.integers(2))
        words.append("".join(w))
    for word in words:
        near = [(distance(t, word), i) for i, t in enumerate(terms) if distance(t, word) <= toxicity.allowed(t)]
        want = min(near)[::-1] if near else None
        assert automaton.match(word) == want, word
    assert toxicity.Automaton(["stem*"]).match("stemming") == (0, 0)
    assert toxicity.Automaton([]).match("word") is None


def test_toxicity(spark, awkward, nothing):
    rows = labelled(spark, "op8_toxicity")
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)
    bad, good = ([r for r in rows if r.toxic == k] for k in (1, 0))
    assert sum(r.predicted for r in bad) >= 0.5 * len(bad) and sum(r.predicted for r in good) <= 0.02 * len(good)
    ranks = [(x.score > y.score) + 0.5 * (x.score == y.score) for x in bad for y in good]
    assert sum(ranks) >= 0.75 * len(ranks)
    scanner = toxicity.Scanner(["idiot"])
    for text, quoted in (
        ('"idiot, you fool', False), ('you idiot" he', False), ('say "idiot", now', True), ('"a b" idiot "c d"', False), ('"a b" c "an idiot d."', True),
    ):
        assert (scanner.features(text)[toxicity.FEATURES.index("quoted")] > 0) == quoted, text
    plain, quoted = scanner.features("you are an idiot"), scanner.features('he said "what an idiot" again')
    at = dict(zip(toxicity.FEATURES, range(len(toxicity.FEATURES))))
    assert plain[at["quoted"]] == 0 < quoted[at["quoted"]] and plain[at["addressed"]] == 1
    assert scanner.features("an idiott") [at["fuzzy"]] > 0
    model = toxicity.fitted(awkward, spark.createDataFrame([], "doc_id long, label int"))
    assert toxicity.score(awkward, model).count() == len(AWKWARD) and toxicity.score(nothing, model).count() == 0


def test_licenses(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.txt", "words"), ("a/y.txt", None),
        ("a/b/COPYING", "x\nLicensed under the Apache License, Version 2.0.\n"), ("z/own.txt", "Licensed under CC BY-NC 4.0.\nmore"),
        ("z/none.txt", ""), (None, "words"), ("a/y.txt", "licensed to nobody in particular, one way or another, at any time"),
    ]
    files = spark.createDataFrame([(p, t, 1) for p, t in rows], "path string, text string, score int")
    got = licenses.scan(files).collect()
    assert [r.license for r in got if r.path == "a/b/c/x.txt"] == ["Apache-2.0"]
    assert {(r.path, r.license, r.inherited_from) for r in got} == {
        ("a/LICENSE", "MIT", None), ("a/b/c/x.txt", "Apache-2.0", "a/b"), ("a/y.txt", "MIT", "a"),
        ("a/b/COPYING", "Apache-2.0", None), ("z/own.txt", "CC-BY-NC-4.0", None), ("z/none.txt", None, None), (None, None, None),
    }
    assert licenses.scan(files.limit(0)).count() == 0


def test_licenses_reserved(spark):
    """Reserved rights are a notice of their own and block inheritance."""
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/x.txt", "words\nAll rights reserved.\nmore"), ("a/y.txt", "words"),
        ("a/z.txt", "All rights reserved.\nReleased under the MIT License."), ("b/x.txt", "rights reserved by nobody for any of the words here"),
    ]
    got = licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()
    assert {(r.path, r.license, r.inherited_from) for r in got} == {
        ("a/LICENSE", "MIT", None), ("a/x.txt", "Reserved", None), ("a/y.txt", "MIT", "a"), ("a/z.txt", "MIT", None), ("b/x.txt", None, None),
    }


def plain_matches(files):
    """{(path, text): (score, license)} of the best match, every line and every licence file against every template."""
    texts = [set(licenses.terms(t or "")) for _, t in files]
    n = len(files)
    idf = {t: math.log((n + 1) / (sum(t in x for x in texts) + 1)) + 1 for t in licenses.VOCABULARY}
    vector = lambda part: {t: c * idf.get(t, math.log(n + 1) + 1) for t, c in Counter(licenses.terms(part)).items()}
    out = {}
    for path, text in files:
        parts = (text or "").split("\n") + ([text or ""] if path.rpartition("/")[2].startswith(("LICENSE", "COPYING")) else [])
        found = []
        for x in filter(None, map(vector, parts)):
            for name, template in licenses.TEMPLATES:
                y = vector(template)
                dot = sum(w * y.get(t, 0) for t, w in x.items())
                score = round(dot / math.sqrt(sum(w * w for w in x.values()) * sum(w * w for w in y.values())), 9)
                found += [(-score, name)] if score >= licenses.MATCH else []
        if found:
            out[path, text] = min(found)
    return out


def test_licenses_brute_force(spark):
    """No line is left out before its cosine: notices without the word licence match too."""
    rows = [
        ("a/1.txt", "Released under the MIT."), ("a/2.txt", "Under the Apache, Version 2.0."), ("a/3.txt", "CC BY-SA 4.0"),
        ("a/4.txt", "the version of the work\nto any person, free of charge"), ("a/5.txt", "SPDX-License-Identifier: MPL-2.0"),
        ("a/6.txt", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0."),
        ("a/LICENSE", "Permission is hereby granted,\nfree of charge, to any person\nobtaining a copy"), ("a/7.txt", None),
        ("a/8.txt", "dedicated to the public domain under CC0 1.0 Universal"), ("a/9.txt", "apples and pears " * 50 + "MIT License"),
        ("b/COPYING", "GNU Lesser General Public License, version 3"), ("b/1.txt", "licensed under the GNU General Public License, version 3"),
        ("b/2.txt", "mit mit mit MIT mit"), ("b/3.txt", ""), ("b/4.txt", "and with the or for"), ("b/5.txt", "All rights reserved"),
    ]
    got = licenses.matches(spark.createDataFrame(rows, "path string, text string")).collect()
    expected = plain_matches(rows)
    texts = dict(rows)
    assert {(r.path, texts[r.path]): (-r.score, r.license) for r in got} == expected
    assert expected["a/1.txt", texts["a/1.txt"]][1] == "MIT" and len(expected) > 8


def cut_in_filters(df, cut):
    """Filters of the optimized plan that hold ``cut``: they do it again for each row, apart from what follows."""
    return [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x and cut in x]


def test_licenses_cut_once(spark):
    """The terms of a line are cut once, not again for each place where the bound needs them."""
    files = spark.createDataFrame([("a/LICENSE", "Released under the MIT License.\nwords"), ("a/x", None)], "path string, text string")
    found = licenses.matches(files)
    assert not cut_in_filters(found, "split(lower(") and [r.license for r in found.collect()] == ["MIT"]


def test_licenses_clashing_names(spark):
    """Columns named like inner ones are kept, columns named like the results are replaced."""
    schema = "near string, path string, `__own` int, hash int, text string, license string, dir string, `a.b` string, o string"
    rows = [("n", "a/LICENSE", 1, 2, "Released under the MIT License.", "x", "d", "e", "o"), ("n", "a/b.txt", 1, 2, "words", "x", "d", "e", "o")]
    got = licenses.scan(spark.createDataFrame(rows, schema))
    assert got.columns == ["near", "path", "__own", "hash", "text", "dir", "a.b", "o", *licenses.RESULT]
    assert {tuple(r)[:1] + tuple(r)[5:9] for r in got.collect()} == {("n", "d", "e", "o", "MIT")}
    assert {r.inherited_from for r in got.collect()} == {None, "a"}


def test_encoding(spark, awkward, nothing):
    got = pieces.encode(awkward).collect()
    assert len(got) == len(AWKWARD) and all(r.round_trip for r in got)
    encoder = pieces.Encoder(pieces.vocabulary())
    texts = Counter(r.text for r in pieces.decode(pieces.encode(awkward)).collect())
    assert texts == Counter(t or "" for _, t, _ in AWKWARD)
    assert pieces.encode(nothing).count() == 0
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for text in ("The quick brown fox", "Hello, world. This is a test"):
        assert list(encoder.encode(text)[0]) == library.encode(text)
    shares = [math.exp(s) for p, s, b in encoder.entries if p and not b and s > pieces.UNUSABLE]
    assert sum(shares) == pytest.approx(1, abs=1e-4)
    scores = {p.replace("▁", " "): s for p, s, b in encoder.entries if p and not b and s > pieces.UNUSABLE}
    scores.setdefault(" ", min(scores.values()))

    def best(text):
        top = [0.0] + [-math.inf] * len(text)
        for j in range(1, len(text) + 1):
            for i in range(max(0, j - 16), j):
                gain = scores.get(text[i:j], encoder.unknown if j - i == 1 else -math.inf)
                top[j] = max(top[j], top[i] + gain)
        return top[-1]

    for text in ("Hello, world", "  two  spaces ", "unbelievable 日本語 ☃!", "a,b;c: d?e", "tab\tline\nend"):
        assert encoder.encode(text)[1] == best(" " + text)
        assert encoder.decode(encoder.encode(text)[0]) == text
    assert sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL).decode(list(encoder.encode("Hello, world")[0])) == "Hello, world"


def test_mixing(spark, awkward, nothing):
    mix = mixing.Mix(awkward, block=8, shard=16)
    got = mix.taken().collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        assert r.taken <= 3 * r.size
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.Mix(awkward, block=8, shard=16).taken().collect()))
    by_source = Counter()
    for r in got:
        by_source[r.src] += r.taken
    for src, target in enumerate(mix.targets):
        assert abs(by_source[src] - target) <= 16
    assert mixing.Mix(nothing).taken().count() == 0
    out = mixing.stage(spark, awkward, FOLDER)
    assert out.columns == awkward.columns and out.where("text = ''").count() == 0
    size = sum(len((r.text or "").encode().split()) for r in out.collect())
    assert size == sum(r.taken for r in got) or abs(size - sum(mix.targets)) <= 64 * 4


def test_mixing_keeps_sources(spark):
    """One id and text from two sources: each source's words stay its own."""
    text = " ".join(f"w{i}" for i in range(300))
    docs = documents(spark, [(1, text, "a"), (1, text, "b"), (1, text, None), (2, text, "a")])
    words = Counter()
    for r in mixing.stage(spark, docs, FOLDER).collect():
        words[r.source] += len(r.text.split())
    mix = mixing.Mix(docs)
    assert words.keys() == {"a", "b", None}
    for source, target in zip(("a", "b", None), mix.targets):
        assert abs(words[source] - target) <= 2 * mixing.BLOCK


def test_draw_travels_by_value():
    """Tasks need no copy of the package: the draw names no module of it."""
    from pyspark import cloudpickle
    data = cloudpickle.dumps(mixing.Draw([5, 6], 4, 1)) + cloudpickle.dumps(mixing._slots([5], [5], 4, 1))
    found = __import__("subprocess").run(
        [__import__("sys").executable, "-c", "import pickle, sys; pickle.load(sys.stdin.buffer); print('lawtree' in sys.modules)"],
        input=data, capture_output=True, cwd="/",
    )
    assert found.stdout == b"False\n", found.stderr


def test_mixing_parts():
    assert mixing.targets([100, 100, 100]) == [50.0, 100.0, 150.0]
    assert mixing.targets([10, 0, 90]) == [25.0, 0.0, 75.0] and mixing.targets([]) == []
    capped = mixing.targets([1000, 1, 5])
    assert capped[1:] == [3.0, 15.0] and math.isclose(sum(capped), 1006)
    for n in (1, 2, 7, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, (1, 2, 3))) == list(range(n))
    draw = mixing.Draw([100, 0, 333, 7], 16, 1)
    total = np.zeros(4, int)
    for k in range(draw.shards):
        before, counts = draw.of(k)
        assert (before == total).all()
        total += counts
        assert counts.sum() == min(16, 440 - 16 * k)
    assert total.tolist() == [100, 0, 333, 7]


def test_draw_follows_the_hypergeometric_law():
    counts, take = np.array([30, 0, 50, 20]), 25
    rng = np.random.default_rng(3)
    got = np.array([mixing.half(counts, take, rng) for _ in range(20_000)])
    assert (got.sum(axis=1) == take).all() and (got >= 0).all() and (got <= counts).all()
    mean = take * counts / 100
    spread = mean * (1 - counts / 100) * (100 - take) / 99
    assert np.allclose(got.mean(axis=0), mean, atol=0.06)
    assert np.allclose(got.var(axis=0), spread, atol=0.15)


@pytest.mark.parametrize("total", [0, 1, 7, 10**9, 10**13, 10**17])
def test_draw_of_any_size(total):
    counts = np.array([total // 2, 0, total // 3, total - total // 2 - total // 3])
    rng = np.random.default_rng(4)
    for take in (0, total // 5, total // 2, total):
        got = mixing.half(counts, take, rng)
        assert got.sum() == take and (got >= 0).all() and (got <= counts).all()
        if total:
            # Within six standard deviations.
            mean = counts * (take / total)
            assert (np.abs(got - mean) <= 6 * np.sqrt(mean) + 3).all()


def plain_dropped(rows):
    """Numbers of the lines that each document loses."""
    lines = sorted(
        ((i is not None, i or 0, zlib.crc32(t.encode())), k, tuple(line.encode().split()), d)
        for d, (i, t) in enumerate(rows) if t is not None for k, line in enumerate(t.split("\n"))
    )
    gone, seen = Counter(), []
    for _, k, words, d in lines:
        if not words:
            continue
        near = any(w == words or min(len(w), len(words)) >= 5 and abs(len(w) - len(words)) <= 1 and distance(w, words) <= 1 for w in seen)
        seen.append(words)
        if near:
            gone[(d, k)] += 1
    return gone


def test_lines(spark, nothing):
    rng = np.random.default_rng(6)
    base = [[f"w{x}" for x in rng.integers(0, 9, n)] for n in (1, 4, 5, 6, 7, 8, 15, 16, 17, 127, 128, 129, 130, 300)]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(4):
            w = list(base[rng.integers(len(base))])
            for _ in range(rng.integers(3)):
                at = int(rng.integers(len(w) + 1))
                w[at:at + int(rng.integers(2))] = [f"w{rng.integers(9)}"] * int(rng.integers(2))
            lines.append(" ".join(w))
        texts.append("\n".join(lines))
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (102, "\n\n"), (None, "w1 w2\nw1 w2")]
    df = documents(spark, [(i, t, "s") for i, t in rows])
    got = {r.doc_id: r.dropped for r in linedup.dropped(df).collect()}
    want = {}
    for (d, k) in plain_dropped(rows):
        want.setdefault(rows[d][0], []).append(k)
    assert got == {i: sorted(ks) for i, ks in want.items()}
    out = linedup.dedup(df)
    assert out.columns == df.columns + ["n_dropped"] and out.count() == len(rows)
    left = {r.doc_id: r.text for r in out.collect()}
    assert left[100] is None and left[101] == "" and left[102] == "\n\n" and left[None] == "w1 w2"
    twice = documents(spark, [(1, "a b\nc", "s"), (1, "a b\nc", "s"), (2, "c", "s")])
    assert sorted(r.text for r in linedup.dedup(twice).collect()) == ["", "a b\nc", "a b\nc"]
    assert linedup.dedup(nothing).count() == 0


def test_lines_cut_once(spark):
    """Words are cut and a text is hashed once, whatever white space parts the words."""
    rows = [(1, "a b\n  a\tb \n\x0b\r \na\x0cb\rc\n\u00a0a b"), (2, ""), (3, None)]
    keyed = linedup.keyed_lines(linedup.lines(documents(spark, [(i, t, "s") for i, t in rows])))
    plan = keyed._jdf.queryExecution().optimizedPlan().toString().splitlines()
    hashed = [k for k, x in enumerate(plan) if "xxhash64(text" in x]
    assert not cut_in_filters(keyed, "split(") and min(hashed) > max(k for k, x in enumerate(plan) if "Generate" in x)
    got = keyed.collect()
    assert sorted((r.doc_id, r.line_no, r.n) for r in got) == [(1, 0, 2), (1, 1, 2), (1, 3, 3), (1, 4, 2)]
    assert len({(r.a, r.b) for r in got}) == 3


def test_similar_lines(spark):
    """The growing bound of the stage, against all pairs of lines."""
    rng = np.random.default_rng(8)
    base = [[f"w{x}" for x in rng.integers(0, 40, n)] for n in (8, 9, 10, 11, 14, 15, 19, 24, 29, 50, 64, 104, 300)]
    base += [["the"] * 10, ["the"] * 25]
    texts = []
    for _ in range(80):
        lines = []
        for _ in range(3):
            w = list(base[rng.integers(len(base))])
            for _ in range(rng.integers(2 + len(w) // 4)):
                at = int(rng.integers(len(w) + 1))
                w[at:at + int(rng.integers(2))] = [f"w{rng.integers(9)}"] * int(rng.integers(2))
            lines.append(" ".join(w))
        texts.append("\n".join(lines))
    rows = list(enumerate(texts))
    got = {(r.doc_id, k) for r in linedup.dropped(documents(spark, [(i, t, "s") for i, t in rows]), 5).collect() for k in r.dropped}
    want, seen = set(), []
    for i, t in rows:
        for k, line in enumerate(t.split("\n")):
            w = line.split()
            near = (distance(v, w) * 5 <= max(len(v), len(w)) and min(len(v), len(w)) >= 5 for v in seen)
            if w and (w in seen or any(near)):
                want.add((i, k))
            seen.append(w)
    assert got == want
    words = [f"v{x}" for x in range(50)]
    copy = [*words[:9], "other", *words[10:30], "one", *words[31:]]
    out = linedup.stage(spark, documents(spark, [(1, " ".join(words), "s"), (2, " ".join(copy), "s")]), FOLDER)
    assert [r.doc_id for r in out.collect()] == [1]


def test_unlike_pairs_bring_no_text(spark, monkeypatch):
    """Long lines that share a phrase and little else are told apart before their texts meet; a copy among them goes."""
    stored, saved = Counter(), linedup.saved

    def counted(df, name):
        out = saved(df, name)
        stored[name] += out.count()
        return out

    monkeypatch.setattr(linedup, "saved", counted)
    rng = np.random.default_rng(9)
    phrase = [f"averyveryverylongword{k}" for k in range(51)]
    lines = [phrase + [f"w{x}" for x in rng.integers(0, 100_000, 34)] for _ in range(30)]
    lines.append([*lines[0][:-10], *(f"v{x}" for x in range(10))])
    got = linedup.dropped(documents(spark, [(i, " ".join(w), "s") for i, w in enumerate(lines)]), 5).collect()
    assert [r.doc_id for r in got] == [30] and stored["pairs"] > 50 and 1 <= stored["alike"] < 10


def test_long_lists_make_few_pairs(spark, monkeypatch):
    """Lines that share a phrase, in more lists than are looked back in, make few pairs, and each line with an earlier near copy goes."""
    stored, saved = Counter(), linedup.saved

    def counted(df, name):
        out = saved(df, name)
        stored[name] += out.count()
        return out

    monkeypatch.setattr(linedup, "saved", counted)
    monkeypatch.setattr(linedup, "LOOK", 4, raising=False)
    rng = np.random.default_rng(10)
    phrase = [f"averyveryverylongword{k}" for k in range(51)]
    lines = []
    for _ in range(70):
        own = [f"w{x}" for x in rng.integers(0, 100_000, 34)]
        cut = int(rng.integers(35))
        lines.append(own[:cut] + phrase + own[cut:])
    for k in (0, 3, 40, 69):
        at = lines[k].index(phrase[0])
        lines.append([*lines[k][:at], "more", *(f"v{x}" for x in range(5)), *lines[k][at + 7:]])
    # Places beyond those that a key holds, and a pair that comes again.
    words = [f"u{x}" for x in rng.integers(0, 30, 1200)]
    lines += [words, ["new", *words[:700], *(f"v{x}" for x in range(90)), *words[800:]]]
    got = linedup.dropped(documents(spark, [(i, " ".join(w), "s") for i, w in enumerate(lines)]), 5).collect()
    want = [k for k, w in enumerate(lines) if k >= 70 and any(distance(v, w) * 5 <= max(len(v), len(w)) for v in lines[:k])]
    assert sorted(r.doc_id for r in got) == want == [70, 71, 72, 73, 75] and stored["pairs"] < 600


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    rows = out.collect()
    assert rows and all(r.round_trip for r in rows)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "mix_sources", "sentencepiece"
    ]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    net = bytecnn.quality_model(spark, FOLDER, docs)
    kept = bytecnn.stage(spark, docs, FOLDER)
    accepted = {r.doc_id for r in docs.collect() if net.probability((r.text or "").encode()) >= bytecnn.THRESHOLD}
    assert {r.doc_id for r in kept.collect()} == accepted and kept.columns == docs.columns


def test_stages_keep_awkward_documents(spark, awkward, nothing):
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, awkward, FOLDER).columns == awkward.columns, name
        assert stage(spark, nothing, FOLDER).count() == 0, name
