"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

Lines are sequences of words and an edit inserts, deletes or replaces one word. Every line is
kept only where it occurs first: a later line that equals it, or for lines of at least MIN_WORDS
words is one edit away, goes. (One edit in five words leaves a similarity of 0.8.) On request, as in
the pipeline, the bound grows with the length: a later line goes if the longer of the two has at
least ``share`` words for each edit.

The neighbourhood of a line holds, for each place i, the line without word i and the line cut
there, each as a hash of the words before and after the place. Two lines share a variant of the
same place exactly if one edit there turns one into the other: equal variants need no comparison of
pairs, the earliest line under a key stands for all, and the edit is verified on that one.

Variants are many, so lines without a partner are set aside first, and exactly: one edit in the longer
of two lines, of m words, leaves its first m // 2 words or the others alone, so a line that shares
neither half, for its own length or one word more, with any other different line has no neighbour.

For the growing bound, an edit takes away at most two of a line's pairs of adjacent words. In any fixed
order, fewer pairs than that come before the least pair that two such lines have in common, so both
have it among as many first pairs (``_first_pairs``). The order has frequent pairs last, by counts in a sketch
of fixed size (``_heat``), and among the others the longest words first: they are rare. So a pair that very many
lines share is a key only of lines that hold little else. Lines that meet under a pair
carry the pair's place and the parities of their words by 64 classes. The places before and after the pair differ by
the bound at most, as no fewer words are inserted or deleted there, and an edit changes two parities at most; lines that
differ in more are not compared, nor are lines whose parities by 256 classes differ in more, which are looked up before any text is
sent along. The others are verified by their word edit distance, first against the earliest
line there, which settles groups of copies without comparing all of them, then against every earlier one. The
nearest LOOK earlier lines are looked at where the list is made, and a row stands for a line that fits some of
them, not for each line of a list; only lists that go on beyond are joined with themselves, by the 256 classes too, and there
two lines of several lists mostly meet only once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lawtree.llm.common import freed, saved, table

MIN_WORDS = 5
# The growing bound of the pipeline: one edit for so many words, a similarity of 0.8.
SHARE = 5
# Lines up to so many words have their variants made in the row; the words of longer ones become
# rows, with running hashes.
IN_ROW = 128
# Longs in the bitmap that tells which lines may be needed as text: two megabytes, however many lines.
BITMAP = 1 << 17
# Cells of the sketch that counts word pairs, sixteen to a long: half a megabyte.
CELLS = 1 << 20
# Longs of parities by which pairs are compared before their texts: 256 classes of words.
PARITIES = 4
# Earlier lines of a list that a line is compared with where the list is made; a join compares it with those before them.
LOOK = 64
# Keys of its lists that a line carries to such a join.
KEYS = 8
# Places of a pair from 0 that fit into ten bits of its key; beyond, or if the pair comes again, a place is unknown.
PLACES = 1023


def _position() -> Column:
    return F.struct("doc_id", "hash", "line_no")


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, line_no, line) of every line; ``hash`` is that of the document's text.

    Rows that repeat a doc_id and text are the same lines, and are kept or cut alike.
    """
    # Below the generator the text is hashed once, not again for each of its lines.
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")
    return hashed.select("doc_id", "hash", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _words_sql(line: str) -> str:
    """SQL: the words of a line. Other white space becomes a space first: one character is found without a regular expression."""
    blank = rf"CASE WHEN {line} RLIKE '[\\x09-\\x0D]' THEN regexp_replace({line}, '[\\x09-\\x0D]', ' ') ELSE {line} END"
    return f"array_remove(split({blank}, ' '), '')"


def _words(line: str) -> Column:
    return F.expr(_words_sql(line))


def _of_words(condition: str) -> Column:
    """A condition on the words p.x of ``line`` and p.y of ``line2``; the one-element array has both cut only once."""
    pair = f"named_struct('x', {_words_sql('line')}, 'y', {_words_sql('line2')})"
    return F.expr(f"exists(array({pair}), p -> {condition})")


def _half_keys(words: str, n: str) -> Column:
    """Hashes of both halves of a line, as the longer of two lines and as the shorter one."""
    keys = []
    for longer in (F.col(n), F.col(n) + 1):
        first = F.floor(longer / 2).cast("int")
        last = longer - first
        keys.append(F.xxhash64(F.lit(0), longer, F.slice(words, F.lit(1), first)))
        keys.append(F.xxhash64(F.lit(1), longer, F.slice(words, F.col(n) - last + 1, last)))
    return F.array(*keys)


def keyed_lines(rows: DataFrame) -> DataFrame:
    """Position, key (a, b) and half keys of every line that has words. The one pass that splits them."""
    # Words are one generated row, which no filter on them is pushed below: it would cut the line again.
    split = rows.withColumn("words", F.explode(F.array(_words("line")))).withColumn("n", F.size("words")).where("n > 0")
    return split.select(
        "doc_id", "hash", "line_no", F.xxhash64("words").alias("a"), F.xxhash64(F.lit(1), F.col("words")).alias("b"), "n",
        F.when(F.col("n") >= MIN_WORDS, _half_keys("words", "n")).alias("ends"),
    )


def distinct_lines(keyed: DataFrame) -> DataFrame:
    """One row per distinct line: its key, first position, number of words and half keys."""
    return keyed.groupBy("a", "b").agg(F.min(_position()).alias("at"), F.min("n").alias("n"), F.min("ends").alias("ends"))


def partnered(distinct: DataFrame) -> DataFrame:
    """(a, b, at, n) of the lines that share a half with another line."""
    ends = distinct.where("ends IS NOT NULL").select("a", "b", "at", "n", F.explode("ends").alias("end"))
    shared = ends.groupBy("end").agg(F.count("*").alias("lines")).where("lines > 1")
    return ends.join(shared.select("end"), "end", "left_semi").select("a", "b", "at", "n").distinct()


def _variants_in_row(some: DataFrame) -> DataFrame:
    """Variants (no, key) of lines with ``words``, by slices of the array of their hashes."""
    before = "xxhash64(slice(h, 1, i))"
    after = "xxhash64(slice(h, i + {skip}, n - i))"
    variants = F.expr(
        f"""flatten(transform(sequence(0, n), i -> array(
              xxhash64(i, {before}, {after.format(skip=1)}),
              CASE WHEN i < n THEN xxhash64(i, {before}, {after.format(skip=2)}) END)))"""
    )
    hashed = some.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    return hashed.select("no", F.explode(variants).alias("key")).where("key IS NOT NULL")


def _variants_by_word(some: DataFrame) -> DataFrame:
    """The same for long lines: a row per word, hashes of the words before and after it running.

    A set of words with their places is hashed by the exclusive or of their hashes, which a window
    can keep up as it goes.
    """
    placed = some.select("no", "n", F.posexplode("words").alias("i", "w"))
    placed = placed.select(
        "no", "n", "i", F.xxhash64(F.lit(0), "i", "w").alias("mine"), F.xxhash64(F.lit(1), F.col("n") - F.col("i"), "w").alias("own")
    )
    until = Window.partitionBy("no").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("no").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = placed.select(
        "no", "n", "i", "mine", "own", F.bit_xor("mine").over(until).alias("upto"),
        F.bit_xor("own").over(until).alias("ahead"), F.bit_xor("own").over(every).alias("all"),
    )
    before, after = F.col("upto").bitwiseXOR(F.col("mine")), F.col("all").bitwiseXOR(F.col("ahead"))
    variants = F.array(
        F.xxhash64("i", before, after),
        F.xxhash64("i", before, after.bitwiseXOR(F.col("own"))),
        F.when(F.col("i") == F.col("n") - 1, F.xxhash64("n", "upto", F.lit(0).cast("long"))),
    )
    return running.select("no", F.explode(variants).alias("key")).where("key IS NOT NULL")


def _one_edit(x: str, y: str) -> str:
    """SQL: whether the word arrays x and y are at most one edit apart."""
    # Words that agree from the start and from the end; together they leave at most one word out.
    def agree(p: str, q: str) -> str:
        shorter = f"least(size({p}), size({q}))"
        same = f"zip_with(slice({p}, 1, {shorter}), slice({q}, 1, {shorter}), (s, t) -> s = t)"
        return f"(CASE WHEN array_contains({same}, false) THEN array_position({same}, false) - 1 ELSE {shorter} END)"

    first, last = agree(x, y), agree(f"reverse({x})", f"reverse({y})")
    return f"abs(size({x}) - size({y})) <= 1 AND {first} + {last} >= greatest(size({x}), size({y})) - 1"


def _cell(number: Column) -> tuple[Column, Column]:
    """Place of a hash in the bitmap: the long and its bit."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(64)).cast("int"))
    return F.pmod(F.shiftright(number, 6), F.lit(BITMAP)), bit


def needed_lines(docs: DataFrame, some: DataFrame) -> DataFrame:
    """``some`` (at, a, b, others) with the line at each position ``at``, once however often its document repeats.

    A bitmap of fixed size first passes over nearly all other lines, so that their texts are not
    shuffled; the join decides. It has one key, by which repeated rows are dropped without another exchange.
    """
    at = F.xxhash64("at.doc_id", "at.hash", "at.line_no")
    cell, bit = _cell(at)
    bitmap = some.select(cell.alias("cell"), bit.alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    rows = lines(docs).withColumn("place", F.xxhash64("doc_id", "hash", "line_no"))
    cell, bit = _cell(F.col("place"))
    rows = rows.withColumns({"at_cell": cell, "at_bit": bit})
    rows = rows.join(F.broadcast(bitmap), F.col("at_cell") == F.col("cell"))  # at most BITMAP rows of two longs
    rows = rows.where(F.col("bits").bitwiseAND(F.col("at_bit")) != 0).select("place", "doc_id", "hash", "line_no", "line")
    joined = rows.join(some.withColumn("place", at), "place").where(
        F.col("doc_id").eqNullSafe(F.col("at.doc_id")) & (F.col("hash") == F.col("at.hash")) & (F.col("line_no") == F.col("at.line_no"))
    )
    return joined.select("place", *some.columns, "line").dropDuplicates(["place", "a", "b"])


def in_order(some: DataFrame) -> DataFrame:
    """``some`` with ``no``, which follows the positions; a line's text is not sorted along."""
    return saved(some.orderBy("at", "a", "b").withColumn("no", F.monotonically_increasing_id()), "some")


def near_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(a, b) of the lines that have an earlier line one edit away."""
    some = in_order(partnered(distinct))
    # Lines travel as text; their words are cut where they are compared.
    texts = saved(needed_lines(docs, some).select("no", "a", "b", "n", "line"), "lines")
    freed(some)
    split = texts.select("no", "n", _words("line").alias("words"))
    variants = _variants_in_row(split.where(F.col("n") <= IN_ROW)).unionByName(
        _variants_by_word(split.where(F.col("n") >= IN_ROW))
    )
    variants = saved(variants, "variants")
    least = variants.groupBy("key").agg(F.min("no").alias("first"), F.max("no").alias("last"), F.count("*").alias("lines"))
    least = saved(least.where("first < last"), "shared")
    # Of two lines the later one is known; of more, all that share the variant.
    more = variants.join(least.where("lines > 2").select("key", "first"), "key").where("first < no").select("no", "first")
    pairs = least.select(F.col("last").alias("no"), "first").unionByName(more).distinct()
    known = texts.select("no", "a", "b", "line")
    other = texts.select(F.col("no").alias("first"), F.col("line").alias("line2"))
    verified = pairs.join(known, "no").join(other, "first").where(_of_words(_one_edit("p.x", "p.y")))
    near = saved(verified.select("a", "b").distinct(), "near")
    for used in (texts, variants, least):
        freed(used)
    return near


def _heat(split: DataFrame) -> Column:
    """How frequent each cell of word pairs is: 0 below twice the mean of all cells, one more for each doubling.

    A scalar subquery with one array of CELLS / 16 longs, four bits to a cell.
    """
    cell = F.explode(F.expr(f"zip_with(slice(words, 1, n - 1), slice(words, 2, n - 1), (s, t) -> pmod(xxhash64(s, t), {CELLS}))"))
    counts = split.where("n > 1").select(cell.alias("cell")).groupBy("cell").agg(F.count("*").alias("pairs"))
    counts = saved(counts, "heat")
    # The mean over every cell, as a subquery of one number.
    mean = counts.agg((F.coalesce(F.sum("pairs"), F.lit(0)) / CELLS).alias("mean")).scalar()
    level = F.least(F.floor(F.log2(F.col("pairs") / mean)), F.lit(15)).cast("long")
    hot = counts.where(F.col("pairs") >= 2 * mean).withColumn("level", level)
    packed = hot.select(F.floor(F.col("cell") / 16).alias("long"), F.expr("shiftleft(level, cast(4 * pmod(cell, 16) AS int))").alias("bits"))
    packed = packed.groupBy("long").agg(F.bit_or("bits").alias("bits"))
    every = split.sparkSession.range(CELLS // 16).withColumnRenamed("id", "long").join(packed, "long", "left")
    row = F.struct("long", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return every.agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r.bits).alias("heat")).scalar()


def _first_pairs(share: int) -> Column:
    """Keys of the first pairs of adjacent words, as many as the edits may take away and one more, times PLACES + 1, plus the pair's place.

    Of n words, n // share may be edited, and each edit takes two pairs away. If the other line is
    longer, inserted words allow for more edits but take one pair each; that gains one pair at most.
    A pair that comes again counts each time, so the least pair that no edit takes away is among the first of both lines, and
    has one key with the place unknown. ``heat`` is that of the pairs' cells.
    """
    level = f"shiftrightunsigned(get(heat, cast(pmod(p.h, {CELLS}) div 16 AS int)), cast(4 * pmod(p.h, 16) AS int)) & 15"
    pairs = f"""transform(zip_with(slice(words, 1, n - 1), slice(words, 2, n - 1), (s, t) ->
          named_struct('l', least(length(s) + length(t), 127), 'h', xxhash64(s, t))), (p, i) ->
          shiftleft(15 - ({level}), 59) | shiftleft(cast(p.l AS bigint), 52) | shiftleft(shiftrightunsigned(p.h, 22), 10) | least(i, {PLACES}))"""
    taken = f"cast(greatest(2 * (n div {share}), 2 * ((n + 1) div {share}) - 1) AS int)"
    # One more tells whether the last of them comes again; the one-element array has them sorted only once.
    first = f"slice(sort_array({pairs}, false), 1, {taken} + 2)"
    placed = f"transform(f, (v, i) -> CASE WHEN shiftright(v, 10) = shiftright(get(f, i + 1), 10) THEN v | {PLACES} ELSE v END)"
    once = f"filter({placed}, (v, i) -> i <= {taken} AND (i = 0 OR shiftright(v, 10) <> shiftright(get(f, i - 1), 10)))"
    return F.expr(f"transform(array({first}), f -> {once})[0]")


def _as_text(words: str, code: str) -> str:
    """SQL: a text with one character of 2**20 for each word; ``code``: a number of the word w."""
    return f"decode(unhex(array_join(transform({words}, w -> lpad(hex(65536 + pmod({code}, 1048576)), 8, '0')), '')), 'UTF-32')"


def _parities(texts: DataFrame, some: DataFrame) -> DataFrame:
    """(no, n, p), stored, of the lines ``some`` (no): the parities of their words by 64 * PARITIES classes."""
    hashes = F.transform(_words("line"), lambda w: F.xxhash64(w))
    rows = texts.join(some.distinct(), "no", "left_semi").select("no", "n", F.explode(F.array(hashes)).alias("h"))
    parity = f"""transform(sequence(0, {PARITIES - 1}), k -> aggregate(h, 0L, (s, x) -> s ^
                   CASE WHEN pmod(x, {PARITIES}) = k THEN shiftleft(1L, cast(pmod(x div {PARITIES}, 64) AS int)) ELSE 0L END))"""
    return saved(rows.select("no", "n", F.expr(parity).alias("p")), "parities")


def _even(share: int) -> str:
    """SQL: whether the parities p and p2 of lines of n and n2 words allow for the bound. A word more or less changes one, another word two."""
    differ = " + ".join(f"bit_count(p[{k}] ^ p2[{k}])" for k in range(PARITIES))
    return f"{differ} <= 2 * (greatest(n, n2) div {share}) - abs(n - n2)"


def _fits(share: int, n: str, at: str, parity: str) -> str:
    """SQL: whether a line may be within the bound of another, given as n, at and parity, if no edit takes away the pair at these places."""
    bound = f"greatest(n, {n}) div {share}"
    moved = f"(at = {PLACES} OR {at} = {PLACES} OR abs(at - {at}) + abs(n - at - {n} + {at}) <= {bound})"
    return f"abs(n - {n}) <= {bound} AND {moved} AND bit_count(parity ^ {parity}) <= 2 * ({bound}) - abs(n - {n})"


def _alike(pairs: DataFrame, texts: DataFrame, share: int) -> DataFrame:
    """``pairs`` (no, other), stored, without those whose words' parities by 64 * PARITIES classes exclude the bound.

    A text is some ten times as long as these parities, and is not sent along for the pairs that they settle.
    """
    pairs = saved(pairs, "pairs")
    some = _parities(texts, pairs.select(F.explode(F.array("no", "other")).alias("no")))
    other = some.select(F.col("no").alias("other"), F.col("n").alias("n2"), F.col("p").alias("p2"))
    met = pairs.join(some, "no").join(other, "other").where(_even(share))
    alike = saved(met.select("no", "other"), "alike")
    for used in (pairs, some):
        freed(used)
    return alike


def _similar(pairs: DataFrame, texts: DataFrame, share: int) -> DataFrame:
    """(no, a, b), stored, of ``pairs`` (no, other) of lines that have at least ``share`` words for each edit between them."""
    bound = f"cast(greatest(n, n2) div {share} AS int)"
    pairs = _alike(pairs, texts, share)
    # Lines that are in no pair are not shuffled.
    paired = pairs.select(F.explode(F.array("no", "other")).alias("no")).distinct()
    some = texts.join(paired, "no", "left_semi").select("no", "a", "b", "n", "line")
    other = some.select(F.col("no").alias("other"), F.col("n").alias("n2"), F.col("line").alias("line2"))
    met = pairs.join(some, "no").join(other, "other")
    # Words that share a character can only lessen the distance; then each word has its own.
    short, short2 = (_as_text(w, "xxhash64(w)") for w in ("p.x", "p.y"))
    x, y = (_as_text(w, "array_position(both, w)") for w in ("p.x", "p.y"))
    exact = f"exists(array(array_distinct(concat(p.x, p.y))), both -> levenshtein({x}, {y}, {bound}) >= 0)"
    met = met.where(_of_words(f"levenshtein({short}, {short2}, {bound}) >= 0 AND {exact}"))
    similar = saved(met.select("no", "a", "b").distinct(), "similar")
    freed(pairs)
    return similar


def similar_lines(docs: DataFrame, distinct: DataFrame, near: DataFrame, share: int) -> DataFrame:
    """(a, b) of the lines that have an earlier line within the growing bound, two edits or more away.

    Lines of ``near`` are known to go; they stand among the earlier lines only.
    """
    # Two edits need 2 * share words in the longer line, which may hold two more than the other.
    some = distinct.where(F.col("n") >= max(MIN_WORDS, 2 * share - 2)).select("a", "b", "at", "n")
    some = in_order(some.join(near.select("a", "b", F.lit(True).alias("near")), ["a", "b"], "left"))
    # Every different line once, whatever the number of its copies.
    texts = saved(needed_lines(docs, some).select("no", "a", "b", "n", "near", "line"), "lines")
    freed(some)
    split = texts.select("no", "n", "near", _words("line").alias("words"))
    parity = F.expr("aggregate(words, 0L, (s, w) -> s ^ shiftleft(1L, cast(pmod(xxhash64(w), 64) AS int)))")
    split = split.withColumns({"heat": _heat(split), "parity": parity})
    index = split.select("no", "n", "near", "parity", F.explode(_first_pairs(share)).alias("v"))
    index = index.select(
        "no", "n", "near", "parity", F.shiftright("v", 10).alias("key"), F.col("v").bitwiseAND(F.lit(PLACES)).cast("int").alias("at")
    )
    # One exchange, the largest of this step, makes the lists and meets each line with the earliest of its list and the LOOK
    # before it. Only lines that fit one of these, and those of lists that go on beyond, are stored.
    order = Window.partitionBy("key").orderBy("no")
    earliest = F.first(F.struct("no", "n", "at", "parity")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = index.select(
        "*", F.row_number().over(order).alias("place"), F.lead("no", LOOK + 1).over(order).isNotNull().alias("beyond"),
        earliest.alias("e"), F.collect_list(F.struct("no", "n", "at", "parity")).over(order.rowsBetween(-LOOK, -1)).alias("before"),
    ).where("place > 1")
    fits = _fits(share, "e.n", "e.at", "e.parity")
    each = _fits(share, "x.n", "x.at", "x.parity")
    others = f"transform(filter(before, x -> x.no <> e.no AND {each}), x -> x.no)"
    far = f"place > {LOOK + 2}"
    lists = placed.select(
        "key", "no", "n", "near", "at", "parity", "place", F.expr(f"beyond OR {far}").alias("more"),
        F.expr(f"CASE WHEN near IS NULL AND {fits} THEN e.no END").alias("other"),
        F.expr(f"CASE WHEN near IS NULL AND place > 2 THEN {others} ELSE array() END").alias("others"),
    )
    lists = saved(lists.where("more OR other IS NOT NULL OR size(others) > 0"), "lists")
    first = lists.where("other IS NOT NULL").select("no", "other").distinct()
    found = _similar(first, texts, share)
    # The others have an earlier line besides the earliest one if they are third or later.
    settled = found.select("no").distinct()
    rest = lists.where("size(others) > 0").select("no", "others").join(settled, "no", "left_anti")
    rest = rest.select("no", F.explode("others").alias("other"))
    # Lines before the LOOK nearest, for the lists that have so many. Two lines in several of these meet in one only, if it is
    # among the first KEYS of both; its place may not be that of a pair which no edit takes away, and is not asked for.
    long = lists.where("more")
    held = long.groupBy("no").agg(F.slice(F.sort_array(F.collect_set("key"), asc=False), 1, KEYS).alias("keys"), F.max(F.expr(f"{far} AND near IS NULL")).alias("open"))
    some = _parities(texts, long.select("no"))
    long = long.select("key", "no", "parity").join(held.join(some, "no"), "no")
    open_ = long.where("open").join(settled, "no", "left_anti")
    earlier = long.select("key", *[F.col(c).alias(f"{c}2") for c in ("no", "n", "parity", "p", "keys")])
    close = f"abs(n - n2) <= greatest(n, n2) div {share} AND bit_count(parity ^ parity2) <= 2 * (greatest(n, n2) div {share}) - abs(n - n2) AND {_even(share)}"
    once = "key = coalesce(array_max(array_intersect(keys, keys2)), key)"
    met = open_.join(earlier, "key").where(f"no2 < no AND {close} AND {once}")
    rest = rest.unionByName(met.select("no", F.col("no2").alias("other"))).distinct()
    rest = rest.join(first, ["no", "other"], "left_anti")
    both = saved(found.unionByName(_similar(rest, texts, share)).select("a", "b"), "similar")
    for used in (lists, some, found, texts):
        freed(used)
    return both


def dropped(docs: DataFrame, share: int | None = None) -> DataFrame:
    """(doc_id, hash, dropped): the sorted line numbers that each document loses; only such documents.

    With ``share`` the edit bound grows with the length.
    """
    docs = docs.where("text IS NOT NULL")
    keyed = saved(keyed_lines(lines(docs)), "keyed")
    distinct = saved(distinct_lines(keyed), "distinct")
    near = near_lines(docs, distinct)
    if share is not None:
        # The half keys have served; they are half of both tables.
        slim = saved(keyed.drop("ends"), "keyed"), saved(distinct.drop("ends"), "distinct")
        for used in (keyed, distinct):
            freed(used)
        keyed, distinct = slim
        near = near.unionByName(similar_lines(docs, distinct, near, share))
    near = near.withColumn("near", F.lit(True))
    # Where the line may stay; nowhere if an earlier neighbour exists.
    firsts = distinct.select("a", "b", "at").join(near, ["a", "b"], "left")
    firsts = firsts.select("a", "b", F.when(F.col("near").isNull(), F.col("at")).alias("stays"))
    met = keyed.select("a", "b", "doc_id", "hash", "line_no").join(firsts, ["a", "b"])
    gone = met.where(~F.col("stays").eqNullSafe(_position()))
    return gone.groupBy("doc_id", "hash").agg(F.sort_array(F.collect_set("line_no")).alias("dropped"))


def dedup(docs: DataFrame, share: int | None = None) -> DataFrame:
    """``docs`` without the lines that repeat or nearly repeat an earlier one, with n_dropped.

    With ``share`` the edit bound grows with the length.

    Lines are in the order of doc_id (null first), of a hash of the text for rows that share an
    id, and of their place. Lines are compared by their words; lines without words always stay. A
    null or empty text stays as it is. Other columns are kept.
    """
    columns = docs.columns
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__hash": F.xxhash64("text")})
    gone = dropped(docs, share).select(F.col("doc_id").alias("__d"), F.col("hash").alias("__h"), F.col("dropped").alias("__dropped"))
    joined = keyed.join(gone, F.col("__id").eqNullSafe(F.col("__d")) & (F.col("__hash") == F.col("__h")), "left")
    left = F.expr("filter(split(text, '\n'), (x, i) -> NOT array_contains(__dropped, i))")
    text = F.when(F.col("__dropped").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return joined.select(
        *[text.alias(c) if c == "text" else F.col(c) for c in columns],
        F.coalesce(F.size("__dropped"), F.lit(0)).alias("__n"),
    ).withColumnRenamed("__n", "n_dropped" if "n_dropped" not in columns else "__n_dropped")


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents without their repeated lines; those of which nothing is left go, empty ones stay."""
    out = dedup(docs, SHARE).withColumnRenamed("n_dropped", "__n_dropped")
    out = out.where((F.col("__n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__n_dropped") == 0, F.col("n_chars")).otherwise(F.length("text")))
    return out.select(*[F.col(c).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its number of lines, and the numbers of the lines that it loses, from 0."""
    docs = table(spark, folder, "documents")
    count = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"),
        F.coalesce(count, F.lit(0)).cast("long").alias("n_lines"),
    ).alias("d")
    gone = dropped(docs).alias("g")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.hash") == F.col("g.hash"))
    return slim.join(gone, same, "left").select(
        "d.doc_id", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.array_join(F.col("dropped").cast("array<string>"), ","), F.lit("")).alias("dropped"),
    )


ORACLE = r"""
WITH docs AS (SELECT doc_id, text FROM documents),
l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM docs WHERE text IS NOT NULL
), w AS (
  SELECT *, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM l
), d AS (
  SELECT words, len(words) AS n, min((doc_id, line_no)) AS pos FROM w WHERE len(words) > 0 GROUP BY words
), roles AS (
  SELECT words, pos, unnest([n, n + 1]) AS m FROM d WHERE n >= 5
), halves AS (
  -- One edit in the longer of two lines, of m words, leaves its first m // 2 words or the others alone.
  SELECT words, pos, m, unnest([
    (0, array_to_string(words[1:m // 2], ' ')),
    (1, array_to_string(words[len(words) - (m - m // 2) + 1:len(words)], ' '))
  ]) AS half FROM roles
), candidates AS (
  SELECT DISTINCT h.words AS x, o.words AS y FROM halves h JOIN halves o USING (m, half) WHERE o.pos < h.pos
), near AS (
  SELECT DISTINCT x FROM candidates
  WHERE abs(len(x) - len(y)) <= 1 AND
    len(list_filter(range(1, least(len(x), len(y)) + 1), lambda i: x[1:i] = y[1:i]))
    + len(list_filter(range(1, least(len(x), len(y)) + 1), lambda i: x[len(x) - i + 1:len(x)] = y[len(y) - i + 1:len(y)]))
    >= greatest(len(x), len(y)) - 1
), marked AS (
  SELECT w.doc_id, w.line_no, w.line,
    len(w.words) > 0 AND ((w.doc_id, w.line_no) <> d.pos OR w.words IN (SELECT x FROM near)) AS gone
  FROM w LEFT JOIN d ON w.words = d.words
), lost AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    string_agg((line_no - 1)::VARCHAR, ',' ORDER BY line_no) FILTER (gone) AS dropped
  FROM marked GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, coalesce(dropped, '') AS dropped
FROM docs LEFT JOIN lost USING (doc_id)
"""
