"""Operators on ``elements`` rows: children, descendants, leaves, sentences, citations.

Every row carries its ancestors (``lineage``) and its pre-order interval (``ord``,
``end_ord``), so most questions about the tree are answered row by row. Where two elements
have to meet, the join is on ``(law_id, ord)``: even one huge law is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawtree import schema as S
from lawtree.functions import scalars
from lawtree.scratch import checkpointed


def parent_ord() -> Column:
    """``ord`` of the parent, 0 for top-level elements."""
    return F.coalesce(F.try_element_at("lineage", F.lit(-1))["ord"], F.lit(0))


def is_text() -> Column:
    return F.col("etype").isin(*S.TEXT_ETYPES)


def is_leaf() -> Column:
    return F.col("ord") == F.col("end_ord")


def children(elements: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """Each element with its parent's ``ord``, ``etype`` and number; top-level ones left out.

    With ``parents`` (rows with ``law_id`` and ``elem_id``) only their children are kept.
    """
    parent = F.element_at("lineage", -1)
    rows = elements.where(F.col("depth") > 1)
    if parents is not None:
        keys = parents.select("law_id", F.col("elem_id").alias("parent_id"))
        rows = rows.join(keys, ["law_id", "parent_id"], "left_semi")
    return rows.withColumns(
        {
            "parent_ord": parent["ord"],
            "parent_etype": parent["etype"],
            "parent_num_raw": parent["num_raw"],
        }
    )


def top_level(elements: DataFrame, etypes: Iterable[str] = S.PROVISIONS) -> DataFrame:
    wanted = [e for e in etypes if e in S.PROVISIONS]
    return elements.where((F.col("depth") == 1) & F.col("etype").isin(*wanted))


def descendants(elements: DataFrame, ancestors: DataFrame, *carry: str) -> DataFrame:
    """Every descendant of each row of ``ancestors``, in one row per pair.

    Ancestor columns get the prefix ``anc_``; ``carry`` names those wanted besides ``ord``.
    A row meets its own few ancestors only, never the other rows of its law. Both sides grow with the
    corpus, and a stored table of ancestors is many times smaller than its rows: none is broadcast.
    """
    names = list(dict.fromkeys(["ord", *carry]))
    left = ancestors.select("law_id", *[F.col(c).alias(f"anc_{c}") for c in names])
    right = elements.withColumn("anc_ord", F.explode("lineage.ord"))
    return right.join(left.hint("merge"), ["law_id", "anc_ord"])


# Element places are cut into blocks of 1, 8, 64, 512 and 4,096.
BLOCK_BITS, BLOCK_LEVELS = 3, 5


def _range(first: Column, end: Column) -> Column:
    """The numbers from ``first`` up to, but without, ``end``."""
    return F.when(first < end, F.sequence(first, end - 1)).otherwise(F.array().cast("array<bigint>"))


def _block(level: int):
    return lambda number: F.struct(F.lit(level).alias("level"), number.alias("block"))


def _blocks_within(low: Column, high: Column) -> Column:
    """The fewest blocks that together hold the places from ``low`` up to, but without, ``high``."""
    parts = []
    for level in range(BLOCK_LEVELS):
        bits = BLOCK_BITS * level
        first, end = F.shiftright(low + (1 << bits) - 1, bits), F.shiftright(high, bits)
        blocks = _range(first, end)
        if level + 1 < BLOCK_LEVELS:
            # Those inside blocks of the next level are left to it.
            wider = bits + BLOCK_BITS
            inner = F.shiftleft(F.shiftright(low + (1 << wider) - 1, wider), BLOCK_BITS)
            outer = F.shiftleft(F.shiftright(high, wider), BLOCK_BITS)
            sides = F.concat(_range(first, inner), _range(outer, end))
            blocks = F.when(inner < outer, sides).otherwise(blocks)
        parts.append(F.transform(blocks, _block(level)))
    return F.concat(*parts)


def descendants_by_interval(elements: DataFrame, ancestors: DataFrame, *carry: str) -> DataFrame:
    """``descendants`` for tables that have ``ord`` and ``end_ord`` but no ``lineage``.

    The interval of an ancestor is cut into aligned blocks of few sizes, and an element is in one
    block of each size, so the join is on equal blocks and meets no pair that is no result. A block
    has at most 4,096 elements: a huge law is spread over as many keys as it has blocks. Elements
    pass once per size, five times at most; choose their columns first.
    """
    names = list(dict.fromkeys(["ord", *carry]))
    low, high = F.col("ord").cast("long") + 1, F.col("end_ord").cast("long") + 1
    left = ancestors.withColumn("anc_block", F.explode(_blocks_within(low, high)))
    left = left.select("law_id", "anc_block", *[F.col(c).alias(f"anc_{c}") for c in names])
    place = F.col("ord").cast("long")
    of_level = [_block(level)(F.shiftright(place, BLOCK_BITS * level)) for level in range(BLOCK_LEVELS)]
    # Block 0 holds the file's row, which is below nothing.
    met = F.filter(F.array(*of_level), lambda b: b["block"] > 0)
    right = elements.withColumn("anc_block", F.explode(met))
    # Not broadcast: Spark takes the blocks for as small as the stored rows that they are made of.
    return right.join(left.hint("merge"), ["law_id", "anc_block"]).drop("anc_block")


def within(etypes: Iterable[str]) -> Column:
    """The element and all its ancestors are of these types."""
    kept = list(etypes)
    return F.col("etype").isin(*kept) & F.forall("lineage", lambda a: a["etype"].isin(*kept))


def prune(elements: DataFrame, etypes: Iterable[str] = S.BASIC_ETYPES) -> DataFrame:
    """Leave out elements of other types together with their subtrees."""
    return elements.where(within(etypes))


def leaves(elements: DataFrame, etypes: Iterable[str] | None = None) -> DataFrame:
    """Elements without children. With ``etypes`` the tree is pruned to these types first.

    Pruning makes leaves of elements that lose all children, so those are looked for again.
    """
    if etypes is None:
        return elements.where(is_leaf())
    kept = prune(elements, etypes)
    parents = kept.where(F.col("depth") > 1).select("law_id", parent_ord().alias("ord")).distinct()
    return kept.join(parents, ["law_id", "ord"], "left_anti")


def document_order(elements: DataFrame) -> DataFrame:
    return elements.orderBy("law_id", "ord")


def sibling_order(elements: DataFrame) -> DataFrame:
    """By parent and number; numbers that ``num`` cannot tell apart go by their parts."""
    return elements.orderBy("law_id", "parent_id", "num", "num_path", "ord")


def sentences(elements: DataFrame, preprocess=None) -> DataFrame:
    """One row per text, captions included: ``sentence_num`` counts from 0 per element.

    ``preprocess`` maps the sentence column to another, a pandas UDF for example.
    """
    others = [c for c in elements.columns if c not in ("texts", "content")]
    rows = elements.select(*others, F.posexplode("texts").alias("sentence_num", "sentence"))
    return rows if preprocess is None else rows.withColumn("sentence", preprocess(F.col("sentence")))


def plaintext(elements: DataFrame, *carry: str) -> DataFrame:
    """All sentences of a law in document order, without separator.

    ``carry`` names law columns to keep.
    """
    piece = F.when(F.size("texts") > 0, F.struct("ord", scalars.content(F.col("texts")).alias("s")))
    pieces = F.array_sort(F.collect_list(piece))
    return elements.groupBy("law_id", *carry).agg(F.array_join(pieces["s"], "").alias("plaintext"))


def plaintext_of_chunks(chunks: DataFrame, *carry: str) -> DataFrame:
    """The same from files as ``xml.parse_chunks`` reads them; ``carry`` names at least one of their columns.

    The texts of up to a thousand elements are joined in their row, so that one row of a chunk is
    shuffled and not one of each element.
    """
    last = F.element_at("nodes", -1)["ord"]
    texts = F.array_join(F.flatten(F.transform("nodes", lambda n: n["texts"])), "")
    parts = chunks.where(last > 0).select("path", *carry, F.struct(last.alias("last"), texts.alias("s")).alias("part"))
    joined = F.array_sort(F.collect_list("part"))
    return parts.groupBy("path", *carry).agg(F.array_join(joined["s"], "").alias("plaintext")).drop("path")


def citation(law_name: Column) -> Column:
    """``law name(本則)第1条第2項``, from the element's own columns and its lineage."""
    above = F.transform(
        "lineage",
        lambda a: scalars.label_part(a["etype"], scalars.num_path(a["etype"], a["num_raw"])),
    )
    own = scalars.label_part(F.col("etype"), F.col("num_path"))
    return F.concat(law_name, F.array_join(above, ""), own)


def citation_labels(elements: DataFrame, laws: DataFrame) -> DataFrame:
    """``elements`` with ``label``, the way the element is cited."""
    names = laws.select("law_id", F.col("name").alias("law_name"))
    return elements.join(names, "law_id").withColumn("label", citation(F.col("law_name")))


def lookup(elements: DataFrame, keys: DataFrame) -> DataFrame:
    """Find elements by ``(law_id, parent_id, etype, num)``."""
    return elements.join(keys, ["law_id", "parent_id", "etype", "num"], "left_semi")


ROOTED, ORPHAN, CYCLE = "rooted", "orphan", "cycle"


def with_lineage(rows: DataFrame) -> DataFrame:
    """Rebuild ``depth`` and ``lineage`` for rows that only have ``parent_id``, by pointer doubling.

    Every row holds the ancestors found so far and a pointer to the next one. A round appends to
    them those of the row pointed at, so they double, and trees of any depth take as many rounds as
    the logarithm of it; rows that have reached the top rest. Needs law_id, elem_id, parent_id, ord,
    etype, num_raw; other columns are joined once, at the end.

    ``linkage`` tells rows of a whole tree from those below a missing parent and those on or below
    a cycle. An orphan's lineage begins below what is missing; a cycle's rows have none. Both have no depth.
    """
    base = rows.drop("lineage", "depth", "linkage")
    top = F.col("up") == -F.col("law_id")
    own = F.struct("ord", "etype", "num_raw")
    begun = base.select(
        "law_id", "elem_id", F.col("parent_id").alias("up"), F.array(own).cast(S.LINEAGE).alias("own"), F.array().cast(S.LINEAGE).alias("above")
    )
    now = checkpointed(begun.withColumn("linkage", F.when(top, ROOTED)))
    settled = [now.where("linkage IS NOT NULL")]
    open_ = now.where("linkage IS NULL")
    while not open_.isEmpty():
        every = reduce(DataFrame.unionByName, [*settled, open_]).select(
            "law_id", F.col("elem_id").alias("up"), F.col("up").alias("next"), F.concat("above", "own").alias("more"),
            F.col("linkage").alias("reached"), F.lit(True).alias("found"),
        )
        met = open_.drop("linkage").join(every, ["law_id", "up"], "left")
        found = F.col("found").isNotNull()
        moved = checkpointed(met.select(
            "law_id", "elem_id", F.when(found, F.col("next")).otherwise(F.col("up")).alias("up"), "own",
            F.when(found, F.concat("more", "above")).otherwise(F.col("above")).alias("above"),
            F.when(found, F.col("reached")).otherwise(ORPHAN).alias("linkage"),
        ))
        resting = moved.where("linkage IS NOT NULL")
        # Depths have no gaps: a round in which no row comes to rest leaves cycles only.
        if resting.isEmpty():
            settled.append(open_.withColumns({"linkage": F.lit(CYCLE), "above": F.array().cast(S.LINEAGE)}))
            break
        settled.append(resting)
        open_ = moved.where("linkage IS NULL")
    every = reduce(DataFrame.unionByName, settled).select("law_id", "elem_id", F.col("above").alias("lineage"), "linkage")
    depth = F.when(F.col("linkage") == ROOTED, F.size("lineage") + 1)
    return base.join(every, ["law_id", "elem_id"]).withColumn("depth", depth)
