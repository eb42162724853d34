"""Checks on parsed files. Each gives rows of the ``errors`` table.

A file's elements are checked inside its row, before they become rows of their own (``xml.parse_chunks``).
What leaves the row is only what was found: errors, and the few siblings that a later chunk of a long
file has to be asked about.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawtree import schema as S
from lawtree.functions import scalars
from lawtree.scratch import checkpointed

# Columns of the law that an error report needs.
CONTEXT = ("path", "code", "law_name", "law_num")

# Errors of a whole file; no mode keeps such a law.
LAW_ERROR_CLASSES = (
    "XMLStructureError", "PathCodeError", "LengthError", "ForeignKeyError", "IdCollisionError",
)


def _errors(rows: DataFrame, error_class: str, detail: Column) -> DataFrame:
    return rows.select(
        *CONTEXT,
        F.lit(error_class).alias("error_class"),
        detail.alias("error_detail"),
        F.col("ord").cast("int").alias("ord"),
    )


# Checks that need one row only: (error class, condition, detail).

def _file_checks() -> list[tuple[str, Column, Column]]:
    read = F.col("parse_error").isNull()
    checks = [
        ("XMLStructureError", ~read, F.col("parse_error")),
        ("PathCodeError", read & F.col("code").isNull(), F.col("path")),
    ]
    for c in ("law_name", "law_num"):
        detail = F.format_string(f"{c} has %d characters", F.length(c))
        checks.append(("LengthError", read & (F.length(c) > S.LAW_LIMIT), detail))
    return checks


def grammar_ok(etype: Column, parent: Column) -> Column:
    """The parent's type is one that this type allows; unknown types pass."""
    parents = scalars.lookup(S.GRAMMAR, etype)
    return F.coalesce(F.array_contains(parents, parent), F.lit(True))


def _element_checks(known: Iterable[str], node: Column) -> list[tuple[str, Column, Column]]:
    etype, num_raw = node["etype"], node["num_raw"]
    parent = F.coalesce(F.try_element_at(node["lineage"], F.lit(-1))["etype"], F.lit(S.ROOT))
    return [
        (
            # Fixed value: the message text, spelling included.
            "HieralchyError", ~grammar_ok(etype, parent),
            F.format_string("invalid hieralchy %s -> %s", parent, etype),
        ),
        ("EtypeError", ~etype.isin(*known), F.format_string("unknown type %s", etype)),
        (
            "LawElementNumberError", node["path"].isNull(),
            F.when(scalars.num_ok(etype, num_raw), F.format_string("Number Too Large %s", num_raw))
            .otherwise(F.format_string("Invalid Format %s", num_raw)),
        ),
    ]


def _row_errors(rows: DataFrame, checks: list[tuple[str, Column, Column]]) -> DataFrame:
    """All checks in one scan and without a shuffle."""
    found = [
        F.when(
            condition,
            F.struct(F.lit(error_class).alias("error_class"), detail.alias("error_detail")),
        )
        for error_class, condition, detail in checks
    ]
    rows = rows.select(*CONTEXT, "ord", F.inline(F.array_compact(F.array(*found))))
    return rows.select(*S.ERRORS.fieldNames())


def file_errors(heads: DataFrame) -> DataFrame:
    """Unreadable XML, paths without codes, names and numbers over the length limit."""
    return _row_errors(heads, _file_checks())


# What a chunk lets out: an error, or a sibling to be compared with others by its key.

_FOUND = "array<struct<kind:string,error_class:string,error_detail:string,ord:int,parent:int,rank:int,num:decimal(38,18),deep:string>>"
_NUMBER, _ACROSS, _TYPE, _FILE = "number", "number across types", "type", "file"


def _of_file() -> Column:
    """Errors of a whole file, in its first chunk, and the file itself if it can be read."""
    def cell(kind: str, error_class: Column, detail: Column, rank: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), error_class.alias("error_class"), detail.alias("error_detail"), F.lit(0).alias("ord"),
            F.lit(None).cast("int").alias("parent"), rank.alias("rank"), F.lit(None).cast(S.NUM).alias("num"),
            F.lit(None).cast("string").alias("deep"),
        )

    none = F.lit(None)
    wrong = [F.when(condition, cell("error", F.lit(error_class), detail, none.cast("int"))) for error_class, condition, detail in _file_checks()]
    itself = F.when(F.col("parse_error").isNull(), cell(_FILE, none.cast("string"), none.cast("string"), F.col("muni_id")))
    first = F.get("nodes", F.lit(0))["ord"] == 0
    return F.when(first, F.array_compact(F.array(*wrong, itself))).otherwise(F.array()).cast(_FOUND)


def _errors_within(known: Iterable[str]) -> Column:
    """Elements under a parent their type does not allow, of an unknown type, or with a bad Num."""
    def of_node(node: Column) -> Column:
        nothing = F.lit(None)
        return F.array(*[
            F.when(condition, F.struct(
                F.lit("error").alias("kind"), F.lit(error_class).alias("error_class"), detail.alias("error_detail"),
                node["ord"].alias("ord"), nothing.cast("int").alias("parent"), nothing.cast("int").alias("rank"),
                nothing.cast(S.NUM).alias("num"), nothing.cast("string").alias("deep"),
            ))
            for error_class, condition, detail in _element_checks(known, node)
        ])

    return F.array_compact(F.flatten(F.transform("body", of_node))).cast(_FOUND)


def _sibling(node: Column, kind: str) -> Column:
    """Key and place of an element; ``whole``: all children of its parent are in this chunk."""
    etype, path = node["etype"], node["path"]
    parent = F.coalesce(F.try_element_at(node["lineage"], F.lit(-1))["ord"], F.lit(0))
    first, last = F.get("nodes", F.lit(0))["ord"], F.element_at("nodes", -1)["ord"]
    end = F.get("nodes", parent - first)["end_ord"]
    by_type = kind == _TYPE
    return F.struct(
        parent.alias("parent"),
        (F.lit(0) if kind == _ACROSS else scalars.etype_rank(etype)).alias("rank"),
        (F.lit(0).cast(S.NUM) if by_type else scalars.num_value(path)).alias("num"),
        (F.lit("") if by_type else scalars.num_deep(path)).alias("deep"),
        node["ord"].alias("ord"),
        ((parent >= first) & (end <= last)).alias("whole"),
    )


def _next_to(siblings: Column, same) -> Column:
    """Sorted siblings that have a neighbour for which ``same`` holds, or relatives in other chunks."""
    following = F.slice(siblings, F.lit(2), F.greatest(F.size(siblings) - 1, F.lit(0)))

    def kept(x: Column, y: Column) -> Column:
        return F.when(y.isNotNull() & same(x, y), F.array(x, y)).when(~x["whole"], F.array(x)).otherwise(F.array().cast(_SIBLINGS))

    return F.array_distinct(F.flatten(F.zip_with(siblings, following, kept)))


_SIBLINGS = "array<struct<parent:int,rank:int,num:decimal(38,18),deep:string,ord:int,whole:boolean>>"


def _as_found(siblings: Column, kind: str) -> Column:
    none = F.lit(None).cast("string")
    return F.transform(siblings, lambda x: F.struct(
        F.lit(kind).alias("kind"), none.alias("error_class"), none.alias("error_detail"), x["ord"].alias("ord"),
        x["parent"].alias("parent"), x["rank"].alias("rank"), x["num"].alias("num"), x["deep"].alias("deep"),
    )).cast(_FOUND)


def _text(node: Column) -> Column:
    return node["etype"].isin(*S.TEXT_ETYPES)


def _siblings(kind: str, counted) -> Column:
    """Siblings of the nodes that are ``counted`` and have a number, by their keys and in document order."""
    keyed = F.transform(F.filter("body", counted), lambda n: _sibling(n, kind))
    return F.array_sort(F.filter(keyed, lambda x: x["num"].isNotNull())).cast(_SIBLINGS)


def findings(chunks: DataFrame, known: Iterable[str], check_siblings: bool, across_types: bool, whole_files: bool = False) -> DataFrame:
    """What the checks of elements find in ``chunks``; CONTEXT columns and those of _FOUND.

    With ``whole_files`` the checks of files are among them, and a row of each readable file with its muni_id as ``rank``.
    """
    rows = chunks if whole_files else chunks.where(F.col("parse_error").isNull())
    files = _of_file() if whole_files else F.array().cast(_FOUND)
    # The number is worked out once per element, as all checks ask for it.
    numbered = F.transform(F.filter("nodes", lambda n: n["ord"] > 0), lambda n: F.struct(
        *[n[c].alias(c) for c in ("ord", "etype", "num_raw", "lineage")], scalars.num_path(n["etype"], n["num_raw"]).alias("path"),
    ))
    rows = rows.select(*CONTEXT, files.alias("of_file"), "nodes", numbered.alias("body"))
    columns = {"numbers": _siblings(_NUMBER, lambda n: n["etype"] != "SupplProvision")}
    if across_types:
        columns["across"] = _siblings(_ACROSS, lambda n: ~_text(n) & ~n["etype"].isin(*S.PROVISIONS))
    if check_siblings:
        columns["types"] = _siblings(_TYPE, lambda n: ~_text(n))
    rows = rows.select(
        *CONTEXT, F.concat("of_file", _errors_within(known)).alias("wrong"), *[c.alias(name) for name, c in columns.items()]
    )

    def same_number(x: Column, y: Column) -> Column:
        return (x["parent"] == y["parent"]) & (x["rank"] == y["rank"]) & (x["num"] == y["num"]) & (x["deep"] == y["deep"])

    found = [F.col("wrong"), _as_found(_next_to(F.col("numbers"), same_number), _NUMBER)]
    if across_types:
        found.append(_as_found(_next_to(F.col("across"), same_number), _ACROSS))
    if check_siblings:
        # Of each type only the first child counts, and parents with one type not at all.
        def same_type(x: Column, y: Column) -> Column:
            return (x["parent"] == y["parent"]) & (x["rank"] == y["rank"])

        before = F.concat(F.array(F.lit(None).cast(_SIBLINGS[6:-1])), F.slice("types", F.lit(1), F.greatest(F.size("types") - 1, F.lit(0))))
        firsts = F.zip_with("types", F.when(F.size("types") > 0, before).otherwise(F.array().cast(_SIBLINGS)), lambda x, p: F.when(
            p.isNull() | ~same_type(x, p), x
        ))
        rows = rows.withColumn("types", F.array_compact(firsts))
        found.append(_as_found(_next_to(F.col("types"), lambda x, y: x["parent"] == y["parent"]), _TYPE))
    return rows.select(*CONTEXT, F.inline(F.concat(*found)))


def _element_errors(found: DataFrame) -> DataFrame:
    return found.where(F.col("kind") == "error").select(*S.ERRORS.fieldNames())


def _duplicate_errors(found: DataFrame, across_types: bool = False) -> DataFrame:
    """Siblings with the same type and number, or with ``across_types`` the same number.

    A law may have any number of supplementary provisions, all numbered 0. One error per
    number, at the first element that has it.
    """
    rows = found.where(F.col("kind") == (_ACROSS if across_types else _NUMBER))
    groups = rows.groupBy(*CONTEXT, "parent", "rank", "num", "deep").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("ord"))
    if across_types:
        shown = F.col("num").cast("string")
    else:
        etype = F.get(F.array(*map(F.lit, S.ETYPE_RANK)), "rank")
        shown = scalars.number_label(etype, scalars.num_parts(F.col("num")))
    detail = F.concat(F.lit("element number duplication: "), shown)
    return _errors(groups.where(F.col("n") > 1), "HieralchyError" if across_types else "DuplicateNumberError", detail)


def _sibling_errors(found: DataFrame) -> DataFrame:
    """Parents whose non-text children are of more than one type.

    One error per parent, at the first child whose type is not that of the first child.
    """
    firsts = found.where(F.col("kind") == _TYPE).groupBy(*CONTEXT, "parent", "rank").agg(F.min("ord").alias("ord"))
    # At most one entry per element type.
    groups = firsts.groupBy(*CONTEXT, "parent").agg(
        F.sort_array(F.collect_list(F.struct("ord", "rank"))).alias("firsts")
    )
    hits = groups.where(F.size("firsts") > 1).select(
        *CONTEXT, F.col("firsts")[0]["rank"].alias("elder"), F.col("firsts")[1]["rank"].alias("other"),
        F.col("firsts")[1]["ord"].alias("ord"),
    )
    types = F.array(*map(F.lit, S.ETYPE_RANK))
    # Fixed value: the message text.
    detail = F.format_string(
        "different type elements in the same layer: %s and %s", F.get(types, "other"), F.get(types, "elder")
    )
    return _errors(hits, "HieralchyError", detail)


def municipality_errors(heads: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Laws of a municipality that is not in the list."""
    placed = heads.where(F.col("parse_error").isNull() & F.col("muni_id").isNotNull())
    missing = placed.join(municipalities.select("muni_id"), "muni_id", "left_anti")
    return _errors(
        missing, "ForeignKeyError", F.format_string("unknown municipality %d", F.col("muni_id"))
    )


def collision_errors(heads: DataFrame) -> DataFrame:
    return _errors(
        heads, "IdCollisionError", F.format_string("law id %d is taken", F.col("law_id"))
    )


def violations(
    chunks: DataFrame,
    heads: DataFrame,
    municipalities: DataFrame | None = None,
    *,
    check_siblings: bool = False,
    check_cross_type_numbers: bool = False,
    include_subitem_sentences: bool = False,
) -> DataFrame:
    """Every violation in the elements of ``chunks`` and in the files of ``heads`` (rows with ``ord`` 0).

    ``chunks`` is read once; what is found there is stored and then sorted out.
    """
    found = _stored_findings(chunks, check_siblings, check_cross_type_numbers, include_subitem_sentences)
    out = [file_errors(heads), *_sorted_out(found, check_siblings, check_cross_type_numbers)]
    if municipalities is not None:
        out.append(municipality_errors(heads, municipalities))
    return reduce(DataFrame.unionByName, out)


def _stored_findings(chunks: DataFrame, check_siblings: bool, across: bool, subitem_sentences: bool, **whole: bool) -> DataFrame:
    known = S.ETYPES + (S.SUBITEM_SENTENCES if subitem_sentences else ())
    return checkpointed(findings(chunks, known, check_siblings, across, **whole))


def _sorted_out(found: DataFrame, check_siblings: bool, across: bool) -> list[DataFrame]:
    out = [_element_errors(found), _duplicate_errors(found)]
    if check_siblings:
        out.append(_sibling_errors(found))
    if across:
        out.append(_duplicate_errors(found, across_types=True))
    return out


def validate(
    chunks: DataFrame,
    municipalities: DataFrame | None = None,
    *,
    check_siblings: bool = False,
    check_cross_type_numbers: bool = False,
    include_subitem_sentences: bool = False,
) -> DataFrame:
    """``violations`` of files as ``xml.parse_chunks`` reads them, in one pass over them."""
    found = _stored_findings(
        chunks, check_siblings, check_cross_type_numbers, include_subitem_sentences, whole_files=True
    )
    out = _sorted_out(found, check_siblings, check_cross_type_numbers)
    if municipalities is not None:
        heads = found.where(F.col("kind") == _FILE).select(
            *CONTEXT, "ord", F.col("rank").alias("muni_id"), F.lit(None).cast("string").alias("parse_error")
        )
        out.append(municipality_errors(heads, municipalities))
    return reduce(DataFrame.unionByName, out)


def without_errors(rows: DataFrame, errors: DataFrame) -> DataFrame:
    """Drop the files that have an error; needs ``path``."""
    return rows.join(errors.select("path").distinct(), "path", "left_anti")


def first_errors(errors: DataFrame) -> DataFrame:
    """One error per file: the first in document order."""
    rest = [c for c in S.ERRORS.fieldNames() if c not in ("path", "ord")]
    first = F.min(F.struct("ord", *rest)).alias("e")
    return errors.groupBy("path").agg(first).select("path", "e.*").select(*S.ERRORS.fieldNames())


def report(errors: DataFrame) -> DataFrame:
    """``errors`` with ``report``, the text shown for an error."""
    # Fixed value: the layout of the report.
    layout = "## %s ##\nLawName: \t%s\nLawNum:  \t%s\nCode:    \t%s\n%s\n\n\n"
    fields = ("error_class", "law_name", "law_num", "code", "error_detail")
    shown = [F.coalesce(c, F.lit(scalars.UNKNOWN)) for c in fields]
    return errors.withColumn("report", F.format_string(layout, *shown))


def key_violations(rows: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once, with their count ``n``."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > 1)


def reference_violations(rows: DataFrame, key: str, referred: DataFrame, referred_key: str) -> DataFrame:
    """Values of ``key`` that the referred table lacks.

    Values are made distinct first, so one frequent value costs no more than a rare one.
    """
    values = rows.select(key).where(F.col(key).isNotNull()).distinct()
    known = referred.select(F.col(referred_key).alias(key))
    return values.join(known, key, "left_anti")
