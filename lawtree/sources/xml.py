"""Ordinance XML -> rows.

Spark's own XML reader groups children by tag and so loses document order, hence the one
Python step of the package: it reads a file and lists its elements. All rules on names,
numbers, ids and checks are Column expressions on top of it.
"""

from __future__ import annotations

import itertools
import re
import sys
import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawtree import schema as S
from lawtree.functions import scalars

# Executors get these functions by value and need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Size of one output row and of one output batch, in elements. A long file is several rows.
CHUNK = 1_000
BATCH = 20_000
# Elements carry their ancestors, so a file nested deeper than this is an error instead.
MAX_DEPTH = 128
TOO_DEEP = f"ValueError: elements are nested deeper than {MAX_DEPTH}"

_NODES = T.ArrayType(S.NODE)
_CARRIED = [f for f in S.FILES.fields if f.name != "content"]
_OUTPUT = T.StructType(
    _CARRIED
    + [
        T.StructField("name_raw", T.StringType()),
        T.StructField("law_num_raw", T.StringType()),
        T.StructField("parse_error", T.StringType()),
        T.StructField("nodes", _NODES),
    ]
)


def _leading_text(element) -> str | None:
    return element.text if element is not None else None


def _walk(provisions: list, wanted: frozenset, texts: frozenset) -> tuple:
    """Columns (end_ord, depth, etype, num, texts, lineage) of a law, in document order.

    Position 0 stands for the law itself. An unwanted element hides its subtree; text
    elements are not descended into.
    """
    end, depth, etypes, nums, sentences, lineages = [0], [0], [None], [None], [[]], [()]
    none: list = []
    siblings, opened, lineage = [iter(provisions)], [0], ()
    while siblings:
        for element in siblings[-1]:
            etype = element.tag
            if etype not in wanted:
                continue
            ord_, num = len(etypes), element.get("Num")
            end.append(ord_)
            depth.append(len(siblings))
            etypes.append(etype)
            nums.append(num)
            lineages.append(lineage)
            if etype in texts:
                own = [element] if etype == "ArticleCaption" else element.findall("Sentence")
                sentences.append([s.text or "" for s in own])
                continue
            sentences.append(none)
            if len(siblings) >= MAX_DEPTH:
                raise ValueError(f"elements are nested deeper than {MAX_DEPTH}")
            siblings.append(iter(element))
            opened.append(ord_)
            lineage += ((ord_, etype, num),)
            break
        else:
            siblings.pop()
            end[opened.pop()] = len(etypes) - 1
            lineage = lineage[:-1]
    return end, depth, etypes, nums, sentences, lineages


def _read(content, wanted, provisions, texts, body) -> tuple:
    """(name, number, error, node columns) of one file."""
    try:
        root = ET.fromstring(content)
    except Exception as e:  # whatever stops the parser makes this one file an error
        return None, None, f"{type(e).__name__}: {e}", _walk([], wanted, texts)
    name = _leading_text(root.find("Law/LawBody/LawTitle"))
    number = _leading_text(root.find("Law/LawNum"))
    tops = []
    if body is None or (body and body.search("".join((number or "").split()))):
        tops = [e for e in root.findall("Law/LawBody/*") if e.tag in provisions]
    try:
        return name, number, None, _walk(tops, wanted, texts)
    except ValueError as e:
        return name, number, f"{type(e).__name__}: {e}", _walk([], wanted, texts)


def _list_column(lists: list, build) -> pa.ListArray:
    offsets = [0, *itertools.accumulate(map(len, lists))]
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), build(list(itertools.chain.from_iterable(lists)))
    )


def _lineage_array(entries: list) -> pa.StructArray:
    ords, etypes, nums = zip(*entries) if entries else ((), (), ())
    return pa.StructArray.from_arrays(
        [pa.array(ords, pa.int32()), pa.array(etypes, pa.string()), pa.array(nums, pa.string())],
        ["ord", "etype", "num_raw"],
    )


def _node_array(chunks: list) -> pa.StructArray:
    """Node structs of several chunks, each a pair (first ord, node columns)."""
    ords = list(itertools.chain.from_iterable(range(o, o + len(c[0])) for o, c in chunks))
    end, depth, etype, num, texts, lineage = (
        list(itertools.chain.from_iterable(column)) for column in zip(*(c for _, c in chunks))
    )
    return pa.StructArray.from_arrays(
        [
            pa.array(ords, pa.int32()),
            pa.array(end, pa.int32()),
            pa.array(depth, pa.int32()),
            pa.array(etype, pa.string()),
            pa.array(num, pa.string()),
            _list_column(texts, lambda v: pa.array(v, pa.string())),
            _list_column(lineage, _lineage_array),
        ],
        ["ord", "end_ord", "depth", "etype", "num_raw", "texts", "lineage"],
    )


def _parser(wanted: frozenset, body, chunk: int, batch: int):
    """``body``: False for no elements, None for all, or a pattern law numbers must hold."""
    provisions = wanted & set(S.PROVISIONS)
    texts = frozenset(S.TEXT_ETYPES)

    def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            carried = files.drop_columns(["content"])

            def emit(rows: list) -> pa.RecordBatch:
                source, names, numbers, errors, chunks = zip(*rows)
                head = carried.take(pa.array(source, pa.int32()))
                offsets = [0, *itertools.accumulate(len(c[0]) for _, c in chunks)]
                columns = [
                    pa.array(names, pa.string()),
                    pa.array(numbers, pa.string()),
                    pa.array(errors, pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _node_array(chunks)),
                ]
                return pa.RecordBatch.from_arrays(
                    head.columns + columns,
                    names=head.schema.names + ["name_raw", "law_num_raw", "parse_error", "nodes"],
                )

            rows, size = [], 0
            for i, content in enumerate(files.column("content")):
                name, number, error, nodes = _read(content.as_py(), wanted, provisions, texts, body)
                for start in range(0, len(nodes[0]), chunk):
                    part = [column[start:start + chunk] for column in nodes]
                    rows.append((i, name, number, error, (start, part)))
                    size += len(part[0])
                    if size >= batch:
                        yield emit(rows)
                        rows, size = [], 0
            if rows:
                yield emit(rows)

    return parse_batches


def parse_chunks(
    files: DataFrame,
    *,
    etypes: Iterable[str] = S.BASIC_ETYPES,
    include_subitem_sentences: bool = False,
    body: bool = True,
    reiki_only: bool = False,
    strip_ws: bool = True,
    fold_width: bool = False,
) -> DataFrame:
    """Read each file of ``files``; a row has up to CHUNK of a file's elements in ``nodes``.

    The first node of a file has ``ord`` 0 and stands for the file. Elements outside ``etypes`` are left out together with their subtrees. With ``body``
    False only the rows of the files themselves are produced; with ``reiki_only`` that goes
    for files that are no ordinance or rule. ``law_id`` is that of the file: files that share a
    number, or have none, stay apart. Registration gives ids by number.
    """
    wanted = set(etypes)
    if include_subitem_sentences:
        wanted.update(S.SUBITEM_SENTENCES)
    walked = (re.compile(scalars.REIKI) if reiki_only else None) if body else False
    worker = _parser(frozenset(wanted), walked, CHUNK, BATCH)
    chunks = files.select(*S.FILES.fieldNames()).mapInArrow(worker, _OUTPUT)
    # Law columns are computed once per chunk, before the chunk is split into elements.
    number = scalars.law_number("law_num_raw", strip_ws, fold_width)
    laws = chunks.withColumns(
        {"law_name": scalars.law_name(F.col("name_raw")), "law_num": number}
    ).withColumns(
        {
            "law_id": scalars.hash_id(F.col("path")),
            # Numerals play no part in this test, so it need not wait for law_num.
            "is_reiki": scalars.is_reiki(F.expr(scalars.law_number_text("law_num_raw", strip_ws))),
        }
    )
    carried = [f.name for f in _CARRIED]
    return laws.select(
        *carried, "law_id", "law_name", "law_num", "law_num_raw", "is_reiki", "parse_error", "nodes"
    )


def rows_of(chunks: DataFrame) -> DataFrame:
    """One row per element, and one with ``ord`` 0 per file."""
    return chunks.select(*[c for c in chunks.columns if c != "nodes"], F.inline("nodes"))


def heads_of(chunks: DataFrame) -> DataFrame:
    """One row per file, with ``ord`` 0, without its elements."""
    first = F.get("nodes", F.lit(0))["ord"]
    return chunks.where(first == 0).withColumn("ord", F.lit(0)).drop("nodes")


def parse(files: DataFrame, **options) -> DataFrame:
    """Read each file of ``files``; one row per element, and one with ``ord`` 0 per file.

    The options are those of ``parse_chunks``.
    """
    return rows_of(parse_chunks(files, **options))


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("parse_error").isNull())


def reiki(parsed: DataFrame) -> DataFrame:
    """Rows of ordinances and rules only."""
    return parsed.where(F.col("is_reiki"))


def laws(parsed: DataFrame) -> DataFrame:
    """One row per readable file."""
    return readable(parsed).where(F.col("ord") == 0).select(
        "law_id", "pref_id", "muni_id", "file_id", "code",
        F.col("law_name").alias("name"), F.col("law_num").alias("num"),
        F.col("law_num_raw").alias("num_raw"), "is_reiki",
    )


def element_id(law_id: Column, ord_: Column) -> Column:
    return scalars.hash_id(law_id, ord_)


def elements(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per element; ``keep`` names file or law columns to carry along."""
    law, ord_ = F.col("law_id"), F.col("ord")
    etype, num_raw = F.col("etype"), F.col("num_raw")
    parent = F.element_at("lineage", -1)["ord"]
    path = F.col("num_path")
    return (
        readable(parsed)
        .where(ord_ > 0)
        .withColumn("num_path", scalars.num_path(etype, num_raw))
        .withColumns(
            {
                "elem_id": element_id(law, ord_),
                "parent_id": F.when(F.col("depth") == 1, -law).otherwise(element_id(law, parent)),
                "etype_rank": scalars.etype_rank(etype),
                "num": scalars.num_value(path),
            }
        )
        .select(*keep, *S.ELEMENTS.fieldNames())
    )


def with_content(elements: DataFrame) -> DataFrame:
    """Add ``content``, the texts joined. It is derived on read rather than stored twice."""
    return elements.withColumn("content", scalars.content(F.col("texts")))
