"""Test corpus: plain-text documents written as ordinance XML with native string functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawtree import schema as S
from lawtree.functions import scalars
from lawtree.sources.files import spread

# Lines of a document as articles of ten paragraphs each. Articles are numbered 1, 2, 2_2, 4,
# 5, 5_2 ...; paragraphs 1 to 10.
_ESCAPED = "replace(replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\r', '&#13;')"
_ARTICLES = """
array_join(transform(sequence(0, cast(ceil(size(lines) / 10) AS int) - 1), a -> concat(
  '<Article Num="', CASE WHEN a % 3 = 2 THEN concat(a, '_2') ELSE string(a + 1) END, '">{caption}',
  array_join(transform(slice(lines, a * 10 + 1, 10), (line, i) -> concat(
    '<Paragraph Num="', {num}, '"><ParagraphSentence><Sentence>', line,
    '</Sentence></ParagraphSentence></Paragraph>')), ''),
  '</Article>')), '')
"""


def corpus_from_documents(
    documents: DataFrame,
    *,
    captions: bool = False,
    main_extra: Column | None = None,
    body_extra: Column | None = None,
    paragraph_num: str = "string({n})",
    edit: Callable[[Column], Column] = lambda xml: xml,
) -> DataFrame:
    """One XML file per document: each line a paragraph, ten lines an article.

    ``main_extra`` and ``body_extra`` add XML at the end of the main provision and of the
    body. ``paragraph_num`` is SQL for the number of paragraph ``{n}`` of an article;
    ``edit`` changes the finished text.
    """
    doc = F.col("doc_id")
    kind = F.element_at(F.array(*map(F.lit, ("号条例", "号規則", "号告示"))), (doc % 3 + 1).cast("int"))
    law_num = F.concat(
        F.lit("第"), F.translate(doc.cast("string"), "0123456789", "〇一二三四五六七八九"), kind
    )
    nothing = F.lit("")
    caption = "<ArticleCaption>caption</ArticleCaption>" if captions else ""
    articles = _ARTICLES.format(caption=caption, num=paragraph_num.replace("{n}", "(i + 1)"))
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><Laws><Law><LawNum>'), law_num,
        F.lit("</LawNum><LawBody><LawTitle>doc-"), doc.cast("string"),
        F.lit("</LawTitle><MainProvision>"),
        F.expr(articles),
        main_extra if main_extra is not None else nothing,
        F.lit("</MainProvision>"),
        body_extra if body_extra is not None else nothing,
        F.lit("</LawBody></Law></Laws>"),
    )
    source_no = F.regexp_extract("source", "([0-9]+)", 1).cast("int")
    documents = spread(documents, "doc_id")
    files = documents.withColumn("lines", F.split(F.expr(_ESCAPED), "\n")).select(
        ((source_no + 1) * 10000 + doc % 7).cast("int").alias("muni_id"),
        doc.cast("int").alias("file_id"),
        # Of the document rather than the file, so that a listing need not build the file.
        F.octet_length("text").cast("long").alias("length"),
        F.encode(edit(xml), "UTF-8").alias("content"),
    )
    files = files.withColumn("pref_id", scalars.pref_of(F.col("muni_id")))
    files = files.withColumn("code", scalars.law_code(*map(F.col, ("pref_id", "muni_id", "file_id"))))
    return files.select(
        F.concat(F.lit("documents/"), "code", F.lit(".xml")).alias("path"),
        F.timestamp_seconds(F.lit(0)).alias("modification_time"),
        "length", "pref_id", "muni_id", "file_id", "code", "content",
    ).select(*S.FILES.fieldNames())
