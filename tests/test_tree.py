from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import article, file_rows, law, main, paragraph, sentence
from lawtree import schema as S
from lawtree.operators import readback, stats, text, tree
from lawtree.sources import xml

BODY = main(
    article("1", "<ArticleCaption>題</ArticleCaption>" + paragraph("1", "あ い1条", "") + paragraph("2", "b", more=(
        '<Item Num="1_2">' + sentence("ItemSentence", "号文") + "</Item>")))
    + article("2_2", paragraph("1", "𠮷ABCカー2"))
    + article("2", paragraph("1", "c"))
)
SUPPL = "<SupplProvision>" + paragraph("1", "附則") + "</SupplProvision>"


@pytest.fixture(scope="module")
def parsed(spark):
    files = file_rows(spark, {
        "/c/01/010001/0001.xml": law(BODY + SUPPL),
        "/c/01/010001/0002.xml": law(main(article("1", paragraph("1", "d"))), name="乙", num="乙規則第二号"),
        "/c/01/010001/0003.xml": law(main(""), name="空", num="空規則"),
    })
    return xml.parse(files, etypes=S.ETYPES)


@pytest.fixture(scope="module")
def rows(parsed):
    return xml.elements(parsed, "law_name").cache()


def first(rows):
    return rows.where("law_name = '試験条例'")


def test_descendants_against_brute_force(rows):
    all_rows = rows.collect()
    got = {
        (r.anc_law_name, r.anc_ord, r.ord)
        for r in tree.descendants(rows.select("law_id", "ord", "lineage"), rows, "law_name").collect()
    }
    want = {
        (a.law_name, a.ord, d.ord)
        for a in all_rows for d in all_rows
        if a.law_id == d.law_id and a.ord < d.ord <= a.end_ord
    }
    assert got == want
    top = tree.top_level(rows, S.PROVISIONS)
    assert tree.descendants(rows, top).count() + top.count() == rows.count()


def test_descendants_by_interval(rows):
    bare = rows.select("law_id", "law_name", "etype", "ord", "end_ord")
    got = tree.descendants_by_interval(bare, bare, "law_name").select("anc_law_name", "anc_ord", "ord").collect()
    want = tree.descendants(rows, rows, "law_name").select("anc_law_name", "anc_ord", "ord").collect()
    assert sorted(got) == sorted(want) and got


def test_intervals_of_large_laws(spark):
    """Intervals on both sides of all block borders, each pair met once."""
    n = 10_000
    places = spark.range(1, n + 1).select(F.lit(1).cast("long").alias("law_id"), F.col("id").cast("int").alias("ord"))
    ends = [(1, n), (1, 1), (7, 8), (8, 8), (63, 4097), (64, 4095), (511, 9_999), (4_095, 8_191), (4_096, 8_192), (9_999, n), (n, n)]
    above = spark.createDataFrame([(1, a, b) for a, b in ends], "law_id long, ord int, end_ord int")
    pairs = tree.descendants_by_interval(places, above, "end_ord")
    got = pairs.groupBy("anc_ord", "anc_end_ord").agg(
        F.count("*"), F.count_distinct("ord"), F.min("ord"), F.max("ord")
    ).collect()
    assert sorted(map(tuple, got)) == sorted((a, b, b - a, b - a, a + 1, b) for a, b in ends if b > a)
    assert tree.descendants_by_interval(places.limit(0), above).count() == 0
    # No key holds more than a block's elements.
    right = pairs.groupBy("ord").count().agg(F.max("count")).first()[0]
    assert right <= len(ends)


def test_descendants_against_recursive_sql(spark, rows):
    rows.select("law_id", "elem_id", "parent_id", "ord").createOrReplaceTempView("elems")
    recursive = spark.sql("""
        WITH RECURSIVE d(law_id, top, elem_id) AS (
            SELECT law_id, elem_id, elem_id FROM elems
            UNION ALL
            SELECT e.law_id, d.top, e.elem_id FROM d JOIN elems e
              ON e.law_id = d.law_id AND e.parent_id = d.elem_id)
        SELECT law_id, top, elem_id FROM d WHERE top <> elem_id""")
    pairs = tree.descendants(rows, rows, "elem_id").select(
        "law_id", F.col("anc_elem_id").alias("top"), "elem_id"
    )
    assert sorted(pairs.collect()) == sorted(recursive.collect())


def test_lineage_can_be_rebuilt(rows):
    again = tree.with_lineage(rows.drop("lineage", "depth"))
    columns = ["law_id", "ord", "depth", "lineage"]
    assert sorted(again.select(columns).collect()) == sorted(rows.select(columns).collect())


def test_children(rows):
    kids = tree.children(first(rows)).where("parent_etype = 'Article' AND etype = 'Paragraph'")
    got = [(r.parent_num_raw, r.num_raw) for r in kids.orderBy("ord").collect()]
    assert got == [("1", "1"), ("1", "2"), ("2_2", "1"), ("2", "1")]
    of_top = tree.children(first(rows), tree.top_level(first(rows), ["MainProvision"]))
    assert [r.num_raw for r in tree.sibling_order(of_top).collect()] == ["1", "2", "2_2"]
    assert [r.num_raw for r in tree.document_order(of_top).collect()] == ["1", "2_2", "2"]


def test_leaves(rows):
    got = [(r.etype, r.ord) for r in tree.document_order(tree.leaves(first(rows))).collect()]
    want = [
        (r.etype, r.ord) for r in first(rows).orderBy("ord").collect()
        if r.etype in S.TEXT_ETYPES
    ]
    assert got == want
    assert [r.etype for r in tree.leaves(rows.where("law_name = '空'")).collect()] == ["MainProvision"]


def test_leaves_after_pruning(rows):
    got = {(r.law_name, r.etype, r.ord) for r in tree.leaves(rows, ["MainProvision", "Article", "Paragraph"]).collect()}
    kept = [
        r for r in rows.collect()
        if r.etype in ("MainProvision", "Article", "Paragraph") and all(a.etype != "SupplProvision" for a in r.lineage)
    ]
    parents = {(r.law_name, r.lineage[-1].ord) for r in kept if r.lineage}
    assert got == {(r.law_name, r.etype, r.ord) for r in kept if (r.law_name, r.ord) not in parents}
    assert ("空", "MainProvision", 1) in got and any(etype == "Paragraph" for _, etype, _ in got)


def test_files_of_one_number_stay_apart(spark):
    one = main(article("1", paragraph("1", "甲")))
    other = main(article("1", paragraph("1", "乙")))
    files = file_rows(spark, {
        "/c/01/010001/0001.xml": law(one), "/c/01/010001/0002.xml": law(other),
        "/c/01/010001/0003.xml": law(one, num=None), "/c/01/010001/0004.xml": law(other, num=None),
    })
    rows = xml.elements(xml.parse(files), "file_id")
    texts = {(r.file_id, r.plaintext) for r in tree.plaintext(rows, "file_id").collect()}
    assert texts == {(1, "甲"), (2, "乙"), (3, "甲"), (4, "乙")}
    assert tree.descendants(rows, rows).count() == 4 * 6
    assert {r.n for r in stats.count_elems_by_law(rows).collect()} == {1}


def test_sentences_and_hook(rows):
    got = tree.sentences(first(rows)).orderBy("ord", "sentence_num").collect()
    assert [(r.sentence_num, r.sentence) for r in got] == [
        (0, "題"), (0, "あ い1条"), (1, ""), (0, "b"), (0, "号文"), (0, "𠮷ABCカー2"), (0, "c"), (0, "附則"),
    ]
    spaced = tree.sentences(first(rows), preprocess=text.spaced()).orderBy("ord", "sentence_num").collect()
    assert spaced[1].sentence == "あ い 1 条" and spaced[5].sentence == "𠮷 ABC カー 2"

    @F.pandas_udf(T.StringType())
    def upper(s):
        return s.str.upper()

    hooked = tree.sentences(first(rows), preprocess=upper).orderBy("ord", "sentence_num").collect()
    assert hooked[3].sentence == "B"


def test_plaintext(rows):
    got = {r.law_name: r.plaintext for r in tree.plaintext(rows, "law_name").collect()}
    assert got == {"試験条例": "題あ い1条b号文𠮷ABCカー2c附則", "乙": "d", "空": ""}


def test_citations(parsed, rows):
    laws = xml.laws(parsed)
    got = [
        r.label for r in tree.citation_labels(first(rows).drop("law_name"), laws).orderBy("ord").collect()
    ]
    head = "試験条例(本則)"
    assert got[:6] == [
        head, f"{head}第1条", f"{head}第1条条見出し", f"{head}第1条第1項", f"{head}第1条第1項第0文",
        f"{head}第1条第2項",
    ]
    assert f"{head}第1条第2項第1号の2第0文" in got and f"{head}第2条の2第1項" in got
    assert got[-3:] == ["試験条例(附則)", "試験条例(附則)第1項", "試験条例(附則)第1項第0文"]


def test_lookup(spark, rows):
    parent = first(rows).where("etype = 'MainProvision'").select("law_id", F.col("elem_id").alias("parent_id"))
    keys = parent.select("*", F.lit("Article").alias("etype"), F.lit(Decimal("2.002")).cast(S.NUM).alias("num"))
    assert [r.num_raw for r in tree.lookup(rows, keys).collect()] == ["2_2"]


def test_counts(rows):
    counts = {r.etype: r.n for r in stats.count_elems(rows, S.ETYPES).collect()}
    assert counts["Article"] == 4 and counts["SupplProvision"] == 1 and counts["Division"] == 0
    assert set(counts) == set(S.ETYPES)
    by_law = {(r.law_name, r.etype): r.n for r in stats.count_elems_by_law(rows, "law_name").collect()}
    assert by_law[("試験条例", "Paragraph")] == 5 and by_law[("乙", "Paragraph")] == 1
    total = stats.count_rollup(rows, "law_name").where("law_name IS NULL AND etype IS NULL").collect()
    assert total[0].n == rows.count()


def test_tokens_and_characters(rows):
    sentences = tree.sentences(first(rows)).where("sentence LIKE '%ABC%' OR sentence LIKE 'あ%'")
    tokens = text.tokenize(sentences).orderBy("ord", "sentence_num", "pos").collect()
    assert [(r.pos, r.token) for r in tokens] == [
        (0, "あ"), (1, "い"), (2, "1"), (3, "条"), (0, "𠮷"), (1, "ABC"), (2, "カー"), (3, "2"),
    ]
    chars = text.characters(tree.sentences(first(rows))).orderBy("ord", "sentence_num", "pos").collect()
    assert "".join(r.char for r in chars) == "題あ い1条b号文𠮷ABCカー2c附則"
    assert [r.pos for r in chars if r.char in "𠮷A"] == [0, 1]


def test_read_back(spark, parsed, rows):
    laws = xml.laws(parsed)
    munis = spark.createDataFrame([(10001, 1, "市")], S.MUNICIPALITIES)
    law_id = first(rows).first().law_id
    head = readback.law_header(laws, munis, law_id).collect()
    assert [(r.file_id, r.muni_id, r.pref_id) for r in head] == [(1, 10001, 1)]
    assert readback.name_and_num(laws, law_id).collect() == [("試験条例", "平成元年条例第1号")]
    assert [r.etype for r in readback.provisions(rows, law_id).collect()] == ["MainProvision"]
    both = readback.provisions(rows, law_id, S.ETYPES).collect()
    assert [r.etype for r in both] == ["MainProvision", "SupplProvision"]
    articles = readback.children_of(rows, law_id, both[0].elem_id).collect()
    assert [r.num_raw for r in articles] == ["1", "2", "2_2"]
    caption = first(rows).where("etype = 'ArticleCaption'").first()
    assert readback.element_content(rows, law_id, caption.elem_id).collect() == [("題",)]
    kept = readback.law_tree(first(rows))
    assert kept.count() == first(rows).count() - 3


def test_lineage_of_broken_trees(spark):
    """Chains, missing parents and cycles, against walking up one by one."""
    import random

    rng, rows = random.Random(3), []
    for law_id in (5, 6):
        ids = list(range(1, 90))
        for i in ids:
            parent = rng.choice([-law_id, i - 1, i - 1, i - 1, rng.choice(ids), 1000 + i] if i > 1 else [-law_id])
            rows.append((law_id, i, parent, i, f"E{i % 3}", str(i), "kept"))
    rows += [(7, 1, -7, 1, "E", "1", "kept")] + [(7, i, i - 1, i, "E", str(i), "kept") for i in range(2, 70)]
    rows += [(8, 1, 1, 1, "E", "1", "kept"), (8, 2, 3, 2, "E", "2", "kept"), (8, 3, 2, 3, "E", "3", "kept"), (8, 4, 2, 4, "E", "4", "kept")]
    names = "law_id long, elem_id long, parent_id long, ord int, etype string, num_raw string, other string"
    got = {(r.law_id, r.elem_id): r for r in tree.with_lineage(spark.createDataFrame(rows, names)).collect()}
    by_id = {(r[0], r[1]): r for r in rows}
    assert got.keys() == by_id.keys()
    for (law_id, elem_id), r in got.items():
        above, at, linkage = [], by_id[law_id, elem_id], None
        while linkage is None:
            if at[2] == -law_id:
                linkage = "rooted"
            elif (law_id, at[2]) not in by_id:
                linkage = "orphan"
            elif len(above) > len(by_id):
                linkage, above = "cycle", []
            else:
                at = by_id[law_id, at[2]]
                above.append((at[3], at[4], at[5]))
        assert (r.linkage, [tuple(a) for a in r.lineage], r.other) == (linkage, above[::-1], "kept")
        assert r.depth == (len(above) + 1 if linkage == "rooted" else None)


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_plaintext_of_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(xml, "CHUNK", chunk)
    files = file_rows(spark, {
        "/c/01/010001/1.xml": law(main(article("1", paragraph("1", "a", "b")) + article("2", paragraph("1", "", "c\n", "d")))),
        "/c/01/010001/2.xml": law(main(article("1"))), "/c/01/010001/3.xml": law(""), "/c/01/010001/4.xml": "<Laws>",
    })
    chunks = xml.parse_chunks(files)
    got = {r.file_id: r.plaintext for r in tree.plaintext_of_chunks(chunks, "file_id").collect()}
    assert got == {1: "abc\nd", 2: ""}
    rows = xml.elements(xml.rows_of(chunks), "file_id")
    assert got == {r.file_id: r.plaintext for r in tree.plaintext(rows, "file_id").collect()}


@pytest.mark.parametrize("operator", [tree.descendants, tree.descendants_by_interval])
def test_ancestors_are_not_broadcast(spark, rows, tmp_path, operator):
    """A stored table of ancestors is small as a file, not as a broadcast."""
    path = str(tmp_path / "rows")
    rows.select("law_id", "ord", "end_ord", "lineage").write.parquet(path)
    stored = spark.read.parquet(path)
    pairs = operator(stored, stored)
    assert pairs.count() == tree.descendants(rows, rows).count() > 0
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
