import pytest
from pyspark.sql import functions as F

from helpers import SIMPLE, article, file_rows, law, main, one_file, paragraph, sentence, write_tree
from lawtree import schema as S
from lawtree.operators import tree
from lawtree.sources import xml
from lawtree.sources import files as sources

WRITTEN = "\ufeff" + law(
    main(
        '<Chapter Num="1"><ChapterTitle>総則</ChapterTitle>'
        + article("3", paragraph("1", "甲", "乙", "丙 "))
        + article("3_2", "<ArticleCaption>　題　</ArticleCaption>" + paragraph("1", "\t丁", more=(
            '<Item Num="1"><ItemTitle>イ</ItemTitle>' + sentence("ItemSentence", " 戊") + "</Item>")))
        + "</Chapter>"
    )
    + "<SupplProvision>" + paragraph("1", "己\n庚") + "</SupplProvision>",
    num="規則第七号",
)

DEEP = law(
    main(
        '<Part Num="1"><Chapter Num="1"><Section Num="1"><Subsection Num="1"><Division Num="1">'
        + article("1", paragraph("1", "p", more=(
            '<Item Num="1">' + sentence("ItemSentence", "i")
            + '<Subitem1 Num="1">' + sentence("Subitem1Sentence", "s1")
            + '<Subitem2 Num="1">' + sentence("Subitem2Sentence", "s2")
            + '<Subitem3 Num="1">' + sentence("Subitem3Sentence", "s3")
            + '<Subitem4 Num="1">' + sentence("Subitem4Sentence", "s4")
            + '<Subitem5 Num="1">' + sentence("Subitem5Sentence", "s5")
            + "</Subitem5></Subitem4></Subitem3></Subitem2></Subitem1></Item>")))
        + "</Division></Subsection></Section></Chapter></Part>"
    )
)


def parsed_elements(spark, content, **options):
    rows = xml.elements(xml.parse(one_file(spark, content), **options))
    return rows.orderBy("ord").collect()


def types(rows):
    out = {}
    for r in rows:
        out[r.etype] = out.get(r.etype, 0) + 1
    return out


def test_counts_of_a_file(spark):
    rows = parsed_elements(spark, WRITTEN)
    assert types(rows) == {
        "MainProvision": 1, "Chapter": 1, "Article": 2, "ArticleCaption": 1, "Paragraph": 2, "ParagraphSentence": 2,
        "Item": 1, "ItemSentence": 1,
    }
    assert sum(len(r.texts) for r in rows) == 6
    rows = parsed_elements(spark, WRITTEN, etypes=S.ETYPES)
    assert len(rows) == 14 and sum(len(r.texts) for r in rows) == 7


def test_texts_are_kept_as_written(spark):
    rows = parsed_elements(spark, WRITTEN, etypes=S.ETYPES)
    assert [t for r in rows for t in r.texts] == ["甲", "乙", "丙 ", "　題　", "\t丁", " 戊", "己\n庚"]


def test_text_rules(spark):
    body = main(article("1", paragraph("1", "a &amp; b", "", "x<Ruby>y</Ruby>z") + "<ArticleCaption/>"))
    rows = parsed_elements(spark, law(body))
    assert [r.texts for r in rows if r.texts] == [["a & b", "", "x"], [""]]


def test_order_and_intervals(spark):
    body = main(
        article("1", paragraph("1", "a")) + f'<Chapter Num="1">{article("2", paragraph("1", "b"))}</Chapter>'
        + article("3", paragraph("1", "c"))
    )
    rows = parsed_elements(spark, law(body))
    assert [r.ord for r in rows] == list(range(1, len(rows) + 1))
    assert [r.etype for r in rows if r.depth == 2] == ["Article", "Chapter", "Article"]
    by_ord = {r.ord: r for r in rows}
    for r in rows:
        inside = [x.ord for x in rows if r.ord in [a.ord for a in x.lineage]]
        assert inside == list(range(r.ord + 1, r.end_ord + 1))
        assert len(r.lineage) == r.depth - 1
        for a in r.lineage:
            assert (by_ord[a.ord].etype, by_ord[a.ord].num_raw) == (a.etype, a.num_raw)
        parent = by_ord[r.lineage[-1].ord].elem_id if r.lineage else -r.law_id
        assert r.parent_id == parent
    assert len({r.elem_id for r in rows}) == len(rows)


def test_every_level_and_subitem_texts(spark):
    rows = parsed_elements(spark, DEEP)
    assert [r.etype for r in rows if r.etype not in S.TEXT_ETYPES] == [
        "MainProvision", "Part", "Chapter", "Section", "Subsection", "Division", "Article", "Paragraph",
        "Item", "Subitem1", "Subitem2", "Subitem3", "Subitem4", "Subitem5",
    ]
    assert [t for r in rows for t in r.texts] == ["p", "i"]
    rows = parsed_elements(spark, DEEP, include_subitem_sentences=True)
    assert [t for r in rows for t in r.texts] == ["p", "i", "s1", "s2", "s3", "s4", "s5"]


def test_types_prune_subtrees(spark):
    rows = parsed_elements(spark, DEEP, etypes=[e for e in S.BASIC_ETYPES if e != "Section"])
    assert [r.etype for r in rows] == ["MainProvision", "Part", "Chapter"]
    everything = xml.elements(xml.parse(one_file(spark, DEEP)))
    kept = tree.prune(everything, [e for e in S.BASIC_ETYPES if e != "Section"])
    assert [r.etype for r in kept.orderBy("ord").collect()] == ["MainProvision", "Part", "Chapter"]


def test_only_provisions_at_the_top(spark):
    rows = parsed_elements(spark, law(article("1") + main("") + "<Unknown>" + main("") + "</Unknown>"))
    assert [r.etype for r in rows] == ["MainProvision"]


def test_header_defaults_and_several_laws(spark):
    two = SIMPLE.replace("</Laws>", "<Law><LawNum>x</LawNum><LawBody><LawTitle>y</LawTitle>"
                         + main(article("9")) + "</LawBody></Law></Laws>")
    files = file_rows(spark, {
        "/c/01/010001/1.xml": law(main(""), name=None, num=None),
        "/c/01/010001/2.xml": two,
        "/c/01/010001/3.xml": law(main(""), name="", num=""),
    })
    rows = xml.laws(xml.parse(files)).orderBy("file_id").collect()
    assert [(r.name, r.num) for r in rows] == [
        ("UNK", "UNK"), ("試験条例", "平成元年条例第1号"), ("UNK", "UNK"),
    ]
    bodies = xml.elements(xml.parse(files.where("file_id = 2")))
    assert bodies.where("etype = 'Article'").count() == 2


def test_unreadable_files_are_rows(spark):
    files = file_rows(spark, {
        "/c/01/010001/1.xml": SIMPLE[:-9],
        "/c/01/010001/2.xml": b"",
        "/c/01/010001/3.xml": SIMPLE,
        "/c/01/010001/4.xml": SIMPLE.replace('encoding="UTF-8"', 'encoding="no-such"'),
    })
    parsed = xml.parse(files)
    heads = parsed.where("ord = 0").orderBy("file_id").collect()
    assert [r.parse_error is None for r in heads] == [False, False, True, False]
    assert xml.elements(parsed).select("law_id").distinct().count() == 1
    assert xml.laws(parsed).count() == 1


def test_reiki_only_skips_bodies_not_files(spark):
    files = file_rows(spark, {
        "/c/01/010001/1.xml": SIMPLE,
        "/c/01/010001/2.xml": law(main(article("1")), num="平成元年告示第一号"),
        "/c/01/010001/3.xml": law(main(article("1")), num="平成元年 規 則第二号"),
    })
    rows = xml.parse(files, reiki_only=True)
    assert rows.where("ord = 0").count() == 3
    assert {r.file_id for r in rows.where("ord > 0").collect()} == {1, 3}
    assert {r.file_id for r in xml.reiki(rows).collect()} == {1, 3}


@pytest.mark.parametrize("chunk, batch", [(1, 1), (3, 5), (7, 1000)])
def test_chunks_make_no_difference(spark, monkeypatch, chunk, batch):
    files = file_rows(spark, {f"/c/01/010001/{i}.xml": WRITTEN for i in range(5)})
    whole = xml.elements(xml.parse(files), "path").orderBy("path", "ord").collect()
    monkeypatch.setattr(xml, "CHUNK", chunk)
    monkeypatch.setattr(xml, "BATCH", batch)
    assert xml.elements(xml.parse(files), "path").orderBy("path", "ord").collect() == whole


def test_counts_agree_with_native_xpath(spark):
    files = file_rows(spark, {"/c/01/010001/1.xml": SIMPLE, "/c/01/010001/2.xml": DEEP})
    native = files.select(
        "path", F.expr("xpath_int(decode(content, 'UTF-8'), 'count(//Paragraph | //Article | //Item)')").alias("n")
    )
    own = xml.elements(xml.parse(files), "path").where(
        F.col("etype").isin("Paragraph", "Article", "Item")
    ).groupBy("path").agg(F.count("*").cast("int").alias("n"))
    assert sorted(native.collect()) == sorted(own.collect())


def test_codes_from_paths(spark):
    paths = ["file:/x/01/010001/0012.xml", "/47/472018/a.xml", "1.xml", "/x/1/12345/7.v2.xml", "/x/99999/010001/1"]
    df = sources.with_codes(spark.createDataFrame([(p,) for p in paths], "path string"))
    rows = df.collect()
    assert [(r.pref_id, r.muni_id, r.file_id, r.code) for r in rows] == [
        (1, 10001, 12, "01/010001/0012"),
        (47, 472018, None, None),
        (None, None, 1, None),
        (1, 12345, None, None),
        (None, 10001, 1, None),
    ]
    assert {r.path for r in sources.in_municipality(df).collect()} == {paths[0], paths[1], paths[4]}


def test_listing(spark, tmp_path):
    root = write_tree(tmp_path / "c", {
        "01/010001/0001.xml": SIMPLE, "01/010001/0002.XML": SIMPLE, "01/010001/x.txt": "x", "top.xml": SIMPLE,
    })

    def names(**options):
        return {r.path.rsplit("/", 1)[-1] for r in sources.corpus_files(spark, root, **options).collect()}

    assert names() == {"0001.xml", "top.xml"}
    assert names(extensions=[".XML", ".txt"]) == {"0002.XML", "x.txt"}
    assert names(extensions=None) == {"0001.xml", "0002.XML", "x.txt", "top.xml"}
    listed = sources.corpus_files(spark, root).select("path", "length")
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    row = sources.corpus_files(spark, root).where("file_id = 1").collect()[0]
    assert (row.code, bytes(row.content)) == ("01/010001/0001", SIMPLE.encode())


def test_one_very_long_law(spark):
    n = 20_000
    body = main("".join(article(str(i), paragraph("1", f"文{i}。")) for i in range(1, n + 1)))
    rows = xml.elements(xml.parse(one_file(spark, law(body))), "law_name")
    assert rows.count() == 3 * n + 1
    assert tree.plaintext(rows).collect()[0].plaintext == "".join(f"文{i}。" for i in range(1, n + 1))
    pairs = tree.descendants(rows, rows.where("depth = 1"))
    assert pairs.count() == 3 * n
    last = rows.where(f"ord = {3 * n + 1}").select(tree.citation(F.col("law_name")).alias("label"))
    assert last.collect()[0].label == f"試験条例(本則)第{n}条第1項第0文"
