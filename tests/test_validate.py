import pytest
from pyspark.sql import functions as F

from helpers import SIMPLE, article, file_rows, law, main, one_file, paragraph, sentence
from lawtree import schema as S
from lawtree.operators import dims, validate
from lawtree.sources import xml


def errors_of(spark, body, etypes=S.ETYPES, **options):
    parsed = xml.parse_chunks(
        one_file(spark, law(body)), etypes=etypes,
        include_subitem_sentences=options.get("include_subitem_sentences", False),
    )
    found = validate.validate(parsed, **options)
    return sorted((r.error_class, r.error_detail, r.ord) for r in found.collect())


def bad(parent, child, ord_):
    return ("HieralchyError", f"invalid hieralchy {parent} -> {child}", ord_)


def tag(name, inner="", num="1"):
    return f'<{name} Num="{num}">{inner}</{name}>'


def test_valid_laws(spark):
    body = main(article("1", paragraph("1", "x", more=tag("Item", sentence("ItemSentence", "i"))))) + (
        "<SupplProvision>" + paragraph("1", "s") + "</SupplProvision>"
    ) * 2
    assert errors_of(spark, body) == []


@pytest.mark.parametrize(
    "body, parent, child, ord_",
    [
        (main(tag("Part", tag("Item"))), "Part", "Item", 3),
        (main(tag("Section")), "MainProvision", "Section", 2),
        (main(article("1", "<MainProvision/>")), "Article", "MainProvision", 3),
        (main(article("1", "<SupplProvision/>")), "Article", "SupplProvision", 3),
        (main(article("1", sentence("ParagraphSentence", "x"))), "Article", "ParagraphSentence", 3),
        (main(paragraph("1", "x", more=tag("Subitem1"))), "Paragraph", "Subitem1", 4),
        (main(tag("Chapter", tag("Subsection"))), "Chapter", "Subsection", 3),
        ("<SupplProvision><Chapter/></SupplProvision>", "SupplProvision", "Chapter", 2),
        (main(article("1", tag("Item", tag("Subitem2")))), "Item", "Subitem2", 4),
        (main("<ArticleCaption>x</ArticleCaption>"), "MainProvision", "ArticleCaption", 2),
    ],
)
def test_grammar(spark, body, parent, child, ord_):
    assert errors_of(spark, body) == [bad(parent, child, ord_)]


def test_grammar_table(spark):
    pairs = [(c, p) for c in S.ETYPES for p in (S.ROOT, *S.ETYPES)]
    df = spark.createDataFrame(pairs, "c string, p string")
    allowed = {(r.c, r.p) for r in df.where(validate.grammar_ok(F.col("c"), F.col("p"))).collect()}
    items = {"Item", "Subitem1", "Subitem2", "Subitem3", "Subitem4", "Subitem5"}
    assert {p for c, p in allowed if c == "ItemSentence"} == items
    assert {p for c, p in allowed if c == "Subitem1"} == items
    assert {p for c, p in allowed if c == "Subitem4"} == {"Subitem3"}
    assert {p for c, p in allowed if c == "Article"} == {
        "MainProvision", "SupplProvision", "Part", "Chapter", "Section", "Subsection", "Division",
    }
    assert len(allowed) == sum(len(S.GRAMMAR[e]) for e in S.ETYPES)


def test_item_sentences_sit_under_subitems(spark):
    body = main(article("1", tag("Item", tag("Subitem1", sentence("ItemSentence", "x") + tag(
        "Subitem2", sentence("ItemSentence", "y"))))))
    assert errors_of(spark, body) == []
    inner = main(article("1", tag("Item", tag("Subitem1", sentence("Subitem1Sentence", "x") + tag(
        "Subitem2", sentence("Subitem2Sentence", "y"))))))
    assert errors_of(spark, inner, include_subitem_sentences=True) == []
    wrong = main(article("1", tag("Item", sentence("Subitem3Sentence", "x"))))
    assert errors_of(spark, wrong, include_subitem_sentences=True) == [bad("Item", "Subitem3Sentence", 4)]


def test_duplicates(spark):
    body = main(article("1") + article("2") + article("1") + article("1_0") + tag("Chapter"))
    assert errors_of(spark, body) == [
        ("DuplicateNumberError", "element number duplication: 第1条", 2)
    ]
    across = errors_of(spark, body, check_cross_type_numbers=True)
    assert across[0] == ("DuplicateNumberError", "element number duplication: 第1条", 2)
    assert len(across) == 2 and across[1][0] == "HieralchyError"
    assert across[1][1].startswith("element number duplication: 1.0")
    apart = main(article("1") + tag("Chapter", article("1")))
    assert errors_of(spark, apart) == []
    texts = main(paragraph("1", "x", more=sentence("ParagraphSentence", "y")))
    assert errors_of(spark, texts) == [("DuplicateNumberError", "element number duplication: 第0文", 3)]


def test_two_main_provisions_are_duplicates(spark):
    assert errors_of(spark, main("") + main("")) == [
        ("DuplicateNumberError", "element number duplication: 第0本則", 1)
    ]


def test_num_format(spark):
    nums = {"1-2": False, "2_3_1": True, "": False, "_1": False, "１": False, "1_": False, " 1": False}
    for num, ok in nums.items():
        found = errors_of(spark, main(article(num)))
        assert found == ([] if ok else [("LawElementNumberError", f"Invalid Format {num}", 2)])
    assert errors_of(spark, '<MainProvision Num="x"><Article/></MainProvision>') == []


def test_long_and_deep_numbers(spark):
    deep = main(article("1_1_1_1_1_1_1_1") + article("1_1_1_1_1_1_1_2") + article("20230401001"))
    assert errors_of(spark, deep) == []
    twice = main(article("1_1_1_1_1_1_1_2") + article("1_1_1_1_1_1_1_2_0"))
    assert [e[0] for e in errors_of(spark, twice)] == ["DuplicateNumberError"]
    huge = "9" * 30
    assert errors_of(spark, main(article(huge))) == [("LawElementNumberError", f"Number Too Large {huge}", 2)]


def test_siblings_are_opt_in(spark):
    body = main(article("1") + tag("Chapter", num="2") + article("3"))
    assert errors_of(spark, body) == []
    assert errors_of(spark, body, check_siblings=True) == [
        ("HieralchyError", "different type elements in the same layer: Chapter and Article", 3)
    ]
    body = main(tag("Chapter", num="1") + tag("Chapter", num="2") + article("3") + tag("Part", num="1"))
    assert errors_of(spark, body, check_siblings=True)[-1] == (
        "HieralchyError", "different type elements in the same layer: Article and Chapter", 4
    )
    captioned = main(article("1", "<ArticleCaption>x</ArticleCaption>" + paragraph("1", "y")))
    assert errors_of(spark, captioned, check_siblings=True) == []


def test_pruned_types_are_not_checked(spark):
    assert errors_of(spark, main(tag("Section")), etypes=["MainProvision"]) == []


def test_file_errors_and_reports(spark):
    files = file_rows(spark, {
        "/c/01/010001/1.xml": SIMPLE[:-9],
        "/c/01/010001/x.xml": SIMPLE,
        "/c/01/010001/3.xml": law(main(""), name="長" * 501),
        "/c/01/010001/4.xml": law(main(""), num="1" * 501),
        "/c/01/010002/5.xml": law(main(tag("Section"))),
        "/c/01/010001/6.xml": SIMPLE,
    })
    munis = spark.createDataFrame([(10001, 1, "市")], S.MUNICIPALITIES)
    found = validate.validate(xml.parse_chunks(files), munis)
    rows = {(r.path[-5], r.error_class) for r in found.collect()}
    assert rows == {
        ("1", "XMLStructureError"), ("x", "PathCodeError"), ("3", "LengthError"), ("4", "LengthError"),
        ("5", "ForeignKeyError"), ("5", "HieralchyError"),
    }
    reports = {r.path[-5]: r.report for r in validate.report(found).collect() if r.error_class != "ForeignKeyError"}
    assert reports["5"] == (
        "## HieralchyError ##\nLawName: \t試験条例\nLawNum:  \t平成元年条例第1号\nCode:    \t01/010002/0005\n"
        "invalid hieralchy MainProvision -> Section\n\n\n"
    )
    assert "Code:    \tUNK\n" in reports["x"] and "LawName: \tUNK\n" in reports["1"]
    one = {r.path[-5]: r.ord for r in validate.first_errors(found).collect()}
    assert len(one) == 5 and one["5"] == 0
    kept = validate.without_errors(xml.parse(files), found)
    assert {r.path[-5] for r in kept.collect()} == {"6"}


def test_table_checks(spark):
    rows = spark.createDataFrame([(1, 9), (1, 9), (2, 8), (3, None)], "k int, ref int")
    assert validate.key_violations(rows, "k").collect() == [(1, 2)]
    referred = spark.createDataFrame([(9,)], "id int")
    assert validate.reference_violations(rows, "ref", referred, "id").collect() == [(8,)]


def test_dimension_checks(spark):
    prefs = spark.createDataFrame([(1, "北"), (1, "南"), (2, "長" * 51)], S.PREFECTURES)
    munis = spark.createDataFrame([(30001, 3, "村"), (10001, 1, None)], S.MUNICIPALITIES)
    got = {(r.table_name, r.problem, r.value) for r in dims.check(prefs, munis).collect()}
    assert got == {
        ("prefectures", "duplicate key", "1"), ("prefectures", "name too long", "長" * 51),
        ("municipalities", "unknown prefecture", "30001"), ("municipalities", "no name", "10001"),
    }


MIXED = main(
    article("1", paragraph("1", "a") + paragraph("2", "b") + paragraph("01", "c") + paragraph("x-1", "d"))
    + article("2", paragraph("1", "a", more=tag("Item", tag("Item"), "1") + tag("Item", num="1")))
    + tag("Chapter", article("5") + article("5") + tag("Section") + article("5"))
    + article("1_0") + article("3") + tag("Chapter", num="3") + article("2_1000") + "<Section/>"
) + "<SupplProvision>" + paragraph("1", "s") + paragraph("1", "t") + "</SupplProvision>" + "<SupplProvision/>"


@pytest.mark.parametrize("chunk", [1, 2, 5, 7])
def test_checks_across_chunks(spark, monkeypatch, chunk):
    """A file in several rows has the errors of the file in one row."""
    options = {"check_siblings": True, "check_cross_type_numbers": True}
    whole = errors_of(spark, MIXED, **options)
    assert len(whole) > 12
    monkeypatch.setattr(xml, "CHUNK", chunk)
    assert errors_of(spark, MIXED, **options) == whole


def test_checks_shuffle_no_elements(spark):
    """What is grouped comes from the stored findings; the files are read in a plan without exchange."""
    chunks = xml.parse_chunks(one_file(spark, law(MIXED)), etypes=S.ETYPES)
    found = validate.findings(chunks, S.ETYPES, True, True, whole_files=True)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    # Of the chunk's 30 elements only errors and siblings in question are there.
    valid = law(main("".join(article(str(i), paragraph("1", "x")) for i in range(1, 200))))
    chunks = xml.parse_chunks(one_file(spark, valid))
    assert [r.kind for r in validate.findings(chunks, S.ETYPES, True, True, whole_files=True).collect()] == ["file"]
