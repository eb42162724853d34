import os

import pytest
from pyspark.sql import functions as F

from helpers import SIMPLE, article, file_rows, law, main, paragraph, write_tree
from lawtree import schema as S
from lawtree.functions import scalars
from lawtree.operators import stats, validate
from lawtree.plans import ingest as plan
from lawtree.plans import queries
from lawtree.plans.ingest import ingest, ingest_tree
from lawtree.plans.warehouse import Warehouse
from lawtree.sources import files as sources
from lawtree.streaming import ingest as streaming
from lawtree.streaming.ingest import ingest_stream


def numbered(i, kind="条例", text="同じ文"):
    return law(main(article("1", paragraph("1", text, f"文{i}"))), num=f"{kind}第{i}号", name=f"法{i}")


def outcomes(df):
    return {r.path.rsplit("/", 1)[-1]: r.outcome for r in df.collect()}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "warehouse")


def table(spark, root, name):
    return Warehouse(spark, root).table(name)


def test_every_file_has_one_outcome(spark, root):
    files = file_rows(spark, {
        "/c/01/010001/1.xml": numbered(1),
        "/c/01/010001/2.xml": numbered(2, "告示"),
        "/c/01/010001/3.xml": numbered(3)[:-5],
        "/c/01/010001/4.xml": numbered(1),  # the number of file 1
        "/c/01/010001/5.xml": law(main('<Section Num="1"/>'), num="規則第五号"),
        "/c/01/010002/6.xml": numbered(1),  # the same number elsewhere
        "/c/01/010003/7.xml": numbered(7),  # unknown municipality
        "/c/01/010001/x.xml": numbered(8),
    })
    warehouse = Warehouse(spark, root).reset()
    rows = spark.createDataFrame([(0, 10001, "北", "甲"), (1, 10002, "北", "乙")],
                                 "row_no long, code int, pref_name string, muni_name string")
    warehouse.load_dimensions(rows)
    got = outcomes(ingest(spark, files, root, "b1", with_strings=True))
    assert got == {
        "1.xml": "registered", "2.xml": "skipped_not_reiki", "3.xml": "error", "4.xml": "skipped_known",
        "5.xml": "error", "6.xml": "registered", "7.xml": "error", "x.xml": "error",
    }
    counts = stats.outcome_counts(warehouse.table("outcomes")).collect()[0].asDict()
    assert counts == {"files": 8, "registered": 2, "skipped_known": 1, "skipped_not_reiki": 1, "error": 4}
    errors = {(r.path[-5], r.error_class) for r in warehouse.table("errors").collect()}
    assert errors == {
        ("3", "XMLStructureError"), ("5", "HieralchyError"), ("7", "ForeignKeyError"), ("x", "PathCodeError"),
    }
    laws, elements = warehouse.table("laws"), warehouse.table("elements")
    assert laws.count() == 2 and elements.count() == 8
    assert elements.select("law_id").distinct().join(laws, "law_id", "left_anti").count() == 0
    edges, strings = warehouse.table("string_edges"), warehouse.table("strings")
    assert sorted(r.string for r in strings.collect()) == ["同じ文", "文1"]
    joined = edges.join(strings, "string_id").join(elements, ["law_id", "elem_id"])
    assert {(r.sentence_num, r.string) for r in joined.collect()} == {(0, "同じ文"), (1, "文1")}
    assert joined.count() == edges.count() == 4
    assert joined.where(F.get("texts", "sentence_num") != F.col("string")).count() == 0
    assert warehouse.check().count() == 0
    assert validate.key_violations(warehouse.table("outcomes"), "path").count() == 0


def test_check_finds_broken_tables(spark, root):
    files = file_rows(spark, {"/c/01/010001/1.xml": numbered(1)})
    ingest(spark, files, root, "b1", check_municipalities=False, with_strings=True)
    warehouse = Warehouse(spark, root)
    for name in ("elements", "string_edges"):
        rows = warehouse.table(name).where("sentence_num = 0" if name == "string_edges" else "ord = 1")
        extra = {"law_id": F.col("law_id") + 1} if name == "elements" else {"string_id": F.lit("none")}
        warehouse.write(name, "b2", rows.unionByName(rows.withColumns(extra)))
    warehouse.commit("b2", ["elements", "string_edges"])
    got = {r.problem for r in warehouse.check().collect()}
    assert got == {
        "elements: several rows per law_id, elem_id",
        "elements: several rows per law_id, parent_id, etype, num",
        "string_edges: several rows per law_id, elem_id, sentence_num",
        "elements: unknown law_id", "string_edges: unknown string_id", "laws: unknown muni_id",
    }


def test_second_run_adds_nothing(spark, root):
    files = file_rows(spark, {f"/c/01/010001/{i}.xml": numbered(i) for i in range(1, 4)})
    options = {"check_municipalities": False, "with_strings": True}
    ingest(spark, files, root, "b1", **options)
    before = {n: table(spark, root, n).count() for n in ("laws", "elements", "strings", "string_edges")}
    again = ingest(spark, files, root, "b2", **options)
    assert set(outcomes(again).values()) == {"skipped_known"}
    assert {n: table(spark, root, n).count() for n in before} == before
    more = file_rows(spark, {f"/c/01/010001/{i}.xml": numbered(i) for i in range(3, 6)})
    third = ingest(spark, more, root, "b3", **options)
    assert outcomes(third) == {"3.xml": "skipped_known", "4.xml": "registered", "5.xml": "registered"}
    assert table(spark, root, "strings").where("string = '同じ文'").count() == 1
    assert table(spark, root, "laws").count() == 5


def test_same_batch_is_run_once(spark, root):
    files = file_rows(spark, {"/c/01/010001/1.xml": numbered(1)})
    first = outcomes(ingest(spark, files, root, "b1", check_municipalities=False))
    more = file_rows(spark, {"/c/01/010001/2.xml": numbered(2)})
    assert outcomes(ingest(spark, more, root, "b1", check_municipalities=False)) == first
    assert table(spark, root, "laws").count() == 1


def test_unfinished_batches_are_invisible(spark, root, monkeypatch):
    files = file_rows(spark, {"/c/01/010001/1.xml": numbered(1)})

    def fail(self, batch_id, tables):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "commit", fail)
        with pytest.raises(RuntimeError):
            ingest(spark, files, root, "b1", check_municipalities=False)
    for name in ("laws", "elements", "errors", "outcomes"):
        assert table(spark, root, name).count() == 0
    ingest(spark, files, root, "b1", check_municipalities=False)
    assert table(spark, root, "laws").count() == 1 and table(spark, root, "elements").count() == 4


def test_strict_and_lenient(spark, root):
    files = file_rows(spark, {"/c/01/010001/1.xml": law(
        main('<Section Num="1"><Article Num="1"/></Section>'), num="規則第一号")})
    assert outcomes(ingest(spark, files, root, "b1", check_municipalities=False)) == {"1.xml": "error"}
    assert table(spark, root, "elements").count() == 0
    got = ingest(spark, files, root, "b2", check_municipalities=False, strict=False)
    assert outcomes(got) == {"1.xml": "registered"}
    assert table(spark, root, "elements").count() == 3
    assert [r.error_class for r in table(spark, root, "errors").collect()] == ["HieralchyError"] * 2


def test_valid_file_takes_the_place_of_a_broken_one(spark, root):
    broken = law(main('<Section Num="1"/>'), num="規則第一号")
    files = file_rows(spark, {
        "/c/01/010001/1.xml": broken, "/c/01/010001/2.xml": law(main(""), num="規則第一号"),
        "/c/01/010001/3.xml": law(main(""), num="規則第一号"),
    })
    got = outcomes(ingest(spark, files, root, "b1", check_municipalities=False))
    assert got == {"1.xml": "error", "2.xml": "registered", "3.xml": "skipped_known"}


def test_one_number_in_very_many_files(spark, root):
    files = file_rows(spark, {f"/c/01/010001/{i}.xml": law(main(""), num="条例") for i in range(1, 400)})
    counts = stats.outcome_counts(ingest(spark, files, root, "b1", check_municipalities=False)).collect()[0]
    assert (counts.registered, counts.skipped_known) == (1, 398)
    assert table(spark, root, "laws").collect()[0].file_id == 1


def test_id_collisions_are_reported(spark, root, monkeypatch):
    monkeypatch.setattr(scalars, "hash_id", lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(3)))
    files = file_rows(spark, {f"/c/01/010001/{i}.xml": law(main(""), num=f"条例{i}号") for i in range(1, 10)})
    got = stats.outcome_counts(ingest(spark, files, root, "b1", check_municipalities=False)).collect()[0]
    assert got.registered <= 3 and got.registered + got.error == 9
    assert table(spark, root, "laws").select("law_id").distinct().count() == got.registered
    errors = table(spark, root, "errors")
    assert {r.error_class for r in errors.collect()} == {"IdCollisionError"}
    more = file_rows(spark, {f"/c/01/010001/{i}.xml": law(main(""), num=f"規則{i}号") for i in range(1, 30)})
    ingest(spark, more, root, "b2", check_municipalities=False)
    assert table(spark, root, "laws").select("law_id").distinct().count() == table(spark, root, "laws").count() == 3


@pytest.mark.parametrize("count", [1, 9])
def test_trees_of_few_files(spark, tmp_path, root, count):
    corpus = write_tree(tmp_path / "corpus", {f"01/010001/{i:04}.xml": numbered(i) for i in range(1, count + 1)})
    got = ingest_tree(spark, corpus, root, "b1", check_municipalities=False)
    assert sorted(outcomes(got).values()) == ["registered"] * count


def test_tree_is_read_incrementally(spark, tmp_path, root):
    corpus = tmp_path / "123456-corpus"
    write_tree(corpus, {
        "01/010001/0001.xml": "\ufeff" + numbered(1), "01/010001/0002.xml": numbered(2, "告示"),
        "01/010001/0003.xml": numbered(3)[:-5], "01/misc/0004.xml": numbered(4), "01/010001/notes.txt": "x",
        "01/010001/old/0007.xml": numbered(7),
    })
    first = ingest_tree(spark, str(corpus), root, "b1", check_municipalities=False)
    known = {"0001.xml": "registered", "0002.xml": "skipped_not_reiki", "0003.xml": "error", "0007.xml": "error"}
    assert outcomes(first) == known
    write_tree(corpus, {"02/020001/[5].xml": numbered(5), "02/020001/6.xml": numbered(6)})
    second = ingest_tree(spark, str(corpus), root, "b2", check_municipalities=False)
    known |= {"0001.xml": "skipped_known", "[5].xml": "error", "6.xml": "registered"}
    assert outcomes(second) == known
    # Outcomes are stored for files that were open: new ones, and those that failed before.
    stored = outcomes(Warehouse(spark, root).batch("outcomes", "b2"))
    assert sorted(stored) == ["0003.xml", "0007.xml", "6.xml", "[5].xml"]
    third = ingest_tree(spark, str(corpus), root, "b3", check_municipalities=False)
    assert outcomes(third) == known | {"6.xml": "skipped_known"}
    assert table(spark, root, "laws").count() == 2
    states = Warehouse(spark, root).file_states()
    assert outcomes(states) == known | {"0001.xml": "registered"} and states.count() == 6


def test_settled_files_are_not_opened(spark, tmp_path, root):
    """The reader gets spans of modification time that leave out what is settled."""
    corpus = tmp_path / "corpus"
    write_tree(corpus, {f"01/010001/{i:04}.xml": numbered(i) for i in range(1, 9)})
    for i, path in enumerate(sorted(corpus.rglob("*.xml"))):
        os.utime(path, (1_000_000 + i, 1_000_000 + i))
    files = sources.in_municipality(sources.corpus_files(spark, str(corpus)), str(corpus))
    ingest(spark, files.where("file_id NOT IN (3, 4, 7)"), root, "b1", check_municipalities=False)
    listing = files.select("path", "modification_time", "length", "code")
    settled = plan.settled_files(listing, Warehouse(spark, root).file_states(), plan.reading(True, False))
    open_files = listing.join(settled, "path", "left_anti")
    read = files.where(plan.time_spans(open_files))
    assert sorted(r.file_id for r in read.select("file_id").collect()) == [3, 4, 7]
    assert "PushedFilters: [Or(" in read._jdf.queryExecution().toString()
    assert files.where(plan.time_spans(open_files.limit(0))).count() == 0
    # Contents that would fail stand for files that must not be read: same time, same length.
    for path in sorted(corpus.rglob("*.xml")):
        if path.stem not in ("0003", "0004", "0007"):
            stat = path.stat()
            path.write_bytes(b"x" * stat.st_size)
            os.utime(path, (stat.st_mtime, stat.st_mtime))
    got = outcomes(ingest_tree(spark, str(corpus), root, "b2", check_municipalities=False))
    assert got == {f"{i:04}.xml": "registered" if i in (3, 4, 7) else "skipped_known" for i in range(1, 9)}


def test_outcomes_hold_for_the_same_reading(spark, root):
    """A run that reads numbers another way looks at all files again."""
    wide = file_rows(spark, {"/c/01/010001/1.xml": law(main(""), num="条例第１号"), "/c/01/010001/2.xml": law(main(""), num="条例第1号")})
    assert outcomes(ingest(spark, wide, root, "b1", check_municipalities=False)) == {"1.xml": "registered", "2.xml": "registered"}
    again = ingest(spark, wide, root, "b2", check_municipalities=False, fold_width=True)
    assert outcomes(again) == {"1.xml": "skipped_known", "2.xml": "skipped_known"}
    assert Warehouse(spark, root).batch("outcomes", "b2").count() == 2
    assert ingest(spark, wide, root, "b3", check_municipalities=False, fold_width=True).count() == 2
    assert Warehouse(spark, root).batch("outcomes", "b3").count() == 0
    everything = ingest(spark, wide, root, "b4", check_municipalities=False, fold_width=True, reiki_only=False)
    assert set(outcomes(everything).values()) == {"skipped_known"}


def test_changed_file_is_read_again(spark, root):
    ingest(spark, file_rows(spark, {"/c/01/010001/1.xml": numbered(1)}), root, "b1", check_municipalities=False)
    changed = file_rows(spark, {"/c/01/010001/1.xml": numbered(12, text="longer text")})
    assert outcomes(ingest(spark, changed, root, "b2", check_municipalities=False)) == {"1.xml": "registered"}
    assert table(spark, root, "laws").count() == 2
    assert table(spark, root, "outcomes").count() == 2 and Warehouse(spark, root).file_states().count() == 1


def test_compaction(spark, root):
    options = {"check_municipalities": False, "with_strings": True}
    for i in range(1, 4):
        files = file_rows(spark, {f"/c/01/010001/{k}.xml": numbered(k) if k != 9 else numbered(9)[:-3] for k in (i, i + 1, 9)})
        ingest(spark, files, root, f"b{i}", **options)
    warehouse = Warehouse(spark, root)
    names = ("laws", "elements", "strings", "string_edges", "errors")
    before = {n: sorted(map(str, table(spark, root, n).collect())) for n in names}
    states = outcomes(warehouse.file_states())
    assert table(spark, root, "outcomes").count() == 7
    warehouse.compact("c1")
    warehouse.vacuum()
    assert list(warehouse.batches()) == ["c1"] and warehouse.committed().count() == 1
    assert {n: sorted(map(str, table(spark, root, n).collect())) for n in names} == before
    assert outcomes(table(spark, root, "outcomes")) == states and table(spark, root, "outcomes").count() == 5
    # A batch that was compacted is not run again; settled files stay settled.
    assert ingest(spark, file_rows(spark, {"/c/01/010001/8.xml": numbered(8)}), root, "b2", **options).count() == 0
    files = file_rows(spark, {f"/c/01/010001/{k}.xml": numbered(k) for k in (1, 8)})
    assert outcomes(ingest(spark, files, root, "b5", **options)) == {"1.xml": "skipped_known", "8.xml": "registered"}
    assert table(spark, root, "laws").count() == 5


def test_partial_compaction(spark, root):
    warehouse = Warehouse(spark, root)
    for i in range(3):
        ingest(spark, file_rows(spark, {f"/c/01/010001/{i}.xml": numbered(i)}), root, f"b{i}", check_municipalities=False)
    before = {n: sorted(map(str, warehouse.table(n).collect())) for n in ("laws", "elements")}
    warehouse.compact("m", ["b0", "b1"])
    assert set(warehouse.batches()) == {"m", "b2"} and warehouse.committed_ids() == {"b0", "b1", "b2", "m"}
    warehouse.compact("all")
    warehouse.vacuum()
    assert set(warehouse.batches()) == {"all"} and warehouse.committed_ids() == {"b0", "b1", "b2", "m", "all"}
    assert {n: sorted(map(str, warehouse.table(n).collect())) for n in before} == before


def test_dictionary_filter(spark, monkeypatch):
    def strings(low, high):
        return spark.range(low, high).select(F.col("id").cast("string").alias("string")).withColumn("string_id", F.md5("string"))

    known, batch = strings(0, 4000), strings(3900, 4200)
    passed = {r.string_id for r in plan.possibly_among(known, batch).collect()}
    both = {r.string_id for r in strings(3900, 4000).collect()}
    assert both <= passed and len(passed) < 150
    assert plan.possibly_among(known.limit(0), batch).count() == plan.possibly_among(known, batch.limit(0)).count() == 0
    # A filter whose bits are nearly all set lets everything pass, and the result stays right.
    monkeypatch.setattr(plan, "BITMAPS", 1)
    full = strings(0, 400_000)
    assert plan.possibly_among(known, full).count() == 4000


def test_very_deep_file_is_one_outcome(spark, root):
    deep = law(main('<Subitem1 Num="1">' * 3000 + "</Subitem1>" * 3000), num="条例第1号")
    files = file_rows(spark, {"/c/01/010001/1.xml": deep, "/c/01/010001/2.xml": numbered(2)})
    assert outcomes(ingest(spark, files, root, "b1", check_municipalities=False)) == {"1.xml": "error", "2.xml": "registered"}
    errors = [(r.error_class, r.error_detail) for r in table(spark, root, "errors").collect()]
    assert errors == [("XMLStructureError", "ValueError: elements are nested deeper than 128")]


def test_stream(spark, tmp_path, root):
    corpus = tmp_path / "corpus"
    write_tree(corpus, {f"01/010001/{i}.xml": numbered(i) for i in range(1, 4)})

    def run(checkpoint):
        files = sources.in_municipality(sources.corpus_stream(spark, str(corpus), max_files=2))
        query = ingest_stream(
            files, root, str(tmp_path / checkpoint), check_municipalities=False, with_strings=True
        )
        query.awaitTermination()

    run("one")
    assert table(spark, root, "laws").count() == 3
    batches = Warehouse(spark, root).committed().count()
    assert batches == 2
    run("one")
    assert Warehouse(spark, root).committed().count() == batches
    write_tree(corpus, {"01/010001/9.xml": numbered(9)})
    run("one")
    assert table(spark, root, "laws").count() == 4
    run("two")
    assert table(spark, root, "laws").count() == 4
    # Files seen again under a new checkpoint are settled; nothing is stored for them.
    counts = stats.outcome_counts(table(spark, root, "outcomes")).collect()[0]
    assert (counts.files, counts.registered, counts.skipped_known) == (4, 4, 0)
    assert table(spark, root, "strings").count() == 5


def test_stream_merges_micro_batches(spark, tmp_path, root):
    corpus = tmp_path / "corpus"
    write_tree(corpus, {f"01/010001/{i}.xml": numbered(i) for i in range(1, 4)})

    def run():
        files = sources.in_municipality(sources.corpus_stream(spark, str(corpus), max_files=1))
        ingest_stream(files, root, str(tmp_path / "one"), merge_every=2, check_municipalities=False).awaitTermination()

    run()
    warehouse = Warehouse(spark, root)
    assert sorted(b.split("-", 6)[6] for b in warehouse.batches()) == ["0-to-1", "2"]
    assert table(spark, root, "laws").count() == table(spark, root, "outcomes").count() == 3
    warehouse.vacuum()
    assert table(spark, root, "laws").count() == 3
    write_tree(corpus, {"01/010001/9.xml": numbered(9)})
    run()
    assert sorted(b.split("-", 6)[6] for b in warehouse.batches()) == ["0-to-3"]
    assert table(spark, root, "laws").count() == 4
    with pytest.raises(ValueError):
        ingest_stream(sources.corpus_stream(spark, str(corpus)), root, str(tmp_path / "two"), merge_every=1)


def test_municipality_list(spark, tmp_path, root):
    path = tmp_path / "municode.csv"
    path.write_text(
        'code,pref,muni,kana1,kana2\n011002,北海道,札幌市,a,b\n012025,北海道,"函館, 市",a,b\n'
        '472018,沖縄県,"那覇\n市",a,b\n462012,沖縄県,鹿児島市,a,b\n', encoding="utf-8",
    )
    warehouse = Warehouse(spark, root)
    rows = sources.municipality_csv(spark, str(path))
    with pytest.raises(ValueError, match="unknown prefecture"):
        warehouse.load_dimensions(rows)
    warehouse.load_dimensions(rows.where("code <> 462012"))
    assert sorted(warehouse.table("prefectures").collect()) == [(1, "北海道"), (47, "沖縄県")]
    assert sorted(warehouse.table("municipalities").collect()) == [
        (11002, 1, "札幌市"), (12025, 1, "函館, 市"), (472018, 47, "那覇\n市"),
    ]
    from lawtree.operators import dims
    assert {r.name: r.pref_id for r in dims.prefectures(rows).collect()} == {"北海道": 1, "沖縄県": 46}


def test_stored_layout(spark, root):
    files = file_rows(spark, {f"/c/{p:02}/{p:02}0001/{i}.xml": numbered(i) for p in (1, 2) for i in range(1, 4)})
    ingest(spark, files, root, "b1", check_municipalities=False)
    elements = table(spark, root, "elements")
    assert elements.schema == spark.createDataFrame([], elements.schema).schema
    plan_text = elements.where("pref_id = 1 AND law_id = 5")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(pref_id" in plan_text and "Join" not in plan_text
    assert "EqualTo(law_id,5)" in plan_text
    assert set(S.ELEMENTS.fieldNames()) | {"pref_id"} == set(elements.columns)


def test_lookups_read_few_rows(spark, root, tmp_path):
    """One id's filter rules out the files of other laws by their Bloom filters."""
    files = file_rows(spark, {f"/c/{p:02}/{p:02}0001/{i}.xml": numbered(100 * p + i) for p in range(1, 9) for i in range(1, 5)})
    ingest(spark, files, root, "b1", check_municipalities=False, with_strings=True)
    law_id = table(spark, root, "laws").orderBy("law_id").collect()[15].law_id

    def rows_read(df):
        plan_ = df._jdf.queryExecution().executedPlan()
        df._jdf.queryExecution().toRdd().count()
        return plan_.collectLeaves().apply(0).metrics().apply("numOutputRows").value()

    elements = table(spark, root, "elements")
    assert elements.count() == 128
    assert rows_read(elements.where(F.col("law_id") == law_id)) <= 16
    wanted = table(spark, root, "strings").where("string_id = 'none'")
    assert rows_read(wanted) == 0


@pytest.mark.parametrize("name, batches", [("stream_states", 3), ("stream_merged", 3)])
def test_stream_queries_by_files_of_any_number(spark, tmp_path, monkeypatch, name, batches):
    """A table of several files arrives as several files, in as few micro-batches as one of a single file."""
    rows = [(i, f"a {i}\nb", f"src-{i % 3}") for i in range(1, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.repartition(5).write.parquet(str(tmp_path / "in/documents.parquet"))
    epochs = []
    monkeypatch.setattr(streaming, "ingest", lambda *a, **b: epochs.append(a[3]) or ingest(*a, **b))
    monkeypatch.setattr(queries, "scratch_path", lambda _, part: str(tmp_path / "scratch" / part))
    got = queries.QUERIES[name](spark, str(tmp_path / "in")).collect()
    assert len(epochs) == len(set(epochs)) == batches
    assert len(list((tmp_path / "scratch/arriving").glob("*.parquet"))) > 3 * batches
    assert len(got) == (39 if name == "stream_states" else 26)


def test_files_are_parsed_once(spark, root, monkeypatch):
    """One parse per run, in small batches; a file too deep is skipped if its number is known and an error if not."""
    deep = "<Article>" * 200 + "</Article>" * 200
    first = {"/c/01/010001/1.xml": numbered(1), "/c/01/010001/2.xml": numbered(2, "告示")}
    more = {
        "/c/01/010001/3.xml": law(main(deep), num="条例第1号"), "/c/01/010001/4.xml": law(main(deep), num="条例第4号"),
        "/c/01/010001/5.xml": numbered(5)[:-5], "/c/01/010001/6.xml": law(main(deep), num="告示第6号"), "/c/01/010001/7.xml": numbered(7),
    }
    parses, rows, write = [], [], plan.xml.parse_chunks
    monkeypatch.setattr(plan.xml, "parse_chunks", lambda *a, **b: parses.append(a) or write(*a, **b))
    before = spark.conf.get(plan.ARROW_ROWS)
    ingest(spark, file_rows(spark, first), root, "b1", check_municipalities=False)
    with plan.small_batches(spark):
        rows.append(spark.conf.get(plan.ARROW_ROWS))
    got = outcomes(ingest(spark, file_rows(spark, first | more), root, "b2", check_municipalities=False))
    assert len(parses) == 2 and rows == [str(plan.FILES)] and spark.conf.get(plan.ARROW_ROWS) == before
    assert got == {
        "1.xml": "skipped_known", "2.xml": "skipped_not_reiki", "3.xml": "skipped_known", "4.xml": "error", "5.xml": "error",
        "6.xml": "skipped_not_reiki", "7.xml": "registered",
    }
    errors = table(spark, root, "errors").collect()
    assert sorted(e.path[-5:] for e in errors) == ["4.xml", "5.xml"] and all(e.error_class == "XMLStructureError" for e in errors)


def test_tables_without_rows_start_no_python(spark, root):
    for name in ("laws", "elements", "municipalities"):
        empty = table(spark, root, name)
        assert "ExistingRDD" not in empty._jdf.queryExecution().executedPlan().toString()
        assert empty.dtypes == spark.createDataFrame([], S.LAWS if name == "laws" else empty.schema).dtypes and empty.count() == 0
