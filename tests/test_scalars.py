import random
import unicodedata
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lawtree import schema as S
from lawtree.functions import scalars
from lawtree.functions.numerals import kanji_to_arabic

SMALL = {"十": 10, "拾": 10, "百": 100, "千": 1000}
LARGE = {"万": 10**4, "億": 10**8, "兆": 10**12}
DIGIT = dict(zip("一二三四五六七八九〇壱弐参", "1234567890123"))


def value_below(run, units, plain):
    """Sum of (value on its left, or 1) x unit for every unit of the run."""
    total, left = 0, ""
    for c in run:
        if c in units:
            total += (plain(left) if left else 1) * units[c]
            left = ""
        else:
            left += c
    return total + (plain(left) if left else 0)


def number_of(digits):
    return int("".join(str(unicodedata.decimal(c)) for c in digits))


def expected(text, sep=False):
    text = "".join(DIGIT.get(c, c) for c in text)
    out, run = "", ""
    for c in text + "\0":
        if c in SMALL or c in LARGE or c.isdecimal():
            run += c
            continue
        if run and not run.isdecimal():
            v = value_below(run, LARGE, lambda p: value_below(p, SMALL, number_of))
            run = f"{v:,}" if sep else str(v)
        out += run + c
        run = ""
    return out[:-1]


def test_kanji_examples(spark):
    cases = {
        "昭和五十年条例第十号": "昭和50年条例第10号",
        "千九百九十九": "1999",
        "一九〇": "190",
        "二千万": "20000000",
        "弐拾参": "23",
        "壱": "1",
        "一兆二億三万四": "1000200030004",
        "万億": "100010000",
        "十百": "110",
        "２十": "20",
        "２３": "２３",
        "条例": "条例",
        "": "",
        "第1条の十二と三百": "第1条の12と300",
    }
    df = spark.createDataFrame(list(cases.items()), "s string, want string")
    rows = df.select("s", "want", kanji_to_arabic("s").alias("got")).collect()
    assert [(r.s, r.got) for r in rows] == [(r.s, r.want) for r in rows]
    assert all(expected(s) == want for s, want in cases.items())


@pytest.mark.parametrize("sep", [False, True])
def test_kanji_against_plain_python(spark, sep):
    rng = random.Random(7)
    alphabet = "一二三四五六七八九〇壱弐参十拾百千万億兆０５9年号第٣"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "s string").repartition(8)
    for row in df.select("s", kanji_to_arabic("s", sep).alias("got")).collect():
        assert row.got == expected(row.s, sep), row.s


def test_kanji_numbers_of_any_length(spark):
    rng = random.Random(5)
    texts = ["9" * 45 + "万", "千兆" * 30, "九" * 60, "九" * 18 + "兆" + "九" * 18, "〇" * 40 + "十", "0万"]
    texts += ["".join(rng.choices("一二九〇十百千万億兆", k=80)) for _ in range(200)]
    texts += ["".join(rng.choices("一二九〇" * 9 + "千万", k=150)) for _ in range(100)]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for row in df.select("s", kanji_to_arabic("s").alias("got"), kanji_to_arabic("s", True).alias("sep")).collect():
        assert (row.got, row.sep) == (expected(row.s), expected(row.s, True)), row.s


def numbers(spark, raws, etype="Article"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    path = scalars.num_path(F.lit(etype), F.col("raw"))
    df = df.withColumn("path", path).withColumn("num", scalars.num_value(F.col("path")))
    df = df.withColumn("label", scalars.number_label(F.lit(etype), F.col("path")))
    df = df.withColumn("parts", scalars.num_parts(F.col("num")))
    return df.orderBy("i").collect()


def test_element_numbers(spark):
    rows = numbers(spark, ["2_3_1", "2_600", "1-2", None, "12", "1_1000", "007", "", "1_", "9" * 12, "9" * 25,
                           f"{10**18}_999_0_5"])
    assert [r.num for r in rows] == [
        Decimal("2.003001"), Decimal("2.6"), None, Decimal(0), Decimal(12), Decimal(2), Decimal(7),
        None, None, Decimal("9" * 12), None, 10**18 + Decimal("0.999000005"),
    ]
    assert [r.label for r in rows[:2]] == ["第2条の3の1", "第2条の600"]
    assert rows[3].label == "第0条"
    assert rows[0].parts == [2, 3, 1] and rows[1].parts == [2, 600] and rows[4].parts == [12]


def test_numbers_keep_their_order(spark):
    rng = random.Random(3)
    paths = [tuple(rng.randint(0, 999) for _ in range(rng.randint(1, 7))) for _ in range(800)]
    rows = numbers(spark, ["_".join(map(str, p)) for p in paths])
    for p, r in zip(paths, rows):
        assert r.num == sum(Decimal(n) / 1000**i for i, n in enumerate(p))
    by_num = sorted(range(len(paths)), key=lambda i: (rows[i].num, paths[i]))
    assert [paths[i] for i in by_num] == sorted(paths, key=lambda p: (p + (0,) * 7)[:7] + (len(p),))


def test_unnumbered_types(spark):
    for etype in ("MainProvision", "SupplProvision", "ArticleCaption"):
        assert numbers(spark, ["1-2"], etype)[0].num == 0


def test_laws(spark):
    df = spark.createDataFrame(
        [(" 昭和 五十年　条例第十号\n", 1, 10001, 1), (None, 1, 10001, 12345), ("", 47, 472018, 2),
         ("第１ＡZ号", None, 10001, 1)],
        "raw string, p int, m int, f int",
    )
    num = scalars.law_number("raw")
    rows = df.select(
        num.alias("num"), scalars.is_reiki(num).alias("reiki"),
        scalars.law_number("raw", strip_ws=False).alias("unstripped"),
        scalars.law_number("raw", fold_width=True).alias("folded"),
        scalars.law_code(F.col("p"), F.col("m"), F.col("f")).alias("code"),
        scalars.pref_of(F.col("m")).alias("pref"),
        scalars.law_label(F.lit("名"), num).alias("label"),
    ).collect()
    assert [r.num for r in rows] == ["昭和50年条例第10号", "UNK", "UNK", "第１ＡZ号"]
    assert [r.reiki for r in rows] == [True, False, False, False]
    assert rows[0].unstripped == " 昭和 50年　条例第10号\n"
    assert rows[3].folded == "第1AZ号"
    assert [r.code for r in rows] == ["01/010001/0001", "01/010001/12345", "47/472018/0002", None]
    assert [r.pref for r in rows] == [1, 1, 47, 1]
    assert rows[1].label == "名 (UNK)"


def test_labels_and_ranks(spark):
    df = spark.createDataFrame([(e,) for e in S.ETYPES], "e string")
    rows = df.select(
        scalars.etype_rank(F.col("e")).alias("rank"), scalars.etype_label(F.col("e")).alias("label")
    ).collect()
    assert [r.rank for r in rows] == list(range(18))
    assert [r.label for r in rows] == list(S.ETYPE_LABELS.values())
