"""Scalar rules for laws and elements, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lawtree import schema as S
from lawtree.functions.numerals import kanji_to_arabic

# The format of a number attribute, the text for what is missing, the marks of ordinances and rules.
NUM_FORMAT = "^[0-9]+(?:_[0-9]+)*$"
UNKNOWN = "UNK"
REIKI = "条例|規則"

# Full-width digits and letters with their half-width forms (a constant code point shift).
_WIDE = "".join(chr(c) for r in ("０９", "ＡＺ", "ａｚ") for c in range(ord(r[0]), ord(r[1]) + 1))
_NARROW = "".join(chr(ord(c) - 0xFEE0) for c in _WIDE)


def lookup(table: dict, key: Column) -> Column:
    """Value of a fixed table, or NULL. The table is one literal rather than a Column per cell."""

    def cell(value) -> str:
        if isinstance(value, tuple):
            return f"array({', '.join(map(cell, value))})"
        return f"'{value}'" if isinstance(value, str) else str(value)

    cells = ", ".join(f"{cell(k)}, {cell(v)}" for k, v in table.items())
    return F.try_element_at(F.expr(f"map({cells})"), key)


def default_text(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def law_name(raw: Column) -> Column:
    return default_text(raw, UNKNOWN)


def law_number_text(raw: str, strip_ws: bool = True) -> str:
    text = f"coalesce(nullif({raw}, ''), '{UNKNOWN}')"
    return rf"regexp_replace({text}, '(?U)\\s+', '')" if strip_ws else text


def law_number(raw: str, strip_ws: bool = True, fold_width: bool = False) -> Column:
    """Law number with kanji numerals turned to digits; 'UNK' if the file has none.

    ``raw`` is a column name or SQL expression.
    """
    text = law_number_text(raw, strip_ws)
    if fold_width:
        text = f"translate({text}, '{_WIDE}', '{_NARROW}')"
    return kanji_to_arabic(text)


def is_reiki(num: Column) -> Column:
    """Ordinances (条例) and rules (規則)."""
    return num.rlike(REIKI)


def law_code(pref_id: Column, muni_id: Column, file_id: Column) -> Column:
    code = F.format_string("%02d/%06d/%04d", pref_id, muni_id, file_id)
    return F.when(pref_id.isNotNull() & muni_id.isNotNull() & file_id.isNotNull(), code)


def law_label(name: Column, num: Column) -> Column:
    return F.format_string("%s (%s)", name, num)


def pref_of(muni_id: Column) -> Column:
    """Prefecture code: the municipality code without its last four digits."""
    return F.floor(muni_id / 10000).try_cast("smallint")


def hash_id(*cols: Column) -> Column:
    """Non-negative 63-bit id."""
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << 63) - 1))


def string_id(string: Column) -> Column:
    """128-bit id. Corpora hold so many distinct sentences that 63-bit hashes would collide."""
    return F.md5(string)


def _unnumbered(etype: Column, num_raw: Column) -> Column:
    return etype.isin(*S.UNNUMBERED_ETYPES) | num_raw.isNull()


def _numbered(etype: Column, num_raw: Column) -> Column:
    """The number text that counts: '0' for provisions, captions and missing attributes."""
    return F.when(_unnumbered(etype, num_raw), F.lit("0")).otherwise(num_raw)


def num_ok(etype: Column, num_raw: Column) -> Column:
    return _numbered(etype, num_raw).rlike(NUM_FORMAT)


def num_path(etype: Column, num_raw: Column) -> Column:
    """'2_3_1' -> [2, 3, 1]; NULL if the format is wrong or a part does not fit a BIGINT."""
    parts = F.transform(F.split(num_raw, "_"), lambda p: p.try_cast("bigint"))
    numbered = F.when(num_raw.rlike(NUM_FORMAT) & F.forall(parts, lambda p: p.isNotNull()), parts)
    return F.when(_unnumbered(etype, num_raw), F.array(F.lit(0).cast("bigint"))).otherwise(numbered)


def num_value(path: Column) -> Column:
    """[2, 3, 1] -> 2.003001: each branch level is worth a thousandth of the one above.

    Six levels fit; ``num_deep`` has the others.
    """
    # Types of 37 and 36 digits keep the 18 decimals in a sum; a product would cut them.
    def shifted(n: Column, i: Column) -> Column:
        digits, zeros = F.lpad(n.cast("string"), 40, "0"), (i + 1) * 3
        text = F.concat(F.left(digits, F.lit(40) - zeros), F.lit("."), F.right(digits, zeros))
        return text.cast("decimal(36,18)")

    branches = F.transform(F.slice(path, 2, 6), shifted)
    total = F.aggregate(
        branches, F.get(path, 0).cast("decimal(37,18)"), lambda acc, x: (acc + x).cast("decimal(37,18)")
    )
    first = F.get(path, 0).cast(S.NUM)
    return F.when(F.size(path) == 1, first).otherwise(total.cast(S.NUM))


def num_deep(path: Column) -> Column:
    """The branch levels that ``num_value`` has no room for, as text; '' if there are none.

    Trailing zeros count for nothing, as in a number. Parts over 999 are not carried over.
    """
    text = F.array_join(F.transform(F.slice(path, 8, F.size(path) + 1), lambda p: p.cast("string")), "_")
    return F.regexp_replace(text, "(^|_)0(_0)*$", "")


def num_parts(num: Column) -> Column:
    """2.003001 -> [2, 3, 1]: the parts a stored number shows."""
    text = F.split(F.replace(F.format_number(num, 18), F.lit(","), F.lit("")), r"\.")
    branches = F.regexp_replace(F.get(text, 1), "(000)+$", "")
    parts = F.concat(
        F.array(F.get(text, 0)), F.regexp_extract_all(branches, F.lit("[0-9]{3}"), F.lit(0))
    )
    return F.transform(parts, lambda p: p.try_cast("bigint"))


def etype_rank(etype: Column) -> Column:
    return lookup(S.ETYPE_RANK, etype)


def etype_label(etype: Column) -> Column:
    return lookup(S.LABELS, etype)


def number_label(etype: Column, path: Column) -> Column:
    """[2, 3, 1] of an Article -> 第2条の3の1."""
    branches = F.transform(
        F.slice(path, 2, F.greatest(F.size(path) - 1, F.lit(0))),
        lambda n: F.concat(F.lit("の"), n.cast("string")),
    )
    return F.concat(
        F.lit("第"), F.get(path, 0).cast("string"), etype_label(etype), F.array_join(branches, "")
    )


def label_part(etype: Column, path: Column) -> Column:
    """What one element adds to a citation."""
    return (
        F.when(etype.isin(*S.PROVISIONS), F.concat(F.lit("("), etype_label(etype), F.lit(")")))
        .when(etype == "ArticleCaption", etype_label(etype))
        .otherwise(number_label(etype, path))
    )


def content(texts: Column) -> Column:
    return F.array_join(texts, "")
