"""Kanji numerals inside text, as Column expressions."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kanji digits and units.
KANJI_DIGITS = ("一二三四五六七八九〇壱弐参", "1234567890123")
# Units with their number of zeros.
SMALL_UNITS = {"十": 1, "拾": 1, "百": 2, "千": 3}
LARGE_UNITS = {"万": 4, "億": 8, "兆": 12}

_SMALL = "".join(SMALL_UNITS)
_LARGE = "".join(LARGE_UNITS)

# Every Unicode decimal digit with its ASCII value.
_ND = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
_ND_FROM = "".join(_ND)
_ND_TO = "".join(str(unicodedata.decimal(c)) for c in _ND)


# Every unit is a power of ten, so a number is rewritten as decimal addends: a unit without digits
# before it gets a 1, small units become their zeros, and the zeros of a large unit are put behind
# each addend of its group. 二千五万 -> 2千5万 -> 2000 5万 -> 20000000 + 50000.
_LIMB = 9


def _addends(run: str) -> str:
    """SQL for the addends, as digit strings, of a run of ASCII digits and units."""
    text = f"regexp_replace({run}, '(?<![0-9])(?=[{_SMALL}])|(?<![0-9{_SMALL}])(?=[{_LARGE}])', '1')"
    for unit, zeros in SMALL_UNITS.items():
        text = f"replace({text}, '{unit}', '{'0' * zeros} ')"
    cases = " ".join(f"WHEN '{unit}' THEN '{'0' * zeros}'" for unit, zeros in LARGE_UNITS.items())
    return f"""
      flatten(transform(regexp_extract_all({text}, '[0-9 ]+[{_LARGE}]?', 0),
        g -> transform(regexp_extract_all(g, '[0-9]+', 0),
          a -> concat(a, CASE right(g, 1) {cases} ELSE '' END))))"""


def _long_sum(addends: str) -> str:
    """SQL for the sum of digit strings of any length, added limb by limb with carry."""
    width = f"(cast(ceil(array_max(transform({addends}, a -> length(a))) / {_LIMB}) AS int) * {_LIMB})"
    limbs = f"""
      transform(array({width}), w -> transform(sequence(w - {_LIMB - 1}, 1, -{_LIMB}),
        i -> aggregate({addends}, 0L,
          (s, a) -> s + cast(substring(lpad(a, w, '0'), i, {_LIMB}) AS bigint))))[0]"""
    base = f"{10 ** _LIMB}L"
    return f"""
      aggregate({limbs}, struct(0L AS carry, '' AS digits),
        (r, x) -> struct((r.carry + x) div {base} AS carry,
          concat(lpad(cast((r.carry + x) % {base} AS string), {_LIMB}, '0'), r.digits) AS digits),
        r -> coalesce(nullif(ltrim('0', concat(cast(r.carry AS string), r.digits)), ''), '0'))"""


def _value(run: str) -> str:
    """SQL for the value, as a digit string, of a run of ASCII digits and units."""
    short = "aggregate(n, 0L, (s, a) -> try_add(s, try_cast(a AS bigint)))"
    # The one-element array binds the addends, so that they are found once.
    return f"transform(array({_addends(run)}), n -> coalesce(cast({short} AS string), {_long_sum('n')}))[0]"


def kanji_to_arabic(text: str, sep: bool = False) -> Column:
    """Replace each kanji numeral in ``text``, a column or SQL expression, by Arabic digits.

    Kanji digits are replaced one by one; a run that also holds a unit (十百千万億兆) is
    evaluated as one number of any length, with thousands separators if ``sep``. Runs of digits
    only stay as they are.
    """
    source, target = KANJI_DIGITS
    units = _SMALL + _LARGE
    number = f"{units}\\\\p{{Nd}}"
    ascii_run = f"CASE WHEN t RLIKE '[^0-9{units}]' THEN translate(t, '{_ND_FROM}', '{_ND_TO}') ELSE t END"
    shown = _value(ascii_run)
    if sep:
        shown = f"regexp_replace({shown}, '(?<=[0-9])(?=(?:[0-9]{{3}})+$)', ',')"
    return F.expr(f"""
        array_join(transform(
          regexp_extract_all(translate({text}, '{source}', '{target}'), '[{number}]+|[^{number}]+', 0),
          t -> CASE WHEN t RLIKE '[{units}]' THEN {shown} ELSE t END), '')
    """)
