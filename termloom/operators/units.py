"""Quantities in different units brought to common ones.

A multi-pattern automaton finds aliases of units, multipliers and qualifiers in
the texts of an amount and its unit columns; the longest match wins, and a match
must not cut a word. Context settles what stands alone: a unit in the amount
itself comes before the unit column, that before the second-language column.
What is read becomes ``number, multiplier, unit``, and a broadcast table of
exact conversion factors (fixed, some twenty rows) turns it into common units.
Numbers are fractions of whole numbers throughout, so only the result is rounded.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from fractions import Fraction

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import runtime

# Factor of each unit in its common unit (SI prefixes and avoirdupois definitions are exact).
FACTORS = [
    ("kg", "ng", 1_000_000_000_000),
    ("g", "ng", 1_000_000_000),
    ("mg", "ng", 1_000_000),
    ("ug", "ng", 1_000),
    ("ng", "ng", 1),
    ("lb", "ng", 453_592_370_000),
    ("oz", "ng", 28_349_523_125),
    ("gr", "ng", 64_798_910),
    ("l", "ul", 1_000_000),
    ("dl", "ul", 100_000),
    ("cl", "ul", 10_000),
    ("ml", "ul", 1_000),
    ("ul", "ul", 1),
    ("iu", "iu", 1),
    ("cfu", "cfu", 1),
    ("percent", "ppm", 10_000),
    ("permille", "ppm", 1_000),
    ("ppm", "ppm", 1),
]
# Spellings of the units, in lower case, English and French.
UNITS = {
    "kg": "kg kgs kilogram kilograms kilogramme kilogrammes kilo kilos",
    "g": "g gm gms gr. gram grams gramme grammes",
    "mg": "mg mgs mgm milligram milligrams milligramme milligrammes",
    "ug": "ug mcg mcgs \u03bcg microgram micrograms microgramme microgrammes",
    "ng": "ng nanogram nanograms nanogramme nanogrammes",
    "lb": "lb lbs pound pounds livre livres",
    "oz": "oz ounce ounces once onces",
    "gr": "grain grains",
    "l": "l liter liters litre litres",
    "dl": "dl deciliter deciliters decilitre decilitres",
    "cl": "cl centiliter centiliters centilitre centilitres",
    "ml": "ml mls cc milliliter milliliters millilitre millilitres",
    "ul": "ul \u03bcl microliter microliters microlitre microlitres",
    "iu": "iu ui i.u. u.i.|int. units|int units|international unit|international units|unité internationale|unités internationales",
    "cfu": "cfu cfus ufc c.f.u. u.f.c.|colony forming unit|colony forming units|colony-forming units|cells cfu|viable cells cfu|unités formant colonies|unités formatrices de colonies",
    "percent": "% percent pct pct.|per cent|pour cent|% w/w|% (w/w)|%w/w",
    "permille": "‰",
    "ppm": "ppm|p.p.m.|parts per million",
}
# Multipliers.
TIMES = {
    "thousand": 10**3, "thousands": 10**3, "mille": 10**3, "million": 10**6, "millions": 10**6, "mio": 10**6,
    "billion": 10**9, "billions": 10**9, "milliard": 10**9, "milliards": 10**9, "bn": 10**9, "trillion": 10**12, "trillions": 10**12,
}
# Qualifiers that change nothing.
QUALIFIERS = ["rae", "re", "dfe", "ne", "ate", "gae"]
MASS = {u: f for u, to, f in FACTORS if to == "ng"}

_SPACE = re.compile(r"[\s\u00a0\u2000-\u200b\u202f\u205f\u3000]+")
_THOUSANDS_SPACE = re.compile(r"(?<![\d.,])(\d{1,3})((?: \d{3})+)(?!\d)")
_NUMBER = re.compile(r"(?<![\w.,])[+]?(\d+(?:[.,]\d+)*|[.,]\d+)(e[+-]?\d{1,3})?(?![\d])")
_FRACTION = re.compile(r"(?:(\d{1,3}) )?(\d{1,3}) ?[/\u2044] ?([1-9]\d{0,2})(?![\d/.,])")
_GLYPHS = {"\u00bd": "1/2", "\u00bc": "1/4", "\u00be": "3/4"}
_POWER = re.compile(r"(?:(?<=\d)|(?<![\w.]))\s*(?:[x×*]\s*)?10\s*(?:\^|\*\*|e)\s*(\d{1,2})(?!\d)")
_PER = re.compile(r"(?:/\s*|\bper\s+|\bpar\s+|\bpour\s+|\ba\s+)(?:1\s+)?([^\W\d_]+(?:\s[^\W\d_]+)?)\s*$")
_COMMA3 = re.compile(r",(?=\d{3}(?!\d))")


def automaton() -> ahocorasick.Automaton:
    """The automaton of all aliases: each yields ``kind, value, length``."""
    a = ahocorasick.Automaton()
    for unit, text in UNITS.items():
        first, *phrases = text.split("|")
        words = first.split(" ")
        for alias in [*words, *phrases]:
            for form in {alias, alias.rstrip(".")}:
                if form:
                    a.add_word(form, ("unit", unit, len(form)))
    for word, n in TIMES.items():
        a.add_word(word, ("times", n, len(word)))
    for word in QUALIFIERS:
        a.add_word(word, ("qualifier", word, len(word)))
    a.make_automaton()
    return a


def fold(text: str | None) -> str:
    """Lower case, one micro sign, single spaces, no outer brackets; null gives the empty text."""
    if not text:
        return ""
    text = unicodedata.normalize("NFC", text).casefold().replace("\u00b5", "\u03bc")
    text = _SPACE.sub(" ", text).strip()
    while len(text) > 1 and text[0] + text[-1] in ("()", "[]", "{}", '""', "''"):
        text = text[1:-1].strip()
    return text


def _longest(text: str, a: ahocorasick.Automaton) -> list[tuple[int, int, str, object]]:
    """Matches that cut no word, longest first at each place, without overlap, left to right."""
    found = []
    for end, (kind, value, n) in a.iter(text):
        start, stop = end - n + 1, end + 1
        if text[start].isalpha() and start and text[start - 1].isalpha() or text[stop - 1].isalpha() and stop < len(text) and text[stop].isalpha():
            continue
        found.append((start, stop, kind, value))
    found.sort(key=lambda m: (m[0], -m[1]))
    out: list[tuple[int, int, str, object]] = []
    for m in found:
        if not out or m[0] >= out[-1][1]:
            out.append(m)
    return out


def read_unit(text: str, a: ahocorasick.Automaton) -> tuple[int, str, int] | None:
    """``multiplier, unit, divisor`` of a folded text that states one unit and nothing else of weight."""
    times, divisor = 1, 0
    m = _POWER.match(text)
    if m:
        times, text = 10 ** int(m[1]), text[m.end() :].strip()
    marks = _longest(text, a)
    units = [x for x in marks if x[2] == "unit"]
    if not units:
        return None
    unit = units[0]
    for x in marks:
        if x[2] == "times" and x[0] < unit[0]:
            times *= x[3]
    before = text[: unit[0]]
    for x in marks:
        if x[2] == "times" and x[1] <= unit[0]:
            before = before.replace(text[x[0] : x[1]], " ", 1)
    if re.search(r"\w", before.replace("of", "")) and not re.fullmatch(r"[\s.x×*of-]*", before):
        return None
    rest = text[unit[1] :].strip()
    second = units[1] if len(units) > 1 else None
    if second:
        between = text[unit[1] : second[0]].strip()
        after = text[second[1] :].strip(" .)]")
        if between in ("/", "per", "par", "pour") and not after:
            if unit[3] not in MASS or second[3] not in MASS:
                return None
            return times, str(unit[3]), MASS[second[3]]
        if second[3] == unit[3]:  # "milligrams (mg)"
            rest = text[second[1] :].strip()
        else:
            return None
    rest = rest.strip(" .,;:()[]")
    for q in QUALIFIERS:
        if rest == q or rest.startswith(q + " "):
            rest = rest[len(q) :].strip()
    if rest and not _PER.fullmatch(rest):
        return None
    return times, str(unit[3]), divisor


def read_number(text: str) -> Fraction | None:
    """The one number a text is: a comma before three digits separates thousands, another marks decimals."""
    m = _NUMBER.fullmatch(text)
    if not m:
        return None
    digits, power = m[1], m[2] or ""
    digits = _COMMA3.sub("", digits).replace(",", ".")
    try:
        return Fraction(digits + power)
    except ValueError:
        return None


def read_amount(amount: str | None, unit: str | None, unit_2: str | None, a: ahocorasick.Automaton) -> tuple[Fraction, str, int] | None:
    """``number in that unit, unit, divisor`` that an amount and its unit columns state, or None.

    A common fraction ("1/2", "1 1/2") is one number.  None when there is not
    exactly one number (ranges, bounds, words)
    or no known unit; ``divisor`` is not 0 for mass per mass (it is the second
    unit's factor).
    """
    text = fold(amount)
    text = _THOUSANDS_SPACE.sub(lambda m: m[1] + re.sub(r"\D", "", m[2]), text)
    for glyph, plain in _GLYPHS.items():
        text = text.replace(glyph, f" {plain}").strip()
    if m := _FRACTION.match(text):
        number = int(m[1] or 0) + Fraction(int(m[2]), int(m[3]))
    elif m := _NUMBER.match(text):
        number = read_number(m[0])
    else:
        return None
    rest = text[m.end() :].strip()
    if number is None:
        return None
    if not rest:
        for column in (unit, unit_2):
            said = fold(column)
            if said and said not in ("see amount", "voir quantité", "n/a", "-"):
                got = read_unit(said, a)
                if got is None:
                    return None
                return number * got[0], got[1], got[2]
        return None
    got = read_unit(rest, a)
    if got is None:
        times = [x for x in _longest(rest, a) if x[2] == "times"]
        power = _POWER.fullmatch(rest)
        if power or len(times) == 1 and times[0][:2] == (0, len(rest)):
            by = 10 ** int(power[1]) if power else times[0][3]
            for column in (unit, unit_2):
                if fold(column):
                    got = read_unit(fold(column), a)
                    return got and (number * by * got[0], got[1], got[2])
        return None
    return number * got[0], got[1], got[2]


KINDS = {
    "potency": ("potency_amount", "potency_unit_of_measure", "potency_unit_of_measure_f"),
    "quantity": ("quantity", "quantity_unit_of_measure", "quantity_unit_of_measure_f"),
    "dhe": ("dried_herb_equivalent", "dhe_unit_of_measure", "dhe_unit_of_measure_f"),
}


#: Amounts from here on are beyond BIGINT.
BEYOND = 2**63


def in_common_unit(number: Fraction, unit: str, divisor: int, factors: dict[str, tuple[str, int]]) -> tuple[str, int] | None:
    """``common unit, amount`` rounded half up; mass per mass (``divisor`` is not 0) in parts per million; None beyond BIGINT."""
    common, factor = factors[unit]
    exact = number * factor if not divisor else number * factor * 1_000_000 / divisor
    amount = (2 * exact.numerator + exact.denominator) // (2 * exact.denominator)
    return ("ppm" if divisor else common, amount) if amount < BEYOND else None


def common_units(df: DataFrame, row: str, kinds: dict[str, tuple[str, str, str]] = KINDS) -> DataFrame:
    """``<row>, quantity_kind, common_unit, amount``: every amount that states one number with a known unit.

    ``kinds`` maps a kind to its amount column and two unit columns. The rows
    are read where they lie, without a shuffle; equal texts of a task are read
    once. Amounts are rounded half up to whole common units.

    Edge cases: null or blank amounts, units that are unknown, and values
    beyond BIGINT give no row; repeated rows give a row each; an empty table
    gives none; extra columns are ignored.
    """
    columns = [c for three in kinds.values() for c in three]
    names = list(kinds)
    key_type = dict(df.dtypes)[row]
    sent = df.sparkSession.sparkContext.broadcast({unit: (common, factor) for unit, common, factor in FACTORS})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, factors = automaton(), sent.value
        seen: dict = {}
        for batch in batches:
            rows, kind, unit, amount = [], [], [], []
            ids = batch["__row"].tolist()
            for k, name in enumerate(names):
                parts = [batch[f"__c{3 * k + x}"] for x in range(3)]
                there = parts[0].notna()
                for i, x, y, z in zip([r for r, t in zip(ids, there) if t], *(p[there].tolist() for p in parts)):
                    try:
                        got = seen[x, y, z]
                    except KeyError:
                        if len(seen) > 200_000:
                            seen.clear()
                        stated = read_amount(x, y, z, a)
                        got = seen[x, y, z] = None if stated is None else in_common_unit(*stated, factors)
                    if got is not None:
                        rows.append(i)
                        kind.append(name)
                        unit.append(got[0])
                        amount.append(got[1])
            yield runtime.frame({"__row": rows, "quantity_kind": kind, "common_unit": unit, "amount": amount})

    picked = df.select(F.col(row).alias("__row"), *[F.col(c).cast("string").alias(f"__c{i}") for i, c in enumerate(columns)])
    return picked.mapInPandas(run, f"__row {key_type}, quantity_kind string, common_unit string, amount bigint").withColumnRenamed("__row", row)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common_units(runtime.table(spark, sf_dir, "nhp_medicinal_ingredients"), "row_id")
