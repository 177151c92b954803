"""Cleaning and normalising of names as Column -> Column functions (JVM side, no Python UDF)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# English stop words that label names are stripped of.
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before being below between both but by "
    "can did do does doing don down during each few for from further had has have having he her here hers him his how i if "
    "in into is it its just me more most my no nor not now of off on once only or other our out over own same she should so "
    "some such than that the their them then there these they this those through to too under until up very was we were what "
    "when where which while who whom why will with you your"
).split()
# Units of doses in label names, the gap that ends a label name, and what is cut from it, in this order
# (lists stand for their names; a replacement names groups by their numbers).
LABEL_UNITS = ["g", "mg", "mcg", "iu", "i.u.", "%"]
LABEL_GAP = r"[ \t]{2,}"
LABEL_CUTS = [
    (r"(?i)\b[0-9,.]+ ?(<<units>>)(?:\s|$)", ""),
    (r"\b[0-9]+:[0-9]+\b", ""),
    (r"(?i)\((r|tm|c)\)", ""),
    (r"(\s|^)'(.*?)'(\s|$)", "$1$2$3"),
    (r"[\{\}]", ""),
    (r"(?i)\b(<<words>>)\b", ""),
    (r"(?i)[\(\[\{](<<bracketed>>)[\)\]\}]", ""),
    (r":", ""),
    (r"\([0-9]+\)", ""),
    (r"[\(\[][\s,\.]*[\)\]]", ""),
]
# A parenthesis in an interaction text.
INTERACTION_PARENTHESIS = r" ?\([^)]+\)"
# Texts that stand for no content.
PLACEHOLDERS = ["", "general", "none reports.", "none known.", "case reports", "none reported."]


def squeeze(c: Column) -> Column:
    """Any run of white space becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip(c: Column) -> Column:
    """White space of any sort removed at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def invalid_name(c: Column) -> Column:
    """Null, blank, under two characters, number-like (two digits or more), or ASCII punctuation alone."""
    t = strip(F.coalesce(c, F.lit("")))
    # what is left of a number behind its leading marks: one run of digits, or two with marks between
    digits = F.ltrim(t, F.lit(".,"))
    number = digits.rlike(r"^\d\d+$") | digits.rlike(r"^\d+[.,]+\d+$")
    return (F.length(t) < 2) | number | t.rlike(r"^\p{Punct}+$")


def valid_content(c: Column) -> Column:
    """Not null and none of the placeholders."""
    return F.coalesce(~F.lower(strip(c)).isin(PLACEHOLDERS), F.lit(False))


def normalise_query(c: Column, ascii_only: bool = True) -> Column:
    """A linker's query: other than ASCII to spaces (optionally), parentheses with their content out, one space between words."""
    if ascii_only:
        c = F.regexp_replace(c, r"[^\x00-\x7F]+", " ")
    return squeeze(F.regexp_replace(c, r"\([^)]*\)", ""))


def label_cuts(filter_words: Sequence[str] = ()) -> list[tuple[str, str]]:
    """``pattern, replacement`` of the cuts of label names, in their order; the words of a list stand for its name in angle marks."""
    lists = {
        "units": [re.escape(u) for u in LABEL_UNITS],
        "words": STOP_WORDS,
        "bracketed": [*STOP_WORDS, *[re.escape(w.strip().lower()) for w in filter_words if w.strip()]],
    }
    return [(re.sub(r"<<(\w+)>>", lambda m: "|".join(lists[m[1]]), pattern), by) for pattern, by in LABEL_CUTS]


def clean_label_name(c: Column, filter_words: Sequence[str] = ()) -> Column:
    """A label name up to its first wide gap and after every cut; white space is squeezed after each."""
    c = squeeze(F.split(c, LABEL_GAP)[0])
    for pattern, by in label_cuts(filter_words):
        c = squeeze(F.regexp_replace(c, pattern, by))
    return c


def expand_parentheses(c: Column) -> Column:
    """The name without its parentheses, and each parenthesis' content, as an array.

    Extraction takes the shortest parentheses, removal reaches from the first
    to the last; text between two of them is lost, as in the source pipeline.
    """
    inner = F.regexp_extract_all(c, F.lit(r"(\(.*?\))"), 1)
    inner = F.transform(inner, lambda x: F.regexp_replace(x, r"[()]", ""))
    return F.concat(F.array(squeeze(F.regexp_replace(c, r"\(.*\)", ""))), inner)


def split_names(c: Column) -> Column:
    """Names separated by ', ' or '; ' as an array."""
    return F.split(c, ", |; ")


def split_slashes(c: Column) -> Column:
    """A text's parts between '/' as an array; a text with digits stays whole."""
    return F.when(c.rlike(r"[0-9]"), F.array(c)).otherwise(F.split(c, "/"))


def split_content(c: Column) -> Column:
    """Lines of a section; a line without digits is split at '/' too; empty lines go, repeats too."""
    lines = F.filter(F.split(c, "\n"), lambda x: x != "")
    return F.array_distinct(F.flatten(F.transform(lines, split_slashes)))


def clean_interaction(c: Column) -> Column:
    """The text before a colon, without parentheses and without other than ASCII characters."""
    c = F.split(c, ":", 2)[0]
    return strip(F.regexp_replace(F.regexp_replace(c, INTERACTION_PARENTHESIS, ""), r"[^\x00-\x7F]+", ""))


def source_id(c: Column) -> Column:
    """An id without '.0' anywhere in it."""
    return F.replace(c, F.lit(".0"), F.lit(""))


def ui(prefix: Column | str, number: Column) -> Column:
    """Prefix and number with seven digits at least."""
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.format_string("%s%07d", p, number)
