"""Problem 6: matching entities across sources without keys.

Method: sorted neighbourhood over several composite sort keys. Every distinct
name has a key per rotation of its words, one from its end, and one without
vowels; a window slides over the distinct keys, and the names of the two sides
under equal or neighbouring keys are compared; what is near enough is scored by
weighted field similarities; an assignment maximising total confidence picks the
pairs. Records of equal names are compared once.

The sort is a range partitioning by key, and the head of each partition is
copied behind the one before it.
Each record of the second side takes at most one of the first side, which may
serve several; under that rule the assignment of greatest total confidence is
each record's best pair.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom import runtime

#: Distinct keys after a key in the sorted list whose names its own are compared with.
WINDOW = 12
#: Letters that a name without its vowels must have to be a key.
LEAST_BARE = 3
#: Rows of a sorted list that one task should hold.
TASK_ROWS = 20_000
#: Similarity from which a pair of names is a candidate, and from which it counts as the same name.
NEAR, SAME = 0.70, 0.76
#: Least similarity of any word of a name with its counterpart: a long word, and a short one, in which one slip weighs more.
LONG_WORD, SHORT_WORD = 0.70, 0.55
#: A word that at least this share of the records use is common (colours, genera, isomer prefixes), no name of its own.
COMMON = 0.01

# Words of label language that name no ingredient.
PARTS = "seed root leaf bark rhizome flower fruit peel stem whole herb cell aerial part parts".split()
FORMS = "extract powder concentrate standardised standardized std organic ext granular crude dry dried".split()
# Isomer marks and salt words.
ISOMERS = "d l dl n o r s alpha beta gamma delta cis trans oxo di tri iso".split()
SALTS = "complex monosalt hydrolate dihydrate monohydrate hydrate chelate hydrochloride citrate sulfate sulphate acetate".split()

# Endings of Latin epithets; another ending is another species. Greek letters as isomer marks.
ENDINGS = "folia florus flora antha anthus oides ensis iana ianus ella ellus ula ulus ica icus ata atus osa osus".split()
GREEK = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta"}

_BRACKETS = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}")
_DOSE = re.compile(r"\b\d+(?:[.,]\d+)?\s*(?:mg|mcg|g|iu|ml|%)(?!\w)|\b\d+:\d+\b|\b\d+(?:[.,]\d+)?\s*%")
_PART_OF = re.compile(rf"^(?:{'|'.join(PARTS)})(?: (?:{'|'.join(PARTS)}))* of\b")
_ABBREVIATED = re.compile(r"^([a-z])\.\s*([a-z]{4,})$")
_WORD = re.compile(r"[a-z0-9]+")
NAME = "term string, words array<string>, plain string, ordered string, marks string, ends array<string>"


def parse_name(term: str) -> tuple[list[str], str, str, str]:
    """``words, plain, ordered, marks`` of a name: its own words, joined as they stand and in order, and its qualifiers.

    Qualifiers (isomer, salt, strain number) tell entities apart that share a name.
    """
    text = unicodedata.normalize("NFKD", term).casefold()
    text = "".join(GREEK.get(c, c) for c in text if not unicodedata.combining(c)).replace("’", "'")
    text = " ".join(_DOSE.sub(" ", _BRACKETS.sub(" ", text)).split())
    text = _PART_OF.sub("", text).strip()
    if m := _ABBREVIATED.match(text):
        return [m[2]], m[1] + m[2], m[1] + m[2], ""
    words, marks = [], []
    for w in _WORD.findall(text):
        if w in PARTS or w in FORMS:
            continue
        if w in ISOMERS or w in SALTS or any(c.isdigit() for c in w) or len(w) == 2 and marks_strain(text, w):
            marks.append(w)
        else:
            words.append(w)
    return words, "".join(words), "".join(sorted(words)), " ".join(sorted(marks))


def ending(word: str) -> str:
    """The known ending of an epithet, or the empty text."""
    return next((e for e in ENDINGS if len(word) > len(e) + 2 and word.endswith(e)), "")


def marks_strain(text: str, w: str) -> bool:
    """Whether a two-letter word is the head of a strain code such as 'ab-123'."""
    return re.search(rf"\b{w}[ -]?\d", text) is not None


def _parsed(terms: DataFrame) -> DataFrame:
    """The distinct terms, each parsed once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch["term"]:
                words, plain, ordered, marks = parse_name(t)
                ends = [ending(w) for w in sorted(words)] if len(words) == 2 or plain != "".join(words) else []
                rows.append((t, words, plain, ordered, marks, ends))
            yield pd.DataFrame(rows, columns=["term", "words", "plain", "ordered", "marks", "ends"])

    return terms.select("term").distinct().mapInPandas(run, NAME).where("plain <> ''")


def likeness(a: Column, b: Column) -> Column:
    """Edit similarity of two names (structs with ``plain`` and ``ordered``), whatever their word order."""

    def edit(x: Column, y: Column) -> Column:
        longest = F.greatest(F.length(x), F.length(y))
        return 1 - F.levenshtein(x, y) / longest

    def words_fit(x: Column, y: Column) -> Column:
        def fits(z: Column) -> Column:
            longest = F.greatest(F.length(z["x"]), F.length(z["y"]))
            return 1 - F.levenshtein(z["x"], z["y"]) / longest >= F.when(longest >= 8, LONG_WORD).otherwise(SHORT_WORD)

        return F.forall(F.arrays_zip(x.alias("x"), y.alias("y")), fits)

    # as many words on both sides: each must have its counterpart, so that a shared one does not carry the rest
    several = (F.size(a["words"]) == F.size(b["words"])) & (F.size(a["words"]) > 1)
    paired = words_fit(a["words"], b["words"]) | words_fit(F.reverse(a["words"]), b["words"]) | words_fit(F.array_sort(a["words"]), F.array_sort(b["words"]))
    other_ending = F.exists(F.arrays_zip(a["ends"].alias("x"), b["ends"].alias("y")), lambda z: (z["x"] != "") & (z["y"] != "") & (z["x"] != z["y"]))
    same = F.greatest(edit(a["plain"], b["plain"]), edit(a["ordered"], b["ordered"]))
    return F.when((F.size(a["ends"]) == F.size(b["ends"])) & other_ending, 0.0).when(several & ~paired, 0.0).otherwise(same)


def neighbours(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """``a, b``: structs of rows within ``window`` places of each other in the order of ``key, id, side``, from different sides."""
    total = rows.count()
    parts = max(1, -(-total // TASK_ROWS))
    placed = rows.repartitionByRange(parts, "key", "id") if parts > 1 else rows.coalesce(1)
    placed = runtime.durable(placed.withColumn("part", F.spark_partition_id()).withColumn("copy", F.lit(False)))
    order = Window.partitionBy("part").orderBy("copy", "key", "id", "side")
    head = placed.withColumn("n", F.row_number().over(order)).where((F.col("n") <= window) & (F.col("part") > 0)).drop("n")
    both = placed.unionByName(head.withColumn("part", F.col("part") - 1).withColumn("copy", F.lit(True)))
    me = F.struct(*[c for c in rows.columns if c != "key"])
    after = F.collect_list(me).over(order.rowsBetween(1, window))
    near = both.withColumn("after", after).where("not copy")
    near = near.select(me.alias("a"), F.explode(F.filter("after", lambda x: x["side"] != F.col("side"))).alias("b"))
    first = F.col("a.side") == 0
    return near.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("b"))


def sort_keys() -> Column:
    """The sort keys of a name: its words from each word on, in order, from its end, and (if enough is left) without vowels."""
    rotation = F.transform(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_join(F.concat(F.slice("words", i + 1, F.size("words")), F.slice("words", F.lit(1), i)), ""))
    bare = F.regexp_replace("plain", "[aeiouy]", "")
    # a mark before the derived keys keeps each kind in its own stretch of the list
    more = F.array(F.col("plain"), F.col("ordered"), F.concat(F.lit("<"), F.reverse("plain")), F.when(F.length(bare) >= LEAST_BARE, F.concat(F.lit("~"), bare)))
    return F.array_distinct(F.array_compact(F.concat(rotation, more)))


def near_names(names: DataFrame, window: int = WINDOW) -> DataFrame:
    """``name_1, name_2``: distinct names of side 0 and side 1 of likeness NEAR or more that meet under a key.

    ``names`` has ``side, name, plain, ordered, words, ends``, one row per side
    and name. Every key stands once per side in the sorted list, so equal keys
    are next to each other however many names share them.
    """
    keys = runtime.durable(names.select("side", "name", F.explode(sort_keys()).alias("key")))
    met = neighbours(keys.select("key", F.col("key").alias("id"), "side").distinct(), 2 * window).select(F.col("a.id").alias("key_1"), F.col("b.id").alias("key_2")).distinct()
    one, two = (keys.where(F.col("side") == k).select(F.col("key").alias(f"key_{k + 1}"), F.col("name").alias(f"name_{k + 1}")) for k in (0, 1))
    pairs = met.join(one, "key_1").join(two, "key_2").select("name_1", "name_2").distinct()
    own = F.struct("plain", "ordered", "words", "ends")
    one, two = (names.where(F.col("side") == k).select(F.col("name").alias(f"name_{k + 1}"), own.alias("ab"[k])) for k in (0, 1))
    # the longer of two names of that likeness is longer by little
    sizes = F.length("a.plain"), F.length("b.plain")
    near = F.greatest(*sizes) - F.least(*sizes) <= (1 - NEAR) * F.greatest(*sizes) + 1e-9
    return pairs.join(one, "name_1").join(two, "name_2").where(near).where(likeness(F.col("a"), F.col("b")) >= NEAR).select("name_1", "name_2")


def match(names: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id_1, id_2, confidence``: pairs of records of side 0 and side 1 that are the same entity.

    ``names`` has ``id, side (0 or 1), term, proper`` with one row per name of
    a record; ``proper`` marks the names that define a record of side 0.
    Confidence is 0.6 x the proper-name similarity + 0.25 x the best other
    name's + 0.15 x the share of the record's names that are explained.

    A pair holds if a proper name of equal qualifiers is met; or if another
    name is met and no name of the record contradicts: none meets a proper
    name with other qualifiers, none is an unexplained name without common
    words, none shares a rare word with an unmet proper name.

    Edge cases: null and blank terms, and terms of nothing but label words, are
    ignored; a record without names matches nothing; repeated rows change
    nothing; ties go to the smaller id; an empty side gives no rows; extra
    columns are ignored.
    """
    names = names.select("id", F.col("side").cast("int").alias("side"), "term", F.coalesce("proper", F.lit(False)).alias("proper")).where(~runtime.blank(F.col("term")) & F.col("id").isNotNull())
    names = runtime.durable(names.groupBy("id", "side", "term").agg(F.max("proper").alias("proper")))
    parsed = runtime.durable(_parsed(names))
    hot = runtime.hot_keys(names, "term")
    named = runtime.lookup(names, parsed, "term", F.xxhash64("id"), hot, "inner")
    short = named.where("side = 0 and proper and size(words) = 2 and marks = ''")
    short = short.select("id", "side", "term", "proper", F.array(F.col("words")[1]).alias("words"), F.concat(F.substring(F.col("words")[0], 1, 1), F.col("words")[1]).alias("plain"), F.array(F.when(F.array_sort("words")[0] == F.col("words")[1], F.col("ends")[0]).otherwise(F.col("ends")[1])).alias("ends"))
    named = named.unionByName(short.withColumn("ordered", F.col("plain")).withColumn("marks", F.lit("")))
    named = runtime.durable(named.dropDuplicates(["id", "side", "plain", "ordered", "marks", "proper"]).drop("term"))
    records = named.select("id").distinct().count()
    # at most 1 / COMMON words per name position are common: a bounded list
    common = [r[0] for r in named.select("id", F.explode("words").alias("w")).distinct().groupBy("w").count().where(F.col("count") >= max(3, records * COMMON)).select("w").collect()]

    # records of equal names have equal scores: of side 0 the least stands for them, of side 1 each gets its pair
    name = F.struct("plain", "ordered", "marks", "proper", "words", "ends")
    profile = runtime.durable(named.groupBy("id", "side").agg(F.array_sort(F.collect_list(name)).alias("names")))
    same = runtime.durable(profile.groupBy("side", "names").agg(F.min("id").alias("id")))
    held = same.select("id", "side", F.explode("names").alias("n")).select("id", "side", *[F.col(f"n.{c}").alias(c) for c in ("plain", "ordered", "words", "ends")])
    held = runtime.durable(held.withColumn("name", F.xxhash64("plain", "ordered", "words", "ends")).distinct())
    near = runtime.durable(near_names(held.drop("id").distinct(), window))
    one, two = (held.where(F.col("side") == k).select(F.col("name").alias(f"name_{k + 1}"), F.col("id").alias(f"id_{k + 1}")) for k in (0, 1))
    pairs = runtime.lookup(one, near, "name_1", F.xxhash64("id_1"), runtime.hot_keys(one, "name_1"), "inner").select("id_1", "name_2").distinct()
    pairs = runtime.lookup(two, pairs, "name_2", F.xxhash64("id_2"), runtime.hot_keys(two, "name_2"), "inner").select("id_1", "id_2").distinct()
    pairs = pairs.join(same.where("side = 0").select(F.col("id").alias("id_1"), F.col("names").alias("ours")), "id_1")
    pairs = pairs.join(same.where("side = 1").select(F.col("id").alias("id_2"), F.col("names").alias("theirs")), "id_2")
    is_common = lambda x: F.arrays_overlap(x["words"], F.array(*[F.lit(w) for w in common])) if common else F.lit(False)

    # every name of the one against every name of the other, once; what follows only looks at these cells
    def cell(t: Column, i: Column, o: Column) -> Column:
        return F.struct(
            i.alias("i"), likeness(t, o).alias("s"), o["proper"].alias("proper"), (t["marks"] == o["marks"]).alias("alike"), (t["marks"] != "").alias("marked"),
            ((F.size(t["words"]) >= 2) & ~is_common(t)).alias("own"), F.arrays_overlap(t["words"], o["words"]).alias("shares"),
        )

    cells = F.flatten(F.transform("theirs", lambda t, i: F.transform("ours", lambda o: cell(t, i, o))))
    scored = pairs.withColumn("cells", cells)
    best = lambda fit: F.coalesce(F.array_max(F.transform(F.filter("cells", fit), lambda c: c["s"])), F.lit(0.0))
    names_met = lambda fit: F.array_distinct(F.transform(F.filter("cells", lambda c: fit(c) & (c["s"] >= SAME)), lambda c: c["i"]))
    scored = scored.withColumn("proper", best(lambda c: c["proper"] & c["alike"])).withColumn("other", best(lambda c: ~c["proper"] & c["alike"]))
    scored = scored.withColumn("share", F.size(names_met(lambda c: c["alike"])) / F.size("theirs")).withColumn("met", names_met(lambda c: F.lit(True)))
    other_marks = F.exists("cells", lambda c: c["proper"] & ~c["alike"] & c["marked"] & (c["s"] >= SAME))
    stranger_or_sibling = F.exists("cells", lambda c: (c["own"] | c["proper"] & c["shares"]) & ~F.array_contains("met", c["i"]))
    scored = scored.withColumn("against", other_marks | stranger_or_sibling)
    holds = (F.col("proper") >= SAME) | ((F.col("other") >= SAME) & ~F.col("against"))
    scored = scored.where(holds).withColumn("confidence", 0.6 * F.col("proper") + 0.25 * F.col("other") + 0.15 * F.col("share"))
    rank = F.row_number().over(Window.partitionBy("id_2").orderBy(F.desc(F.col("proper") >= SAME), F.desc("confidence"), "id_1"))
    found = scored.withColumn("n", rank).where("n = 1").select("id_1", "confidence", F.col("theirs").alias("names"))
    # the sets of names are unique in found
    mine = profile.where("side = 1").select(F.col("id").alias("id_2"), F.xxhash64("names").alias("h"), "names")
    mine = runtime.lookup(mine, found.select(F.xxhash64("names").alias("h"), F.col("names").alias("held"), "id_1", "confidence"), "h", F.xxhash64("id_2"), runtime.hot_keys(mine, "h"), "inner")
    return mine.where("names = held").select("id_1", "id_2", "confidence")


def ingredient_names(rows: DataFrame) -> DataFrame:
    """Names of registry (side 0) and label (side 1) concepts: synonyms, and attributes that repeat a name as a salt."""
    side = F.when(F.col("ui").startswith("NHPID"), 0).when(F.col("ui").startswith("DSLD"), 1)
    rows = rows.withColumn("side", side).where("side is not null")
    terms = rows.select(F.col("ui").alias("id"), "side", F.posexplode("synonyms").alias("pos", "s"))
    proper = (F.col("s.term_type") == "SN") & (F.col("pos") == 0)
    terms = terms.select("id", "side", F.col("s.term").alias("term"), (proper & (F.col("side") == 0)).alias("proper"))
    salts = rows.select(F.col("ui").alias("id"), "side", F.explode("attributes").alias("a")).where("lower(a.atr_name) = 'source_material' and lower(a.atr_value) rlike ' salt$'")
    salts = salts.select("id", "side", F.regexp_replace("a.atr_value", "(?i) salt$", "").alias("term"), (F.col("side") == 0).alias("proper"))
    return terms.unionByName(salts)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = match(ingredient_names(runtime.table(spark, sf_dir, "ingredients")))
    return pairs.select(F.least("id_1", "id_2").alias("ui_1"), F.greatest("id_1", "id_2").alias("ui_2"))


def p6_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair with its confidence."""
    pairs = match(ingredient_names(runtime.table(spark, sf_dir, "ingredients")))
    return pairs.select(F.col("id_1").alias("nhpid"), F.col("id_2").alias("dsld"), F.round("confidence", 6).alias("confidence"))
