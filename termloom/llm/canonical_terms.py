"""Problem 4: mapping free-entered values to a canonical list.

Method: prefix-filter set-similarity join. Tokens (letter pairs of the joined
words, so lost or added spaces cost little) are ordered by their rarity in the
list, those absent from it first; only prefixes are joined; length and
positional filters prune; Jaccard is verified exactly; the best entry is kept.

Each distinct normalised value is looked up once. A list of bounded size (its
count is checked) is indexed once and sent to the tasks, which probe it prefix
by prefix; a longer list is joined by shuffle with the same filters.

What typists write around a term ("possible ...", "... x2 days") is learned from
the values: words foreign to the list that often leave an entry, letter for
letter, when they are taken off an end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import runtime

#: Least Jaccard similarity of a candidate.
THRESHOLD = 0.33
#: A candidate is a match at this Jaccard similarity, or at this sum of Jaccard and edit similarity.
SURE, SURE_SUM = 0.43, 1.06
#: Words of a remark at an end of a value, at most, and the share of its distinct values that it must leave as an entry.
REMARK_WORDS, REMARK_SHARE = 3, 0.1
#: A list of up to this many entries is broadcast; a longer one is joined by shuffle.
BROADCAST_ENTRIES = 50_000
CANDIDATE = "form string, entry_id bigint, jaccard double"


def normalise(c: Column) -> Column:
    """The words of a text (letters, marks and digits) in lower case, one space between them."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}\p{N}]+", " "))


def _ends(said: DataFrame) -> DataFrame:
    """``said, back, size, remark, rest``: the values with up to REMARK_WORDS words taken off the front or the back; figures are alike."""
    words = F.split("said", " ")
    cuts = F.array(*[F.struct(F.lit(b).alias("back"), F.lit(k).alias("size")) for b in (False, True) for k in range(1, REMARK_WORDS + 1)])
    each = said.select("said", words.alias("w"), F.explode(cuts).alias("c")).select("said", "w", "c.*").where(F.size("w") > F.col("size"))
    left = F.size("w") - F.col("size")
    off = F.when(F.col("back"), F.slice("w", left + 1, F.col("size"))).otherwise(F.slice("w", F.lit(1), F.col("size")))
    rest = F.when(F.col("back"), F.slice("w", F.lit(1), left)).otherwise(F.slice("w", F.col("size") + 1, left))
    return each.select("said", "back", "size", F.regexp_replace(F.array_join(off, " "), r"\p{N}+", "0").alias("remark"), F.array_join(rest, " ").alias("rest"))


def remarks(said: DataFrame, listed: DataFrame) -> DataFrame:
    """``back, remark``: what typists write before or behind a term.

    A remark holds no word of the list (``said``: normalised entries) and, taken
    off the values (``said``: distinct, normalised), leaves an entry in at least
    REMARK_SHARE of them.
    """
    known = listed.select(F.explode(F.split("said", " ")).alias("word")).distinct()
    ends = _ends(said).join(listed.select(F.col("said").alias("rest"), F.lit(1).alias("hit")).distinct(), "rest", "left")
    often = ends.groupBy("back", "remark").agg(F.count("hit").alias("hits"), F.count(F.lit(1)).alias("n"))
    often = runtime.durable(often.where((F.col("hits") > 0) & (F.col("hits") >= F.col("n") * REMARK_SHARE)).select("back", "remark"))
    of_list = often.select("back", "remark", F.explode(F.split("remark", " ")).alias("word")).join(known, "word", "left_semi")
    return often.join(of_list.select("back", "remark").distinct(), ["back", "remark"], "left_anti")


def without_remarks(said: DataFrame, listed: DataFrame) -> DataFrame:
    """``said, core``: distinct normalised values and what is left of them without the remarks at both ends."""
    known = runtime.durable(remarks(said, listed))
    done = runtime.durable(said.select("said", F.col("said").alias("core")))
    if known.isEmpty():
        return done
    while True:  # a value loses words in every round, so rounds are as many as its remarks
        hit = _ends(done.select(F.col("core").alias("said")).distinct()).join(known, ["back", "remark"])
        cut = hit.groupBy("said").agg(F.max(F.when(~F.col("back"), F.col("size"))).alias("front"), F.max(F.when(F.col("back"), F.col("size"))).alias("behind"))
        words = F.split("said", " ")
        front, behind = F.coalesce("front", F.lit(0)), F.coalesce("behind", F.lit(0))
        # an end at a time where both together would take it all
        behind = F.when(front + behind < F.size(words), behind).otherwise(F.lit(0))
        cut = runtime.durable(cut.select(F.col("said").alias("core"), F.array_join(F.slice(words, front + 1, F.size(words) - front - behind), " ").alias("next")))
        if cut.isEmpty():
            return done
        done = runtime.durable(done.join(cut, "core", "left").select("said", F.coalesce("next", "core").alias("core")))


def pairs_of_letters(c: Column) -> Column:
    """The set of letter pairs of a text; a single letter is its own token."""
    letters = F.split(c, "")
    n = F.length(c)
    pairs = F.zip_with(F.slice(letters, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(letters, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda x, y: F.concat(x, y))
    return F.when(n > 1, F.array_distinct(pairs)).when(n == 1, F.array(c)).otherwise(F.array().cast("array<string>"))


def _ordered(df: DataFrame, ranks: DataFrame, key: str) -> DataFrame:
    """``key, size, token, place``: tokens of ``grams`` in the global order (rare first), counted from 1."""
    exploded = df.select(key, F.explode("grams").alias("token")).join(ranks, "token", "left")
    by = F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token")))
    sets = exploded.groupBy(key).agg(by.alias("tokens"))
    return sets.select(key, F.transform("tokens", lambda x: x["token"]).alias("tokens"))


def _prefix(sets: DataFrame, key: str, threshold: float) -> DataFrame:
    size = F.size("tokens")
    keep = size - F.ceil(size * threshold).cast("int") + 1
    return sets.select(key, size.alias("size"), F.posexplode(F.slice("tokens", F.lit(1), F.greatest(keep, F.lit(1)))).alias("place", "token"))


class Index:
    """Inverted index over the prefixes of a list's token sets, for a list of bounded size."""

    def __init__(self, ids: list[int], sets: list[list[str]], threshold: float) -> None:
        df: dict[str, int] = {}
        for tokens in sets:
            for t in tokens:
                df[t] = df.get(t, 0) + 1
        self.rank = {t: i for i, t in enumerate(sorted(df, key=lambda t: (df[t], t)))}
        self.threshold, self.ids = threshold, np.asarray(ids, dtype=np.int64)
        self.size = np.asarray([len(x) for x in sets], dtype=np.int32)
        self.padded = np.full((len(sets), int(self.size.max(initial=1))), len(self.rank), dtype=np.int32)
        lists: dict[int, list[tuple[int, int]]] = {}
        for k, tokens in enumerate(sets):
            order = sorted(self.rank[t] for t in tokens)
            self.padded[k, : len(order)] = order
            for place, t in enumerate(order[: self.prefix(len(order))]):
                lists.setdefault(t, []).append((k, place))
        self.lists = {t: np.asarray(v, dtype=np.int32).T for t, v in lists.items()}
        self.present = np.zeros(len(self.rank) + 1, dtype=bool)

    def prefix(self, size: int) -> int:
        return size - int(np.ceil(size * self.threshold - 1e-9)) + 1

    def find(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Entries whose Jaccard similarity with ``tokens`` reaches the threshold, and the similarities."""
        n, t = len(tokens), self.threshold
        known = sorted(self.rank[x] for x in tokens if x in self.rank)
        absent = n - len(known)  # absent tokens are the rarest and come first
        hits = []
        for place in range(absent, min(self.prefix(n), n)):
            if (got := self.lists.get(known[place - absent])) is not None:
                k, at = got
                size = self.size[k]
                fits = (size >= n * t - 1e-9) & (size * t <= n + 1e-9)
                most = 1 + np.minimum(n - place - 1, size - at - 1)
                # an earlier shared token raises the overlap by at most the places passed on the shorter side
                most = most + np.minimum(place - absent, at)
                hits.append(k[fits & (most >= (n + size) * (t / (1 + t)) - 1e-9)])
        if not hits:
            return np.empty(0, dtype=np.int64), np.empty(0)
        k = np.unique(np.concatenate(hits))
        self.present[known] = True
        shared = self.present[self.padded[k]].sum(axis=1)
        self.present[known] = False
        jaccard = shared / (n + self.size[k] - shared)
        good = jaccard >= t
        return self.ids[k[good]], jaccard[good]


def _probe(forms: DataFrame, entries: list[tuple[int, list[str]]], threshold: float) -> DataFrame:
    """Candidates of every form from an index that each task builds from the bounded list."""
    shared = forms.sparkSession.sparkContext.broadcast(entries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index([i for i, _ in shared.value], [g for _, g in shared.value], threshold)
        for batch in batches:
            out_form, out_id, out_j = [], [], []
            for form in batch["form"]:
                grams = list(dict.fromkeys(form[i : i + 2] for i in range(max(1, len(form) - 1))))
                ids, j = index.find(grams)
                out_form.extend([form] * len(ids))
                out_id.append(ids)
                out_j.append(j)
            yield runtime.frame({"form": out_form, "entry_id": np.concatenate(out_id or [np.empty(0, dtype=np.int64)]), "jaccard": np.concatenate(out_j or [np.empty(0)])})

    return forms.select("form").mapInPandas(run, CANDIDATE)


def _join(forms: DataFrame, listed: DataFrame, threshold: float) -> DataFrame:
    """The same candidates by shuffle, for a list of any length."""
    ranks = runtime.durable(listed.select(F.explode("grams").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df")))
    forms = forms.withColumn("grams", pairs_of_letters(F.col("form")))
    left = _prefix(_ordered(forms, ranks, "form"), "form", threshold)
    right = _prefix(_ordered(listed, ranks, "entry_id"), "entry_id", threshold)
    right = right.select("entry_id", F.col("size").alias("entry_size"), F.col("place").alias("entry_place"), "token")
    met = left.join(right, "token")
    fits = (F.col("size") * threshold <= F.col("entry_size")) & (F.col("entry_size") * threshold <= F.col("size"))
    first = F.min(F.struct("place", "entry_place")).alias("at")
    candidates = met.where(fits).groupBy("form", "entry_id", "size", "entry_size").agg(first)
    # positional filter: the first shared token bounds the overlap by what is left on either side
    most = 1 + F.least(F.col("size") - F.col("at.place") - 1, F.col("entry_size") - F.col("at.entry_place") - 1)
    need = (F.col("size") + F.col("entry_size")) * (threshold / (1 + threshold))
    candidates = candidates.where(most >= need - 1e-9).select("form", "entry_id")
    full = candidates.join(listed, "entry_id").withColumn("mine", pairs_of_letters(F.col("form")))
    shared = F.size(F.array_intersect("grams", "mine"))
    verified = full.withColumn("jaccard", shared / (F.size("grams") + F.size("mine") - shared))
    return verified.where(F.col("jaccard") >= threshold).select("form", "entry_id", "jaccard")


def closest(values: DataFrame, value: str, entries: DataFrame, entry_id: str, entry: str, threshold: float = THRESHOLD, most: int = BROADCAST_ENTRIES) -> DataFrame:
    """``said, entry_id, jaccard, score``: for every distinct normalised value its best entry, if any is a match.

    Candidates reach ``threshold`` in Jaccard similarity; a match reaches SURE,
    or SURE_SUM with its edit similarity. Best means the greatest sum of Jaccard
    and edit similarity, ties to the smaller id. ``said`` is the normalised
    value (see ``normalise``); it is compared without the remarks around it. A
    list of more than ``most`` entries is joined by shuffle.

    Edge cases: null, blank and all-punctuation values match nothing; repeated
    values are looked up once; an empty side gives no rows; equal entries
    compete by id; extra columns are ignored.
    """
    joined = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    listed = entries.select(F.col(entry_id).cast("bigint").alias("entry_id"), normalise(F.col(entry)).alias("said")).where("entry_id is not null and said <> ''")
    listed = runtime.durable(listed.withColumn("entry_form", joined(F.col("said"))).withColumn("grams", pairs_of_letters(F.col("entry_form"))))
    said = runtime.durable(values.select(normalise(F.col(value)).alias("said")).where("said <> ''").distinct())
    cores = without_remarks(said, listed).select("said", joined(F.col("core")).alias("form"))
    forms = cores.select("form").distinct()
    if listed.count() <= most:
        # a number of its own: by bytes alone all forms would fall to one task
        forms = forms.repartition(max(8, int(values.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))))
        candidates = _probe(forms, [(r[0], r[1]) for r in listed.select("entry_id", "grams").collect()], threshold)
        named = candidates.join(F.broadcast(listed.select("entry_id", "entry_form")), "entry_id")
    else:
        named = _join(forms, listed, threshold).join(listed.select("entry_id", "entry_form"), "entry_id")
    longest = F.greatest(F.length("form"), F.length("entry_form"))
    scored = named.withColumn("score", F.col("jaccard") + 1 - F.levenshtein("form", "entry_form") / longest)
    scored = scored.where((F.col("jaccard") >= SURE) | (F.col("score") >= SURE_SUM))
    best = F.max(F.struct("score", (-F.col("entry_id")).alias("neg"), "jaccard")).alias("best")
    best = scored.groupBy("form").agg(best).select("form", (-F.col("best.neg")).alias("entry_id"), F.col("best.jaccard").alias("jaccard"), F.col("best.score").alias("score"))
    return cores.join(best, "form").drop("form")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = runtime.table(spark, sf_dir, "ingredients").where(F.col("concept_type").isin("DIS", "SS", "PD"))
    terms = rows.select("cidx", F.posexplode("synonyms").alias("syn_pos", "s")).select("cidx", "syn_pos", F.col("s.term").alias("term"))
    terms = terms.where(~runtime.blank(F.col("term")))
    best = runtime.durable(closest(terms, "term", runtime.table(spark, sf_dir, "reference_terms"), "ref_id", "ref_term"))
    terms = runtime.durable(terms.withColumn("said", normalise(F.col("term"))))
    found = runtime.lookup(terms, best.select("said", "entry_id"), "said", F.col("cidx"), runtime.hot_keys(terms, "said"))
    return found.select("cidx", "syn_pos", F.coalesce("entry_id", F.lit(-1)).cast("bigint").alias("ref_id"))
