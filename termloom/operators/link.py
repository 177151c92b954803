"""Linking names to external terminologies."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom import runtime
from termloom.functions import text
from termloom.model import KB
from termloom.operators.resolve import first_wins

#: What every linker returns: one row per candidate of a matched part of a query.
CANDIDATES = ["id", "matched", "pos", "term", "src", "code", "score", "semtypes"]

# Classes of organ systems by key word; where two classes stand, each has its own matched part.
ORGAN_CLASSES = [
    ("cardiovascular", "cardio", "Cardiac disorders", "10007541"),
    ("cardiovascular", "vascular", "Vascular disorders", "10047065"),
    ("dental", "", "Dental and gingival conditions", "10044018"),
    ("dermatologic", "", "Skin and subcutaneous tissue disorders", "10040785"),
    ("endocrine", "", "Endocrine disorders", "10014698"),
    ("gastrointestinal", "", "Gastrointestinal disorders", "10017947"),
    ("genitourinary", "genito", "Reproductive system and breast disorders", "10038604"),
    ("genitourinary", "urinary", "Renal and urinary disorders", "10038359"),
    ("hematologic", "", "Blood and lymphatic system disorders", "10005329"),
    ("hepatic", "", "Hepatobiliary disorders", "10019805"),
    ("immunologic", "", "Immune system disorders", "10021428"),
    ("musculoskeletal", "", "Musculoskeletal and connective tissue disorders", "10028395"),
    ("neurologic/cns", "", "Nervous system disorders", "10029205"),
    ("ocular/otic", "", "Eye disorders", "10015919"),
    ("oncologic", "", "Neoplasms benign, malignant and unspecified (incl cysts and polyps)", "10029104"),
    ("psychiatric", "", "Psychiatric disorders", "10037175"),
    ("pulmonary/respiratory", "", "Respiratory, thoracic and mediastinal disorders", "10038738"),
    ("renal", "", "Renal and urinary disorders", "10038359"),
]
CAPTURED = (
    "AllDocuments array<struct<Document:struct<Utterances:array<struct<PMID:string,Phrases:array<struct<PhraseText:string,"
    "Mappings:array<struct<MappingCandidates:array<struct<CandidatePreferred:string,CandidateCUI:string,CandidateScore:string,SemTypes:array<string>>>>>>>>>>>>"
)


class Linker(Protocol):
    """A linker: ``link`` takes ``id, text`` and returns CANDIDATES; ``best`` keeps the top ones of each matched part."""

    def link(self, queries: DataFrame) -> DataFrame: ...

    def best(self, candidates: DataFrame, top: int = 1) -> DataFrame: ...


def top(candidates: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` candidates of every matched part, in ``order``, ties by arrival."""
    w = Window.partitionBy("id", "matched").orderBy(*order, "pos")
    return candidates.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


class RuleLinker:
    """Organ classes by exact key word."""

    def link(self, queries: DataFrame) -> DataFrame:
        rows = [(k, m or k, i, t, c) for i, (k, m, t, c) in enumerate(ORGAN_CLASSES)]
        table = queries.sparkSession.createDataFrame(rows, "key string, matched string, pos int, term string, code string")
        found = queries.select("id", F.lower(text.normalise_query(F.col("text"), ascii_only=False)).alias("key")).join(F.broadcast(table), "key")
        return found.select("id", "matched", "pos", "term", F.lit("MEDDRA").alias("src"), "code", F.lit(0.0).alias("score"), F.lit(None).cast("array<string>").alias("semtypes"))

    def best(self, candidates: DataFrame, top_n: int = 1) -> DataFrame:
        return top(candidates, top_n)


class CapturedLinker:
    """Captured output of a concept mapper (``json``): nested documents, phrases, mappings and scored candidates."""

    def __init__(self, outputs: DataFrame, min_score: int = 800, semtypes: Sequence[str] | None = None) -> None:
        self.outputs, self.min_score, self.semtypes = outputs, min_score, semtypes

    def link(self, queries: DataFrame) -> DataFrame:
        """The captured candidates of the queries; an utterance carries the id of its query."""
        d = self.outputs.select(F.from_json("json", CAPTURED).alias("o")).select(F.explode("o.AllDocuments.Document").alias("d"))
        p = d.select(F.explode("d.Utterances").alias("u")).select(F.col("u.PMID").alias("id"), F.posexplode("u.Phrases").alias("phrase", "p"))
        m = p.select("id", "phrase", F.col("p.PhraseText").alias("matched"), F.posexplode("p.Mappings").alias("mapping", "m"))
        c = m.select("id", "matched", "phrase", "mapping", F.posexplode("m.MappingCandidates").alias("at", "c"))
        c = c.withColumn("pos", F.struct("phrase", "mapping", "at")).join(queries.select(F.col("id").cast("string").alias("id")).distinct(), "id", "left_semi")
        if self.semtypes is not None:
            c = c.where(F.arrays_overlap("c.SemTypes", F.array(*[F.lit(s) for s in self.semtypes])))
        return c.select("id", "matched", "pos", F.col("c.CandidatePreferred").alias("term"), F.lit("UMLS").alias("src"), F.col("c.CandidateCUI").alias("code"), F.abs(F.col("c.CandidateScore").try_cast("int")).cast("double").alias("score"), F.col("c.SemTypes").alias("semtypes"))

    def best(self, candidates: DataFrame, top_n: int = 1) -> DataFrame:
        return top(candidates.where(F.col("score") >= self.min_score), top_n, F.desc("score"))


class DictionaryLinker:
    """Approximate dictionary matching: windows of words against entries, by letter-triple Jaccard similarity.

    ``entries`` has ``term, preferred, code, semtypes``. Windows and entries
    meet over their letter triples with a length filter; similarity is exact;
    overlapping windows are resolved by ``criterion`` ('score' or 'length'), best
    first: a window stands unless it overlaps one that stands.
    """

    def __init__(self, entries: DataFrame, threshold: float = 0.7, window: int = 5, criterion: str = "score", semtypes: Sequence[str] | None = None) -> None:
        self.entries, self.threshold, self.window, self.criterion, self.semtypes = entries, threshold, window, criterion, semtypes

    @staticmethod
    def _triples(c: Column) -> Column:
        padded = F.concat(F.lit("  "), c, F.lit("  "))
        letters, n = F.split(padded, ""), F.length(padded) - 2
        part = lambda k: F.slice(letters, F.lit(k), n)
        return F.array_distinct(F.zip_with(F.zip_with(part(1), part(2), lambda x, y: F.concat(x, y)), part(3), lambda x, y: F.concat(x, y)))

    @staticmethod
    def _standing(spans: DataFrame) -> DataFrame:
        """``id, start, n``: of the spans of every query (by ``x``, ``y``, then the first) those that overlap no better one that stands."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            now, taken = object(), set()
            for batch in batches:
                free = []
                for query, start, n in zip(batch["id"], batch["start"], batch["n"]):
                    if query != now:
                        now, taken = query, set()
                    words = range(start, start + n)
                    free.append(taken.isdisjoint(words))
                    if free[-1]:
                        taken.update(words)
                yield batch[free]

        # the spans of a query come one after the other; no more than its taken words are kept
        placed = spans.repartition("id").sortWithinPartitions("id", F.desc("x"), F.desc("y"), "start", "n").select("id", "start", "n")
        return placed.mapInPandas(run, placed.schema)

    def link(self, queries: DataFrame) -> DataFrame:
        q = queries.select("id", text.normalise_query(F.col("text")).alias("t")).where("t <> ''").select("id", F.split("t", " ").alias("w"))
        spans = q.select("id", "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("start"))
        spans = spans.select("id", "w", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(self.window), F.size("w") - F.col("start")))).alias("n"))
        spans = spans.select("id", "start", "n", F.array_join(F.slice("w", F.col("start") + 1, F.col("n")), " ").alias("matched"))
        grams = runtime.durable(spans.select(F.lower("matched").alias("g")).distinct().withColumn("x", self._triples(F.col("g"))))
        e = self.entries.withColumn("e", F.lower("term")).where("e <> ''")
        if self.semtypes is not None:
            e = e.where(F.arrays_overlap("semtypes", F.array(*[F.lit(s) for s in self.semtypes])))
        terms = runtime.durable(e.select("e").distinct().withColumn("y", self._triples(F.col("e"))))
        # rare triples first: those of no entry, then by the number of entries that have them
        often = runtime.durable(terms.select(F.explode("y").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("df")))

        def prefix(df: DataFrame, key: str, x: str, size: str) -> DataFrame:
            each = df.select(key, F.size(x).alias(size), F.explode(x).alias("k")).join(often, "k", "left")
            rank = F.row_number().over(Window.partitionBy(key).orderBy(F.coalesce("df", F.lit(0)), "k"))
            keep = F.greatest(F.col(size) - F.ceil(F.col(size) * self.threshold).cast("int") + 1, F.lit(1))
            return each.withColumn("at", rank).where(F.col("at") <= keep).where("df is not null").select(key, size, "k")

        left, right = prefix(grams, "g", "x", "n"), runtime.durable(prefix(terms, "e", "y", "m"))
        met = left.join(right, "k").where((F.col("n") * self.threshold <= F.col("m")) & (F.col("m") * self.threshold <= F.col("n"))).select("g", "e").distinct()
        both = met.join(grams, "g").join(terms, "e")
        shared = F.size(F.array_intersect("x", "y"))
        scored = both.select("g", "e", (shared / (F.size("x") + F.size("y") - shared)).alias("score")).where(F.col("score") >= self.threshold)
        hits = scored.join(e.select("e", "term", "preferred", "code", "semtypes"), "e")
        found = spans.withColumn("g", F.lower("matched")).join(hits, "g")
        size = F.length("matched").cast("double")
        value = F.struct(*([F.col("score").alias("x"), size.alias("y")] if self.criterion == "score" else [size.alias("x"), F.col("score").alias("y")]))
        best = found.where("id is not null").groupBy("id", "start", "n").agg(F.max(value).alias("v")).select("id", "start", "n", "v.x", "v.y")
        stands = self._standing(best)
        kept = found.join(stands, ["id", "start", "n"])
        kept = kept.withColumn("name", F.coalesce(F.nullif("preferred", F.lit("")), "term"))
        exact = F.when(F.lower("name") == F.lower("matched"), 1.0).otherwise(F.col("score"))
        one = first_wins(kept.withColumn("score", exact), ["id", "matched", "code"], [F.desc("score"), "start", "name"])
        return one.select("id", "matched", F.struct("start", "code").alias("pos"), F.col("name").alias("term"), F.lit("UMLS").alias("src"), "code", "score", "semtypes")

    def best(self, candidates: DataFrame, top_n: int = 1) -> DataFrame:
        return top(candidates, top_n, F.desc("score"))


class AnnotatorLinker:
    """Captured answers of an annotation service (``id, matched, pos, term, src, code``): order is kept, first ones win."""

    def __init__(self, answers: DataFrame) -> None:
        self.answers = answers

    def link(self, queries: DataFrame) -> DataFrame:
        mine = self.answers.join(queries.select(F.col("id").cast("string").alias("id")).distinct(), "id", "left_semi")
        return mine.select("id", "matched", "pos", "term", "src", "code", F.lit(0.0).alias("score"), F.lit(None).cast("array<string>").alias("semtypes"))

    def best(self, candidates: DataFrame, top_n: int = 1) -> DataFrame:
        return top(candidates, top_n)


REGISTRY: dict[str, type] = {"rules": RuleLinker, "captured": CapturedLinker, "dictionary": DictionaryLinker, "annotator": AnnotatorLinker}


def linkables(kb: KB, preferred: DataFrame, labels: DataFrame) -> DataFrame:
    """``id, cidx, text, terminology``: concepts whose type links to a terminology, with their preferred term; one per ``ui``."""
    to = F.broadcast(labels.where("links_to is not null").select(F.upper("label").alias("k"), F.col("links_to").alias("terminology")))
    d = kb.concepts.withColumn("k", F.upper("concept_type")).join(to, "k").join(preferred.select("cidx", F.col("term").alias("text")), "cidx")
    return first_wins(d.select(F.col("ui").alias("id"), "cidx", "text", "terminology"), ["id"], ["cidx"])


def route(queries: DataFrame, linkers: dict[str, Linker], top_n: int = 1) -> DataFrame:
    """CANDIDATES of every query (``id, text, terminology``) from the linker of its terminology; unknown terminologies are skipped."""
    out = None
    for key, linker in linkers.items():
        found = linker.best(linker.link(queries.where(F.col("terminology") == key).select("id", "text")), top_n)
        found = found.withColumn("pos", F.to_json(F.struct("pos"))).withColumn("terminology", F.lit(key))
        out = found if out is None else out.unionByName(found)
    return out


def rewrite(kb: KB, linkable: DataFrame, best: DataFrame, keep_unlinked_edges: bool = False) -> KB:
    """The knowledge base after linking.

    A linkable concept is replaced by one clone per matched part, which gets
    the candidates as preferred atoms and their semantic types as attributes;
    one without candidates goes. Relationships follow their objects to every
    clone; those to concepts that got no clone are dropped, as in the source
    pipeline, unless ``keep_unlinked_edges``.
    """
    ids = linkable.select("id", F.col("cidx").alias("old"))
    clones = best.select("id", "matched").distinct().join(ids, "id")
    high = kb.concepts.agg(F.max("cidx").alias("c"), F.max("num").alias("n")).first()
    base, number = (high["c"] or 0) + 1, high["n"] or 0
    rank = runtime.durable(clones.withColumn("k", F.row_number().over(Window.partitionBy("old").orderBy("matched"))))
    sizes = rank.groupBy("old").agg(F.max("k").alias("m"))
    starts = _running(sizes, "old", "m")
    rank = runtime.durable(rank.join(starts, "old").withColumn("off", F.col("start") + F.col("k") - 1).withColumn("cidx", F.lit(base) + F.col("off")))
    new = rank.select("old", "id", "matched", "cidx", "off")
    fresh = kb.concepts.withColumnRenamed("cidx", "old").join(new, "old")
    fresh = fresh.select("cidx", text.ui(F.col("prefix"), F.lit(number + 1) + F.col("off")).alias("ui"), "prefix", (F.lit(number + 1) + F.col("off")).alias("num"), "concept_type")
    stay = kb.concepts.join(ids.select(F.col("old").alias("cidx")), "cidx", "left_anti")
    concepts = runtime.durable(stay.unionByName(fresh))

    def spread(df: DataFrame) -> DataFrame:
        kept = df.join(ids.select(F.col("old").alias("cidx")), "cidx", "left_anti")
        moved = df.withColumnRenamed("cidx", "old").join(new.select("old", "cidx"), "old").drop("old")
        return kept.unionByName(moved.select(*kept.columns))

    c = best.join(new.select("id", "matched", "cidx"), ["id", "matched"])
    at = (F.lit(1_000_000) + F.row_number().over(Window.partitionBy("cidx").orderBy(F.desc("score"), "code"))).cast("int")
    attrs = F.create_map(F.lit("linked_string"), F.col("matched"))
    atoms = c.select("cidx", at.alias("pos"), "term", F.lower("term").alias("term_lc"), "src", F.col("code").alias("src_id"), F.lit("SY").alias("term_type"), F.lit(True).alias("is_preferred"), F.col("score").alias("linking_score"), attrs.alias("attrs"))
    types = c.select("cidx", F.explode("semtypes").alias("atr_value"), "src").distinct()
    types = types.select("cidx", (F.lit(1_000_000) + F.row_number().over(Window.partitionBy("cidx").orderBy("atr_value"))).cast("int").alias("pos"), F.lit("umls_semantic_type").alias("atr_name"), "atr_value", "src")
    rels = runtime.durable(spread(kb.relationships))
    target = new.join(kb.concepts.select(F.col("cidx").alias("old"), F.col("ui").alias("object_ui")), "old").join(fresh.select("cidx", F.col("ui").alias("new_ui")), "cidx").select("object_ui", "new_ui")
    followed = rels.join(target, "object_ui", "left" if keep_unlinked_edges else "inner").withColumn("object_ui", F.coalesce("new_ui", "object_ui"))
    followed = followed.withColumn("nridx", (F.row_number().over(Window.partitionBy("cidx").orderBy("ridx", "object_ui")) - 1).cast("int"))
    own = spread(kb.rel_attributes).join(followed.select("cidx", "ridx", "nridx"), ["cidx", "ridx"])
    return KB(
        concepts=concepts,
        atoms=spread(kb.atoms).unionByName(atoms),
        attributes=spread(kb.attributes).unionByName(types),
        rel_attributes=own.select("cidx", F.col("nridx").alias("ridx"), "pos", "atr_name", "atr_value", "src"),
        relationships=followed.select("cidx", F.col("nridx").alias("ridx"), "rel_name", "object_ui", "src"),
    )


def _running(df: DataFrame, key: str, n: str) -> DataFrame:
    """``<key>, start``: the sum of ``n`` over smaller keys, from sums of key ranges."""
    total = df.count()
    parts = max(1, -(-total // 200_000))
    placed = runtime.durable(df.repartitionByRange(parts, key).withColumn("part", F.spark_partition_id()))
    before = F.coalesce(F.sum("s").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = placed.groupBy("part").agg(F.sum(n).alias("s")).withColumn("b", before)
    local = F.coalesce(F.sum(n).over(Window.partitionBy("part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.withColumn("l", local).join(F.broadcast(starts.select("part", "b")), "part").select(key, (F.col("b") + F.col("l")).alias("start"))
