"""Problem 5: the best representative of each duplicate group.

Two operators. ``truths`` is the latent two-sided quality model: it infers each
source's sensitivity and specificity by expectation-maximisation from who
claims what, and keeps every value judged true of a multi-valued field. A
value's probability depends only on which sources claim it among those that
cover its entity, so values are first counted by that pattern and the iterations
run over patterns.

``survivors`` picks one source row per kind of content by declared preferences
(rank, richness, recency); it is what TESTDATA.md asks for, whose fixed
preferences no inferred quality can reproduce.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import runtime

#: Up to this many distinct patterns are iterated in the driver; more are iterated as a table.
DRIVER_PATTERNS = 100_000
ROUNDS = 25
UNLISTED = 1_000_000


def source_key(c: Column) -> Column:
    """A source however it is written: letters and digits in lower case; null if there are none."""
    return F.nullif(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", ""), F.lit(""))


def source_ranks(ranks: DataFrame) -> DataFrame:
    """``src_key, key, rank``: every way to name a listed source (code or full name) and its rank."""
    both = ranks.select(source_key(F.col("src")).alias("src_key"), "src_rank", F.explode(F.array("src", "src_name")).alias("name"))
    return both.select("src_key", source_key(F.col("name")).alias("key"), F.col("src_rank").alias("rank")).where("key is not null").groupBy("key").agg(F.min_by("src_key", "rank").alias("src_key"), F.min("rank").alias("rank"))


def _trimmed(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"(?U)^[\s\p{Z}\p{Cf}]+|[\s\p{Z}\p{Cf}]+$", ""))


def survivors(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """``ui, survives, cidx``: per ``ui`` of two or more rows the row that supplies each kind of content.

    Kinds are ``preferred_term`` (best-ranked source among the row's non-blank
    preferred synonyms; unlisted and missing sources rank last), ``synonyms``
    (most distinct non-blank terms) and ``attributes`` (latest row with a
    non-blank value). Ties go to the later ``updated_at`` (null is oldest),
    then the smaller ``cidx``. One aggregation with partial maxima: a hot ``ui``
    never gathers in one task.

    Edge cases: null ``ui`` are ignored; null or empty arrays and null entries
    supply nothing; a kind that no row supplies has no case; repeated rows count
    as rows; an empty table gives no rows; extra columns are ignored.
    """
    listed = {r["key"]: r["rank"] for r in source_ranks(ranks).collect()}  # the list of sources, a vocabulary
    rank_of = F.create_map(*[F.lit(x) for kv in listed.items() for x in kv]) if listed else F.lit(None).cast("map<string,int>")
    full = F.filter("synonyms", lambda s: ~runtime.blank(s["term"]))
    best = F.array_min(F.transform(F.filter(full, lambda s: F.coalesce(s["is_preferred"], F.lit(False))), lambda s: F.coalesce(F.try_element_at(rank_of, F.coalesce(source_key(s["src"]), F.lit(""))), F.lit(UNLISTED))))
    terms = F.size(F.array_distinct(F.transform(full, lambda s: _trimmed(s["term"]))))
    valued = F.exists("attributes", lambda a: ~runtime.blank(a["atr_value"]))
    work = rows.where("ui is not null").select("ui", "cidx", "updated_at", best.alias("best"), F.when(terms > 0, terms).alias("terms"), F.coalesce(valued, F.lit(False)).alias("valued"))
    tie = (F.col("updated_at").alias("at"), (-F.col("cidx")).alias("neg"))
    kinds = {
        "preferred_term": F.max(F.when(F.col("best").isNotNull(), F.struct((-F.col("best")).alias("by"), *tie))),
        "synonyms": F.max(F.when(F.col("terms").isNotNull(), F.struct(F.col("terms").alias("by"), *tie))),
        "attributes": F.max(F.when(F.col("valued"), F.struct(F.lit(0).alias("by"), *tie))),
    }
    best_of = work.groupBy("ui").agg(F.count(F.lit(1)).alias("n"), *[e.getField("neg").alias(k) for k, e in kinds.items()]).where("n >= 2")
    cases = F.explode(F.array(*[F.struct(F.lit(k).alias("survives"), (-F.col(k)).alias("cidx")) for k in kinds])).alias("c")
    return best_of.select("ui", cases).select("ui", "c.survives", "c.cidx").where("cidx is not null")


def _rates(claimed: np.ndarray, covered: np.ndarray, n: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    true, false = n * p, n * (1 - p)
    sens = (claimed.T @ true + 2.0) / (covered.T @ true + 3.0)
    spec = ((covered - claimed).T @ false + 9.0) / (covered.T @ false + 10.0)
    return sens, spec


def truths(claims: DataFrame, entity: str, value: str, source: str, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """The truth of every claimed value and the quality of every source.

    ``claims`` has one row per claim that ``entity`` has ``value``, by
    ``source``. A source that claims anything of an entity covers it; not
    claiming a value there is a claim against it. Returns
    ``entity, value, probability, is_true`` and ``source, sensitivity,
    specificity``; an entity may keep several values.

    Edge cases: claims with a null in any of the three are ignored; repeated
    claims count once; an entity of one source keeps values at that source's
    prior; an empty table gives no rows.
    """
    c = claims.select(F.col(entity).alias("entity"), F.col(value).alias("value"), F.col(source).alias("source")).na.drop().distinct()
    by_value = c.groupBy("entity", "value").agg(F.array_sort(F.collect_set("source")).alias("claimed"))
    cover = c.groupBy("entity").agg(F.array_sort(F.collect_set("source")).alias("covered"))
    facts = runtime.durable(runtime.lookup(by_value, cover, "entity", F.xxhash64("value"), runtime.hot_keys(by_value, "entity"), "inner"))
    patterns = runtime.durable(facts.groupBy("claimed", "covered").agg(F.count(F.lit(1)).alias("n")))
    if patterns.count() > DRIVER_PATTERNS:
        scored, quality = _by_table(patterns, rounds)
    else:
        scored, quality = _by_array(patterns, rounds)
    judged = facts.join(scored, ["claimed", "covered"]).select("entity", "value", F.round("probability", 6).alias("probability"))
    return judged.withColumn("is_true", F.col("probability") >= 0.5), quality


def _by_array(patterns: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    spark = patterns.sparkSession
    got = patterns.collect()
    names = sorted({s for r in got for s in r["covered"]})
    place = {s: i for i, s in enumerate(names)}
    claimed, covered = np.zeros((len(got), len(names))), np.zeros((len(got), len(names)))
    for k, r in enumerate(got):
        claimed[k, [place[s] for s in r["claimed"]]] = 1
        covered[k, [place[s] for s in r["covered"]]] = 1
    n = np.asarray([r["n"] for r in got], dtype=float)
    p = claimed.sum(axis=1) / np.maximum(covered.sum(axis=1), 1)
    sens, spec = np.zeros(len(names)), np.zeros(len(names))
    for _ in range(rounds):
        sens, spec = _rates(claimed, covered, n, p)
        prior = float((n * p).sum() + 1) / (float(n.sum()) + 2)
        odds = np.log(prior / (1 - prior)) + claimed @ np.log(sens / (1 - spec)) + (covered - claimed) @ np.log((1 - sens) / spec)
        p = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    rows = [(r["claimed"], r["covered"], float(x)) for r, x in zip(got, p)]
    scored = spark.createDataFrame(rows, "claimed array<string>, covered array<string>, probability double")
    quality = spark.createDataFrame([(s, float(a), float(b)) for s, a, b in zip(names, sens, spec)], "source string, sensitivity double, specificity double")
    return F.broadcast(scored), quality


def _by_table(patterns: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    scored = patterns.withColumn("p", F.size("claimed") / F.size("covered"))
    quality = None
    for _ in range(rounds):
        each = scored.select("n", "p", "claimed", F.explode("covered").alias("source")).withColumn("says", F.array_contains("claimed", F.col("source")))
        true, false = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
        sens = (F.sum(F.when(F.col("says"), true).otherwise(0.0)) + 2.0) / (F.sum(true) + 3.0)
        spec = (F.sum(F.when(~F.col("says"), false).otherwise(0.0)) + 9.0) / (F.sum(false) + 10.0)
        quality = runtime.durable(each.groupBy("source").agg(sens.alias("sensitivity"), spec.alias("specificity")))
        total = scored.agg(F.sum(F.col("n") * F.col("p")).alias("t"), F.sum("n").alias("n")).first()
        prior = (total["t"] + 1) / (total["n"] + 2)
        each = scored.select("claimed", "covered", "n", F.explode("covered").alias("source")).join(quality, "source")
        vote = F.when(F.array_contains("claimed", F.col("source")), F.log(F.col("sensitivity") / (1 - F.col("specificity")))).otherwise(F.log((1 - F.col("sensitivity")) / F.col("specificity")))
        odds = F.lit(float(np.log(prior / (1 - prior)))) + F.sum(vote)
        scored = runtime.durable(each.groupBy("claimed", "covered", "n").agg((1 / (1 + F.exp(-odds))).alias("p")))
    return scored.select("claimed", "covered", F.col("p").alias("probability")), quality


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ui, term, src``: who claims what; missing and blank sources are together a source of their own (the empty text)."""
    rows = runtime.table(spark, sf_dir, "ingredients")
    listed = source_ranks(runtime.table(spark, sf_dir, "source_rank")).select("key", "src_key")
    each = rows.select("ui", F.explode("synonyms").alias("s")).select("ui", F.col("s.term").alias("term"), F.coalesce(source_key(F.col("s.src")), F.lit("")).alias("key"))
    each = each.where(~runtime.blank(F.col("term")))
    each = each.join(F.broadcast(listed), "key", "left")
    return each.select("ui", _trimmed(F.col("term")).alias("term"), F.coalesce("src_key", "key").alias("src"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(runtime.table(spark, sf_dir, "ingredients"), runtime.table(spark, sf_dir, "source_rank"))


def p5_truths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term of every ``ui`` with its probability of being true under the two-sided model."""
    judged, _ = truths(_claims(spark, sf_dir), "ui", "term", "src")
    return judged.select(F.col("entity").alias("ui"), F.col("value").alias("term"), "probability", "is_true")
