"""Lint, removal of a source, and statistics of a knowledge base."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom import runtime
from termloom.model import KB


def lint(kb: KB, labels: DataFrame, properties: DataFrame, edges: DataFrame) -> DataFrame:
    """``cidx, rule, value``: every breach of the schema (small, declared tables; names compared in upper case for labels and edges).

    Rules: ``concept_type``, ``relationship``, ``attribute``, ``rel_attribute``
    (skipped where the type or edge is unknown), ``ui``, ``term`` and ``value``
    (line breaks or tabs), ``no_atoms``.
    """
    up = lambda c: F.upper(F.coalesce(c, F.lit("")))
    known = F.broadcast(labels.select(F.upper("label").alias("k")).distinct())
    legal = F.broadcast(properties.select(F.upper("label").alias("k"), "property").distinct())
    edge_known = F.broadcast(edges.select(F.upper("edge").alias("k")).distinct())
    edge_legal = F.broadcast(edges.where("property is not null").select(F.upper("edge").alias("k"), "property").distinct())
    dirty = lambda c: F.col(c).rlike(r"[\n\t\r]")
    concepts = kb.concepts.withColumn("k", up(F.col("concept_type")))
    typed = concepts.join(known, "k", "left_semi")
    rels = kb.relationships.withColumn("k", up(F.col("rel_name")))
    of_rel = kb.rel_attributes.join(rels.select("cidx", "ridx", "k").join(edge_known, "k", "left_semi"), ["cidx", "ridx"])
    found = [
        concepts.join(known, "k", "left_anti").select("cidx", F.lit("concept_type").alias("rule"), F.col("concept_type").alias("value")),
        rels.join(edge_known, "k", "left_anti").select("cidx", F.lit("relationship").alias("rule"), F.col("rel_name").alias("value")),
        kb.attributes.join(typed.select("cidx", "k"), "cidx").withColumn("property", F.coalesce("atr_name", F.lit(""))).join(legal, ["k", "property"], "left_anti").select("cidx", F.lit("attribute").alias("rule"), F.col("atr_name").alias("value")),
        of_rel.withColumn("property", F.coalesce("atr_name", F.lit(""))).join(edge_legal, ["k", "property"], "left_anti").select("cidx", F.lit("rel_attribute").alias("rule"), F.col("atr_name").alias("value")),
        kb.concepts.where(~F.coalesce("ui", F.lit("")).rlike(r"^[a-zA-Z_]+[0-9]{7}")).select("cidx", F.lit("ui").alias("rule"), F.col("ui").alias("value")),
        kb.atoms.where(dirty("term")).select("cidx", F.lit("term").alias("rule"), F.col("term").alias("value")),
        kb.attributes.where(dirty("atr_value")).select("cidx", F.lit("value").alias("rule"), F.col("atr_value").alias("value")),
        kb.concepts.join(kb.atoms.select("cidx").distinct(), "cidx", "left_anti").select("cidx", F.lit("no_atoms").alias("rule"), F.col("ui").alias("value")),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def lint_report(breaches: DataFrame, origin: DataFrame) -> DataFrame:
    """``file, message, n``: the distinct messages of every file, with how many concepts they are about.

    ``origin`` has ``cidx, file``; a file without breaches has no row.
    """
    said = F.concat_ws(": ", "rule", F.regexp_replace(F.coalesce("value", F.lit("none")), r"[\n\t\r]", " "))
    each = runtime.lookup(breaches, origin.select("cidx", "file"), "cidx", F.col("value"), [], "inner").select("file", said.alias("message"), "cidx").distinct()
    return each.groupBy("file", "message").agg(F.count(F.lit(1)).alias("n"))


def write_report(report: DataFrame, path: str) -> None:
    """A text report per file: its messages in order."""
    report.sort("file", "message").select("file", F.concat_ws("\t", "message", "n").alias("value")).write.partitionBy("file").text(path)


def lint_lines(lines: DataFrame, key: str, text: str) -> DataFrame:
    """``<key>``: lines that are no JSON object."""
    variant = F.try_parse_json(text)
    bad = variant.isNull() | ~F.coalesce(F.schema_of_variant(variant).startswith("OBJECT"), F.lit(False))
    return lines.where(bad).select(key)


def vocabulary_breaches(kb: KB, sources: Sequence[str], term_types: Sequence[str], types: Sequence[str]) -> DataFrame:
    """``what, value, n``: sources, term types and concept types outside the declared lists (in upper case)."""

    def outside(df: DataFrame, column: str, allowed: Sequence[str], what: str) -> DataFrame:
        value = F.upper(F.coalesce(column, F.lit("")))
        return df.where(~value.isin(list(allowed))).groupBy(F.lit(what).alias("what"), F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))

    return outside(kb.atoms, "src", sources, "src").unionByName(outside(kb.atoms, "term_type", term_types, "term_type")).unionByName(outside(kb.concepts, "concept_type", types, "concept_type"))


def remove_source(kb: KB, source: str, types: Sequence[str] = (), cascade: bool = True) -> KB:
    """The knowledge base without what ``source`` supplied, and without concepts that lose their last atom.

    ``types`` restricts the removal to concepts of these types. With
    ``cascade`` relationships to removed concepts go too.
    """
    hit = kb.concepts.where(F.col("concept_type").isin(list(types))) if types else kb.concepts
    hit = hit.select("cidx", F.lit(True).alias("__hit"))
    gone = F.coalesce("__hit", F.lit(False)) & F.coalesce(F.col("src") == source, F.lit(False))

    def left(df: DataFrame) -> DataFrame:
        return df.join(hit, "cidx", "left").where(~gone).drop("__hit")

    atoms = left(kb.atoms)
    empty = hit.select("cidx").join(atoms.select("cidx").distinct(), "cidx", "left_anti")
    concepts = runtime.durable(kb.concepts.join(empty, "cidx", "left_anti"))
    keep = lambda d: d.join(concepts.select("cidx"), "cidx", "left_semi")
    rels = keep(left(kb.relationships))
    if cascade:
        lost = kb.concepts.select("ui").join(concepts.select("ui"), "ui", "left_anti").where("ui is not null").distinct()
        rels = rels.join(lost.withColumnRenamed("ui", "object_ui"), "object_ui", "left_anti")
    return KB(concepts, keep(atoms), keep(left(kb.attributes)), left(kb.rel_attributes).join(rels.select("cidx", "ridx"), ["cidx", "ridx"], "left_semi"), rels)


def remove_elements(table: DataFrame, gone: DataFrame, keys: Sequence[str], strict: bool = True) -> DataFrame:
    """``table`` without the elements whose ``keys`` are in ``gone``; if one of those is absent, ``strict`` refuses.

    Null keys are equal to null; repeated keys in ``gone`` count once.
    """
    gone = gone.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = None
    for k in keys:
        here = F.col(k).eqNullSafe(F.col(f"__{k}"))
        same = here if same is None else same & here
    if strict and (absent := gone.join(table.select(*keys).distinct(), same, "left_anti").count()):
        raise KeyError(f"{absent} elements to remove are not there")
    return table.join(gone, same, "left_anti")


def atoms_named(kb: KB, names: DataFrame) -> DataFrame:
    """The atoms whose term is, letter for letter, one of ``names`` (``term``)."""
    return kb.atoms.join(names.select("term").distinct(), "term", "left_semi")


def shared_name(kb: KB) -> DataFrame:
    """``term``: the first, by letters, of the terms that most concepts have."""
    often = kb.atoms.groupBy("term").agg(F.countDistinct("cidx").alias("n"))
    return often.orderBy(F.desc("n"), "term").limit(1).select("term")


def concept_count(kb: KB) -> DataFrame:
    return kb.concepts.agg(F.countDistinct("ui").alias("n"))


def type_counts(kb: KB) -> DataFrame:
    """``concept_type, n``: distinct concepts per type."""
    return kb.concepts.groupBy("concept_type").agg(F.countDistinct("ui").alias("n"))


def type_source_counts(kb: KB) -> DataFrame:
    """``concept_type, src, n``: distinct concepts per type and source of their atoms."""
    return kb.atoms.join(kb.concepts, "cidx").groupBy("concept_type", "src").agg(F.countDistinct("ui").alias("n"))


def source_overlap(kb: KB, concept_type: str = "SDSI", hide: str = "_UMLS") -> DataFrame:
    """``sources, n``: concepts of a type by the sorted set of their sources; ``hide`` is taken out of the joined names."""
    mine = kb.atoms.join(kb.concepts.where(F.col("concept_type") == concept_type), "cidx")
    joined = F.replace(F.array_join(F.array_sort(F.collect_set("src")), "_"), F.lit(hide), F.lit(""))
    return mine.groupBy("ui").agg(joined.alias("sources")).groupBy("sources").agg(F.count(F.lit(1)).alias("n"))


def statistics(df: DataFrame, n: str) -> DataFrame:
    """One row: minimum, maximum, mean, sample deviation, biased skew and excess kurtosis of a column of counts."""
    c: Column = F.col(n)
    return df.agg(F.min(c).alias("least"), F.max(c).alias("most"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("sd"), F.skewness(c).alias("skew"), F.kurtosis(c).alias("kurtosis"))


def atoms_per_concept(kb: KB, concept_type: str = "SDSI") -> DataFrame:
    """``cidx, n``: atoms of every concept of a type that has any."""
    return kb.atoms.join(kb.concepts.where(F.col("concept_type") == concept_type).select("cidx"), "cidx").groupBy("cidx").agg(F.count(F.lit(1)).alias("n"))


def codes_per_concept(kb: KB, source: str = "UMLS", concept_type: str = "SDSI") -> DataFrame:
    """``cidx, n``: distinct codes of a source per concept of a type."""
    mine = kb.atoms.where(F.col("src") == source).join(kb.concepts.where(F.col("concept_type") == concept_type).select("cidx"), "cidx")
    return mine.groupBy("cidx").agg(F.countDistinct("src_id").alias("n"))


def code_ratio(kb: KB, source: str = "UMLS", concept_type: str = "SDSI") -> DataFrame:
    """``codes, concepts, ratio``: distinct codes of a source and the distinct concepts of a type that have any."""
    mine = kb.atoms.where(F.col("src") == source).join(kb.concepts.where(F.col("concept_type") == concept_type).select("cidx"), "cidx")
    both = mine.agg(F.countDistinct("src_id").alias("codes"), F.countDistinct("cidx").alias("concepts"))
    return both.select("codes", "concepts", (F.col("codes") / F.nullif("concepts", F.lit(0))).alias("ratio"))


def published_statistics(conso: DataFrame, sty: DataFrame) -> DataFrame:
    """``STY, SAB, concepts, atoms`` of published name and type files, joined by CUI."""
    both = conso.join(sty, "CUI")
    return both.groupBy("STY", "SAB").agg(F.countDistinct("CUI").alias("concepts"), F.count(F.lit(1)).alias("atoms"))


def extremes(counts: DataFrame, key: str, n: str, k: int = 3) -> DataFrame:
    """``side, key, n``: the ``k`` lowest and highest by (n, key)."""
    low = counts.orderBy(n, key).limit(k).select(F.lit("low").alias("side"), key, n)
    high = counts.orderBy(F.desc(n), F.desc(key)).limit(k).select(F.lit("high").alias("side"), key, n)
    return low.unionByName(high)


def relationship_counts(kb: KB) -> DataFrame:
    """``rel_name, src, n`` in one pass: per name and source, per name (src null), and in all (both null)."""
    return kb.relationships.rollup("rel_name", "src").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


def attribute_counts(kb: KB) -> DataFrame:
    """``atr_name, src, n`` like ``relationship_counts``, over attributes of concepts and of relationships."""
    both = kb.attributes.select("atr_name", "src").unionByName(kb.rel_attributes.select("atr_name", "src"))
    return both.rollup("atr_name", "src").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))
