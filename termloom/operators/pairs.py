"""Filtering candidate pairs, by rules and by annotations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom import runtime
from termloom.model import KB


def term_sets(kb: KB, idf: DataFrame | None = None) -> DataFrame:
    """``cidx, all, plain, linked``: sets of lower-case terms; preferred ones without and with a linking score.

    With ``idf`` (``src_id, idf``) linked terms count only from the threshold
    min + (max - min) / 1.5 on.
    """
    atoms = kb.atoms
    linked = F.col("linking_score").isNotNull()
    good = F.lit(True)
    if idf is not None:
        edge = idf.agg((F.min("idf") + (F.max("idf") - F.min("idf")) / 1.5).alias("edge"))
        strong = idf.crossJoin(F.broadcast(edge)).where("idf >= edge").select("src_id", F.lit(True).alias("strong"))
        atoms = runtime.lookup(atoms, strong, "src_id", F.struct("cidx", "pos"), runtime.hot_keys(atoms, "src_id"))
        good = F.coalesce("strong", F.lit(False))
    pref = F.col("is_preferred")
    return atoms.groupBy("cidx").agg(
        F.collect_set("term_lc").alias("all"),
        F.collect_set(F.when(pref & ~linked, F.col("term_lc"))).alias("plain"),
        F.collect_set(F.when(pref & linked & good, F.col("term_lc"))).alias("linked"),
    )


def linked_idf(kb: KB) -> DataFrame:
    """``src_id, idf``: ln(concepts / concepts with a linked atom of that id)."""
    df = kb.atoms.where("linking_score is not null and src_id is not null").groupBy("src_id").agg(F.countDistinct("cidx").alias("df"))
    total = kb.concepts.agg(F.count(F.lit(1)).alias("total"))
    return df.crossJoin(F.broadcast(total)).select("src_id", F.log(F.col("total") / F.col("df")).alias("idf"))


def _sides(kb: KB, pairs: DataFrame, sets: DataFrame, ignore_types: Sequence[str]) -> DataFrame:
    sets = runtime.durable(kb.concepts.select("cidx", "concept_type").join(sets, "cidx", "left"))
    side = lambda x: sets.select(F.col("cidx").alias(x), *[F.coalesce(c, F.array().cast("array<string>")).alias(f"{x}_{c}") for c in ("all", "plain", "linked")], F.upper("concept_type").alias(f"{x}_type"))
    joined = runtime.lookup(pairs, side("i"), "i", F.col("j"), runtime.hot_keys(pairs, "i"), "inner")
    joined = runtime.lookup(joined, side("j"), "j", F.col("i"), runtime.hot_keys(pairs, "j"), "inner")
    return joined.where(~F.coalesce(F.col("i_type"), F.lit("")).isin(list(ignore_types))) if ignore_types else joined


def filter_basic(kb: KB, pairs: DataFrame, ignore_types: Sequence[str] = (), symmetric: bool = False) -> DataFrame:
    """``i, j``: pairs whose linked preferred terms agree or, where a side has none, whose second side has a plain preferred term.

    The second rule is the source pipeline's; ``symmetric`` asks instead that a
    plain preferred term of one side is a term of the other. Types in
    ``ignore_types`` (upper case) are tested on the first side.
    """
    d = _sides(kb, pairs, term_sets(kb), ignore_types)
    unlinked = (F.size("i_linked") == 0) | (F.size("j_linked") == 0)
    plain = F.arrays_overlap("i_all", "j_plain") | (F.arrays_overlap("j_all", "i_plain") if symmetric else F.size("j_plain") > 0)
    enough = F.size(F.array_intersect("i_linked", "j_linked")) >= F.least(F.size("i_linked"), F.size("j_linked"))
    return d.where(F.when(unlinked, plain).otherwise(enough)).select("i", "j")


def filter_idf(kb: KB, pairs: DataFrame, ignore_types: Sequence[str] = ()) -> DataFrame:
    """``i, j``: pairs that share two informative linked terms or, where a side has none, a plain preferred term."""
    d = _sides(kb, pairs, term_sets(kb, linked_idf(kb)), ignore_types)
    unlinked = (F.size("i_linked") == 0) | (F.size("j_linked") == 0)
    shared = F.size(F.array_intersect("i_linked", "j_linked")) > 1
    return d.where(F.when(unlinked, F.arrays_overlap("i_plain", "j_plain")).otherwise(shared)).select("i", "j")


def annotation_tasks(kb: KB, pairs: DataFrame, preferred: DataFrame) -> DataFrame:
    """``i, j, term_i, term_j, matched_on``: pairs to judge, with their shared terms; pairs of equal preferred terms need none.

    The pair itself is carried, so answers find it whatever the stream dropped.
    """
    sets = kb.atoms.groupBy("cidx").agg(F.collect_set("term_lc").alias("terms"))
    names = runtime.durable(preferred.select("cidx", "term", "src", "src_id").join(sets, "cidx"))
    side = lambda x: names.select(F.col("cidx").alias(x), F.struct("term", "src", "src_id").alias(f"ing_{x}"), F.col("terms").alias(f"terms_{x}"))
    d = pairs.join(side("i"), "i").join(side("j"), "j").where(F.lower("ing_i.term") != F.lower("ing_j.term"))
    return d.select("i", "j", "ing_i", "ing_j", F.array_sort(F.array_intersect("terms_i", "terms_j")).alias("matched_on"))


# What an annotator may answer about a pair.
OPTIONS = [(1, "Equal"), (2, "Not Equal"), (3, "Parent-Child"), (4, "Child-Parent")]


def annotation_stream(tasks: DataFrame, html: str) -> DataFrame:
    """``_input_hash, _task_hash, html, options, i, j, ...``: tasks in the order of their pairs as an annotation tool takes them.

    The place of a task is its input hash, and its negative less one its task
    hash, so no two are alike; every task carries the page template and OPTIONS.
    """
    placed = runtime.positions(tasks, ["i", "j"], "_input_hash")
    options = F.array(*[F.struct(F.lit(k).alias("id"), F.lit(t).alias("text")) for k, t in OPTIONS])
    return placed.select("_input_hash", (-F.col("_input_hash") - 1).alias("_task_hash"), F.lit(html).alias("html"), options.alias("options"), *tasks.columns)


def filter_annotated(pairs: DataFrame, annotations: DataFrame) -> DataFrame:
    """``i, j``: pairs judged equal (answer 'accept' with option 1) and those not judged at all."""
    judged = annotations.select("i", "j").distinct()
    equal = annotations.where((F.col("answer") == "accept") & F.array_contains("accept", 1)).select("i", "j").distinct()
    return pairs.join(equal, ["i", "j"], "left_semi").unionByName(pairs.join(judged, ["i", "j"], "left_anti"))
