"""Problem 1: duplicates hidden by formatting differences.

Method: dictionary-encode the columns. Every distinct value is canonicalised
once and given an integer identifier; records are rewritten as sorted tuples of
identifiers; the compact tuples are grouped.

Identifiers are ``(xxhash64 of the canonical form, number among colliding
forms)``. The second part is 1 but for hash collisions, so equal identifiers
mean equal canonical forms, and nothing depends on the order of rows or on
recomputed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom import runtime

ID = "struct<h:bigint,k:int>"


def canonical(c: Column) -> Column:
    """Letters (with accents) and digits of ``c`` in lower case; null if there are none."""
    return F.nullif(F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}\p{N}]+", ""), F.lit(""))


def dictionary(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``value, id, n``: every distinct value of ``fields`` that has a canonical form, its identifier, its uses."""
    cells = df.select(F.explode(F.array(*[F.col(f) for f in fields])).alias("value")).where("value is not null")
    values = cells.groupBy("value").agg(F.count(F.lit(1)).alias("n")).withColumn("form", canonical(F.col("value"))).where("form is not null")
    values = values.withColumn("h", F.xxhash64("form"))
    k = F.dense_rank().over(Window.partitionBy("h").orderBy("form"))
    return values.withColumn("id", F.struct("h", k.cast("int").alias("k"))).select("value", "id", "n")


def collapse(df: DataFrame, fields: Sequence[str], scope: Sequence[str], row: str, exchangeable: bool = True) -> DataFrame:
    """One row per set of records that agree in ``scope`` and, but for formatting, in ``fields``.

    Returns ``scope columns, <row>, copies, key``: the smallest ``row`` of the
    set, its number of records, and the tuple of identifiers. With
    ``exchangeable`` the fields' order does not matter; otherwise each
    identifier keeps its field number.

    Edge cases: a null, empty or all-punctuation value equals a missing one;
    records without any value in ``fields`` agree with each other; null scope
    values agree with each other; repeated rows count as copies each; an empty
    table gives no rows; other columns are ignored, whatever their names.
    """
    names = {f: f"__f{i}" for i, f in enumerate(fields)}
    keys = {s: f"__s{i}" for i, s in enumerate(scope)}
    work = df.select(F.col(row).alias("__row"), *[F.col(s).alias(a) for s, a in keys.items()], *[F.col(f).alias(a) for f, a in names.items()])
    words = runtime.durable(dictionary(work, list(names.values())))
    total = words.agg(F.sum("n")).first()[0] or 0
    hot = runtime.hot_keys(words, "value", total, F.col("n")) if total >= runtime.HOT_ROWS else []
    for f in names.values():
        entry = words.select(F.col("value").alias(f), F.col("id").alias(f"{f}_id"))
        work = runtime.lookup(work, entry, f, F.col("__row"), hot).drop(f)
    ids = [F.struct(F.lit(0 if exchangeable else i).alias("field"), F.col(f"{f}_id").alias("id")) for i, f in enumerate(names.values())]
    tuples = work.select("__row", *keys.values(), F.array_sort(F.filter(F.array(*ids), lambda x: x["id"].isNotNull())).alias("key"))
    sets = tuples.groupBy(*keys.values(), "key").agg(F.min("__row").alias(row), F.count(F.lit(1)).alias("copies"))
    return sets.select(*[F.col(a).alias(s) for s, a in keys.items()], row, "copies", "key")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = runtime.table(spark, sf_dir, "nhp_medicinal_ingredients")
    sets = collapse(rows, ["proper_name", "common_name"], ["product_id"], "row_id")
    return sets.where("copies >= 2").select("product_id", "row_id", "copies")
