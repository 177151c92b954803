"""Problem 8: filling fixed-capacity containers with items.

Method: exact-complement hashing. Items are counted by length; single, pair and
triple sums of lengths are indexed; combinations that fill a container exactly
are consumed under availability counts; what is left is packed best fit.

The plan needs only the histogram of lengths, which has at most ``capacity``
entries whatever the data hold, so it is made in the driver; items then find
their place by their rank within their length. Ranks come from counts of
hashed buckets, so no length gathers in one task, and hold under recomputation.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom import runtime

CAPACITY = 2048
#: The public vocabulary that texts are measured with; its file is a parameter.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published split pattern of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Items of one bucket of a length class, on average.
BUCKET_ROWS = 20_000

_encodings: dict = {}


def _encoding(path: str):
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def token_counts(df: DataFrame, key: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``<key>, tokens``: the length of every text in tokens; a null text has none.

    The vocabulary's file is on the driver and is sent to the executors.
    """
    kind = dict(df.dtypes)[key]
    df.sparkSession.sparkContext.addFile(tokenizer)
    name = os.path.basename(tokenizer)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = _encoding(SparkFiles.get(name))
        for batch in batches:
            counts = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch["text"]]
            yield pd.DataFrame({key: batch["key"], "tokens": np.asarray(counts, dtype=np.int64)})

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, f"{key} {kind}, tokens bigint")


def split_oversize(items: DataFrame, size: str, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``part, length``: an item longer than the capacity becomes full parts and a rest; others stay whole."""
    parts = F.greatest(F.ceil(F.col(size) / capacity).cast("int"), F.lit(1))
    split = items.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return split.withColumn("length", F.least(F.lit(capacity), F.greatest(F.col(size) - F.col("part") * capacity, F.lit(0))).cast("int"))


def _combination(gap: int, have: np.ndarray) -> tuple[int, ...] | None:
    """One, two or three available lengths that sum to ``gap``, the longest first; None if there are none."""
    if have[gap] > 0:
        return (gap,)
    there = have[: gap + 1] > 0
    for b in np.flatnonzero(there[: gap])[::-1]:
        c = gap - b
        if c > b:
            break
        if c > 0 and there[c] and (b != c or have[b] > 1):
            return int(b), int(c)
    for b in np.flatnonzero(there[: gap])[::-1]:
        if 3 * b < gap:
            break
        rest = gap - b
        cs = np.flatnonzero(there[: min(b, rest - 1) + 1])
        cs = cs[(cs > 0) & (2 * cs >= rest)]
        ds = rest - cs
        good = cs[there[ds]]
        for c in good[::-1]:
            d = rest - c
            need = {}
            for x in (b, c, d):
                need[x] = need.get(x, 0) + 1
            if all(have[x] >= k for x, k in need.items()):
                return int(b), int(c), int(d)
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, containers)``: how many containers hold which lengths; every item of ``counts`` is placed once."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        if 0 < length <= capacity:
            have[length] += n
    groups: list[tuple[tuple[int, ...], int]] = []
    if have[capacity]:
        groups.append(((capacity,), int(have[capacity])))
        have[capacity] = 0
    for a in range(capacity - 1, 0, -1):
        while have[a] > 0:
            have[a] -= 1  # one seed item apart, so that its complement is found among the others
            rest = _combination(capacity - a, have)
            have[a] += 1
            if rest is None:
                break
            need: dict[int, int] = {}
            for x in (a, *rest):
                need[x] = need.get(x, 0) + 1
            times = min(int(have[x]) // k for x, k in need.items())
            for x, k in need.items():
                have[x] -= k * times
            groups.append(((a, *rest), times))
    return groups + _best_fit(have, capacity)


def _best_fit(have: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, for the lengths left; like containers are handled together."""
    by_gap: dict[int, list[list]] = {}
    open_gaps = np.zeros(capacity + 1, dtype=np.int64)

    def put(lengths: tuple[int, ...], n: int, gap: int) -> None:
        by_gap.setdefault(gap, []).append([lengths, n])
        open_gaps[gap] += n

    for length in range(capacity, 0, -1):
        n = int(have[length])
        while n:
            fits = np.flatnonzero(open_gaps[length:])
            if len(fits):
                gap = length + int(fits[0])
                group = by_gap[gap][-1]
                times = min(n, group[1])
                group[1] -= times
                open_gaps[gap] -= times
                if not group[1]:
                    by_gap[gap].pop()
                put((*group[0], length), times, gap - length)
                n -= times
            else:
                each = min(capacity // length, n)
                times = n // each
                put((length,) * each, times, capacity - each * length)
                n -= each * times
    return [(lengths, n) for groups in by_gap.values() for lengths, n in groups]


def _places(groups: list[tuple[tuple[int, ...], int]]) -> tuple[list[tuple[int, int, int, int]], int]:
    """``length, first_rank, last_rank, shift`` (container = rank + shift), and the number of containers."""
    used: dict[int, int] = {}
    rows, container = [], 0
    for lengths, n in groups:
        for length in lengths:
            start = used.get(length, 0)
            rows.append((length, start, start + n - 1, container - start))
            used[length] = start + n
        container += n
    return rows, container


def ranked(items: DataFrame, group: str, order: list[str], rows: int) -> DataFrame:
    """Adds ``rank`` (from 0) within ``group`` by counting hashed buckets; a hot group spreads over all tasks."""
    buckets = max(1, -(-rows // BUCKET_ROWS))
    bucket: Column = F.pmod(F.xxhash64(*order), F.lit(buckets))
    items = items.withColumn("__bucket", bucket)
    counts = items.groupBy(group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(group, "__bucket", F.coalesce(before, F.lit(0)).alias("__start"))
    local = F.row_number().over(Window.partitionBy(group, "__bucket").orderBy(*order))
    placed = items.withColumn("__at", local).join(starts, [group, "__bucket"])
    return placed.withColumn("rank", F.col("__start") + F.col("__at") - 1).drop("__bucket", "__at", "__start")


def pack(df: DataFrame, key: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """``<key>, part, length, container``: every item, or part of an item over the capacity, in a container.

    Containers are numbered from 0 and hold at most ``capacity``; parts of one
    item are numbered from 0. Items of length 0 take no room and are spread
    over the containers (container 0 if there is no other).

    Edge cases: null sizes count as 0, negative ones too; null keys are items
    like others; repeated rows are items each, told apart by nothing but their
    place; an empty table gives no rows; extra columns are ignored.
    """
    spark = df.sparkSession
    kind = dict(df.dtypes)[key]
    items = df.select(F.col(key).alias("key"), F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("bigint").alias("size"))
    items = runtime.durable(split_oversize(items, "size", capacity).select("key", "part", "length"))
    counts = {r[0]: r[1] for r in items.groupBy("length").count().collect()}  # at most capacity + 1 rows
    rows, containers = _places(plan(counts, capacity))
    placed = ranked(items, "length", ["key", "part"], sum(counts.values()))
    table = spark.createDataFrame(rows, "length int, first_rank bigint, last_rank bigint, shift bigint")
    # the plan grows with the capacity, not with the data
    by = (placed["length"] == table["length"]) & (placed["rank"] >= table["first_rank"]) & (placed["rank"] <= table["last_rank"])
    full = placed.where("length > 0").join(F.broadcast(table), by).select("key", "part", placed["length"], (F.col("rank") + F.col("shift")).alias("container"))
    none = placed.where("length = 0").select("key", "part", "length", F.pmod("rank", F.lit(max(1, containers))).alias("container"))
    return full.unionByName(none).select(F.col("key").cast(kind).alias(key), "part", F.col("length").cast("bigint").alias("length"), F.col("container").cast("bigint").alias("container"))


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, or part of one over 2,048 tokens, and its container."""
    return pack(token_counts(runtime.table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id", "tokens")


def p8_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of every document packed by its characters into containers of 50,000.

    ``documents, parts, chars`` packed; ``overfull`` containers, documents
    ``split`` though they fit, container numbers left ``unused``; and whether
    there are ``few`` containers (a hundredth more than the least possible, and one).
    """
    room = 50_000
    packed = runtime.durable(pack(runtime.table(spark, sf_dir, "documents"), "doc_id", "n_chars", room))
    held = packed.groupBy("container").agg(F.sum("length").alias("used"))
    held = held.agg(F.sum((F.col("used") > room).cast("bigint")).alias("overfull"), F.count(F.lit(1)).alias("n"), F.max("container").alias("last"), F.sum("used").alias("chars"))
    each = packed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("parts"), F.sum("length").alias("chars"))
    each = each.agg(F.count(F.lit(1)).alias("documents"), F.sum("parts").alias("parts"), F.sum(((F.col("parts") > 1) & (F.col("chars") <= room)).cast("bigint")).alias("split"))
    few = F.col("n") <= F.ceil(F.ceil(F.col("chars") / room) * 1.01) + 1
    return held.crossJoin(each).select("documents", "parts", "chars", "overfull", "split", (F.col("last") + 1 - F.col("n")).alias("unused"), few.alias("few"))
