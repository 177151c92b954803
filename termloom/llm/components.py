"""Problem 3: consolidating pairwise matches into groups.

Method: two-dimensional grid. Vertices are hashed into blocks; every edge goes
to the partition of its block pair; each partition runs a local union-find and
sends back, for each of its vertices, the local root. Row and column partitions
of a vertex exchange these representatives (the least wins), edges are
rewritten by them, and rounds go on until no edge is left between different
representatives.

A hub's edges spread over a whole row of the grid, and a cell that still holds too
many is cut into pieces of edges, which send their offers apart. Representatives are compared
by a hash salted with the round, so that long sorted chains also shrink by a
constant factor each round: O(log n) rounds.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import runtime

#: Edges that one block pair should hold, on average, and that a piece of it holds at most, about.
CELL_EDGES = 500_000


def _local_roots(n: int, u: np.ndarray, v: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Union-find over ``n`` vertices; the root of a set is its vertex of least ``rank``."""
    parent = list(range(n))
    rank = rank.tolist()
    for a, b in zip(u.tolist(), v.tolist()):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if a != b:
            if rank[b] < rank[a]:
                a, b = b, a
            parent[b] = a
    for i in range(n):
        r = i
        while parent[r] != r:
            r = parent[r]
        while parent[i] != r:
            parent[i], i = r, parent[i]
    return np.asarray(parent)


def _cell(pdf: pd.DataFrame) -> pd.DataFrame:
    both = pd.concat([pdf[["u", "hu"]].set_axis(["v", "h"], axis=1), pdf[["v", "hv"]].set_axis(["v", "h"], axis=1)])
    code, names = pd.factorize(both["v"])
    n, m = len(names), len(pdf)
    h = np.zeros(n, dtype=np.int64)
    h[code] = both["h"].to_numpy()
    order = pd.DataFrame({"h": h, "v": names}).sort_values(["h", "v"]).index.to_numpy()
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    root = _local_roots(n, code[:m], code[m:], rank)
    return pd.DataFrame({"v": names, "root": np.asarray(names)[root], "h": h[root]})


def _one_round(edges: DataFrame, blocks: int, turn: int) -> DataFrame:
    """``v, root``: for every vertex of ``edges`` the best representative its row and column partitions offer."""
    kind = dict(edges.dtypes)["u"]
    h = lambda c: F.xxhash64(F.lit(turn), F.col(c))
    block = lambda c: F.pmod(F.col(c), F.lit(blocks))
    cells = edges.withColumn("hu", h("u")).withColumn("hv", h("v")).withColumn("bu", block("hu")).withColumn("bv", block("hv"))
    cells = cells.withColumn("cell", F.least("bu", "bv") * blocks + F.greatest("bu", "bv")).select("u", "v", "hu", "hv", "cell")
    if blocks > 1:
        # at most edges / CELL_EDGES cells are over size
        over = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL_EDGES).select("cell", F.ceil(F.col("n") / CELL_EDGES).alias("pieces"))
        cells = cells.join(F.broadcast(over), "cell", "left").withColumn("piece", F.coalesce(F.pmod(F.xxhash64("u", "v"), F.col("pieces")), F.lit(0))).drop("pieces")
    else:
        cells = cells.withColumn("piece", F.lit(0).cast("bigint"))
    offers = cells.groupBy("cell", "piece").applyInPandas(_cell, f"v {kind}, root {kind}, h bigint")
    return offers.groupBy("v").agg(F.min(F.struct("h", "root")).getField("root").alias("root"))


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``v, root``: every vertex of ``edges`` and the least vertex of its component.

    Edges are undirected. Repeated and turned-round edges and self-loops change
    nothing (a vertex with only a self-loop is its own component); an edge with
    a null end is ignored; an empty table gives no rows.
    """
    ends = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null")
    ends = runtime.durable(ends.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    loops = ends.where("u = v").select(F.col("u").alias("v"))
    left = ends.where("u <> v")
    count = left.count()
    maps: list[DataFrame] = []
    turn = 0
    while count:
        blocks = max(1, math.ceil(math.sqrt(count / CELL_EDGES)))
        step = runtime.durable(_one_round(left, blocks, turn))
        maps.append(step)
        if blocks == 1:  # one cell held all edges, so its roots are final
            break
        hot = runtime.hot_keys(left, "u", count)
        moved = runtime.lookup(left, step.select(F.col("v").alias("u"), F.col("root").alias("ru")), "u", F.col("v"), hot, "inner").select("ru", "v")
        hot = runtime.hot_keys(moved, "v", count)
        moved = runtime.lookup(moved, step.select("v", F.col("root").alias("rv")), "v", F.col("ru"), hot, "inner")
        last, left = left, runtime.durable(moved.where("ru <> rv").select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct())
        if turn:
            runtime.drop(last)
        count = left.count()
        turn += 1
    if not maps:
        return loops.distinct().select("v", F.col("v").alias("root"))
    labels = maps[0].withColumnRenamed("root", "r")
    for step in maps[1:]:
        hot = runtime.hot_keys(labels, "r")
        labels = runtime.lookup(labels, step.select(F.col("v").alias("r"), "root"), "r", F.col("v"), hot)
        labels = runtime.durable(labels.select("v", F.coalesce("root", "r").alias("r")))
    least = labels.groupBy("r").agg(F.min("v").alias("root"))
    named = runtime.lookup(labels, least, "r", F.col("v"), runtime.hot_keys(labels, "r"), "inner").select("v", "root")
    alone = loops.join(maps[0].select("v"), "v", "left_anti").distinct()
    return named.unionByName(alone.select("v", F.col("v").alias("root")))


def record_links(connections: DataFrame, rows: DataFrame) -> DataFrame:
    """``u, v``: the ``ui`` at both ends of every connection whose ends are rows (``cidx``) of ``rows``."""
    names = rows.select("cidx", "ui").where("cidx is not null and ui is not null")
    links = connections.select("i", "j").where("i is not null and j is not null").distinct()
    for end, name in (("i", "u"), ("j", "v")):
        hot = runtime.hot_keys(links, end)
        spread = F.col("j" if end == "i" else "u")
        links = runtime.lookup(links, names.select(F.col("cidx").alias(end), F.col("ui").alias(name)), end, spread, hot, "inner").drop(end)
    return links.distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = record_links(runtime.table(spark, sf_dir, "connections"), runtime.table(spark, sf_dir, "ingredients"))
    groups = components(links.where("u <> v"))
    return groups.select(F.col("v").alias("ui"), F.col("root").alias("group_ui"))
