"""Finding synonymous concepts and merging them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom import runtime
from termloom.model import KB

#: Components of up to this many links that merge replay the source pipeline's merge order; larger ones take the closed form.
REPLAY_LINKS = 250_000
#: Links that one task joins to components at once.
ONE_TASK_LINKS = 1_000_000
#: Links that one task looks through for those that merge; several times REPLAY_LINKS, so that each round leaves far fewer.
FOREST_LINKS = 1_000_000


def typed_terms(kb: KB, ignore_types: Sequence[str] = ()) -> DataFrame:
    """``cidx, concept_type, term_lc``: the distinct lower-case terms of every concept (types compared as written)."""
    concepts = kb.concepts.where(~F.col("concept_type").isin(list(ignore_types))) if ignore_types else kb.concepts
    return kb.atoms.select("cidx", "term_lc").join(concepts.select("cidx", "concept_type"), "cidx").distinct()


def classes(terms: DataFrame) -> DataFrame:
    """``cidx, rep``: concepts of one type with the same set of terms form a class, named by its least ``cidx``."""
    sets = terms.groupBy("cidx", "concept_type").agg(F.array_sort(F.collect_set("term_lc")).alias("terms"))
    least = sets.groupBy("concept_type", "terms").agg(F.min("cidx").alias("rep"))
    return sets.join(least, ["concept_type", "terms"]).select("cidx", "rep")


def _keyed(terms: DataFrame) -> DataFrame:
    return terms.withColumn("key", F.xxhash64("concept_type", "term_lc"))


def find_connections(terms: DataFrame) -> DataFrame:
    """``i, j``: pairs of classes (see ``classes``) of one type that share a term, i < j.

    An equi-join on (type, term) in place of a loop over all pairs. Equal
    concepts are collapsed before, so copies are not expanded into pairs; a
    concept's class is in ``classes``. A term that many classes share is spread
    over tasks. An empty table gives no rows.
    """
    reps = classes(terms)
    own = runtime.durable(_keyed(terms.join(reps.where("cidx = rep").select("cidx"), "cidx")))
    other = own.select(F.col("cidx").alias("j"), F.col("concept_type").alias("other_type"), F.col("term_lc").alias("other_term"), "key")
    pairs = runtime.lookup(own.withColumnRenamed("cidx", "i"), other, "key", F.col("i"), runtime.hot_keys(own, "key"), "inner")
    return pairs.where("i < j and term_lc = other_term and concept_type <=> other_type").select("i", "j").distinct()


def stars(terms: DataFrame) -> DataFrame:
    """``i, j``: for every (type, term) a link from its least concept to each other one: as connected as all pairs, but linear."""
    keyed = _keyed(terms)
    hubs = keyed.groupBy("key", F.col("concept_type").alias("hub_type"), F.col("term_lc").alias("hub_term")).agg(F.min("cidx").alias("i"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    met = runtime.lookup(keyed, hubs, "key", F.col("cidx"), runtime.hot_keys(keyed, "key"), "inner")
    return met.where("cidx <> i and term_lc = hub_term and concept_type <=> hub_type").select("i", F.col("cidx").alias("j")).distinct()


def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Roots of a graph that one task holds."""
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch["u"].tolist(), batch["v"].tolist()):
            a, b = _find(parent, parent.setdefault(a, a)), _find(parent, parent.setdefault(b, b))
            parent[max(a, b)] = min(a, b)
    yield pd.DataFrame({"v": pd.array(list(parent), dtype="int64"), "root": pd.array([_find(parent, x) for x in parent], dtype="int64")})


def components(edges: DataFrame, one_task: int = ONE_TASK_LINKS) -> DataFrame:
    """``v, root``: every vertex of ``edges (i, j)`` and the least vertex of its component.

    Alternating large-star and small-star steps (Kiveris et al., 2014): after
    O(log n) rounds every vertex hangs on its component's least one. Graphs of
    up to ``one_task`` links are joined in one task, with the same result.
    Edges with a null end are ignored; a vertex with only self-loops is its own
    component.
    """
    e = edges.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j")).where("i is not null and j is not null")
    ends = runtime.durable(e.select(F.greatest("i", "j").alias("u"), F.least("i", "j").alias("v")).distinct())
    loops = ends.where("u = v").select("v")
    now = ends.where("u <> v")

    def mark(d: DataFrame) -> tuple:
        r = d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    last = mark(now)
    if last[0] <= one_task:
        named = runtime.durable(now.coalesce(1).mapInPandas(_whole, "v bigint, root bigint"))
    else:
        kept = None
        while True:
            both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
            hot = runtime.hot_keys(both, "u", 2 * last[0])
            large = runtime.lookup(both, low, "u", F.col("v"), hot, "inner").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(low, "u")
            small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
            now = runtime.durable(small)
            if kept is not None:
                runtime.drop(kept)
            kept, mine = now, mark(now)
            if mine == last:
                break
            last = mine
        roots = now.select(F.col("v").alias("root")).distinct()
        named = now.select(F.col("u").alias("v"), F.col("v").alias("root")).unionByName(roots.select(F.col("root").alias("v"), "root"))
    alone = loops.join(named.select("v"), "v", "left_anti")
    return named.unionByName(alone.select("v", F.col("v").alias("root")))


def _find(parent: dict[int, int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _forest(pdf: pd.DataFrame) -> pd.DataFrame:
    """The links that join two groups when replayed in order; the others close a cycle and change nothing in any larger replay."""
    pdf = pdf.sort_values(["i", "j"])
    parent = {x: x for x in {*pdf["i"].tolist(), *pdf["j"].tolist()}}
    joins = []
    for i, j in zip(pdf["i"].tolist(), pdf["j"].tolist()):
        a, b = _find(parent, i), _find(parent, j)
        joins.append(a != b)
        parent[b] = a
    return pdf.loc[joins, ["part", "i", "j"]]


def _replay(pdf: pd.DataFrame) -> pd.DataFrame:
    """Roots of a component's concepts (rows with ``i = j`` and their ``atoms``), its links replayed in order."""
    own = pdf["i"] == pdf["j"]
    names = {x: set(a.tolist()) for x, a in zip(pdf.loc[own, "i"].tolist(), pdf.loc[own, "atoms"])}
    parent = {x: x for x in names}
    links = pdf.loc[~own, ["i", "j"]].sort_values(["i", "j"])
    for i, j in zip(links["i"].tolist(), links["j"].tolist()):
        a, b = _find(parent, i), _find(parent, j)
        if a != b:
            if len(names[b]) > len(names[a]):
                a, b = b, a
            parent[b] = a
            names[a] |= names.pop(b)
    return pd.DataFrame({"cidx": list(parent), "root": [_find(parent, x) for x in parent]})


def _sizes(links: DataFrame) -> DataFrame:
    return links.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def _merging(links: DataFrame, limit: int) -> DataFrame:
    """``part, i, j`` with the components of more than ``limit`` links cut down to the links that merge.

    A link that closes a cycle of earlier ones among any of the links never
    merges, so pieces of a component are cut down apart, round after round.
    """
    while True:
        sizes = runtime.durable(_sizes(links).where(F.col("n") > limit))
        before = sizes.agg(F.sum("n")).first()[0]
        if not before:
            return links
        big = links.join(F.broadcast(sizes), "part")  # fewer than links / limit components
        piece = F.pmod(F.xxhash64("i", "j"), F.ceil(F.col("n") / FOREST_LINKS))
        kept = runtime.durable(big.withColumn("piece", piece).groupBy("part", "piece").applyInPandas(_forest, "part bigint, i bigint, j bigint"))
        links = runtime.durable(links.join(F.broadcast(sizes), "part", "left_anti").unionByName(kept))
        if kept.count() == before:
            return links


def union_roots(kb: KB, connections: DataFrame, replay_links: int = REPLAY_LINKS) -> DataFrame:
    """``cidx, root``: every concept and the one its group merges into.

    The links of a component are replayed in order: the concept with fewer
    distinct atoms merges into the other, ties into the first. Links that close
    a cycle merge nothing and are left out where there are many. A component of
    more than ``replay_links`` links that merge is not gathered: its root is the
    concept with most distinct atoms, then the least ``cidx``. Links with an
    unknown or null end are ignored.
    """
    atom = F.xxhash64(F.concat_ws("\u0001", "term_lc", "src", "src_id", "term_type"))
    sets = kb.concepts.select("cidx").join(kb.atoms.groupBy("cidx").agg(F.collect_set(atom).alias("atoms")), "cidx", "left")
    sets = runtime.durable(sets.withColumn("atoms", F.coalesce("atoms", F.array().cast("array<bigint>"))))
    links = connections.select("i", "j").where("i <> j").distinct()
    links = links.join(sets.select(F.col("cidx").alias("i")), "i", "left_semi").join(sets.select(F.col("cidx").alias("j")), "j", "left_semi")
    links = runtime.durable(links)
    groups = runtime.durable(components(links))
    tagged = runtime.lookup(links, groups.select(F.col("v").alias("i"), F.col("root").alias("part")), "i", F.col("j"), runtime.hot_keys(links, "i"), "inner")
    tagged = _merging(runtime.durable(tagged.select("part", "i", "j")), replay_links)
    beyond = _sizes(tagged).where(F.col("n") > replay_links).select("part")
    members = groups.withColumnRenamed("root", "part").join(sets.withColumnRenamed("cidx", "v"), "v")
    rows = tagged.withColumn("atoms", F.lit(None).cast("array<bigint>")).unionByName(members.select("part", F.col("v").alias("i"), F.col("v").alias("j"), "atoms"))
    small = rows.join(beyond, "part", "left_anti").groupBy("part").applyInPandas(_replay, "cidx bigint, root bigint")
    large = members.join(beyond, "part", "left_semi").select("part", "v", F.size("atoms").alias("size"))
    best = large.groupBy("part").agg((-F.max(F.struct("size", (-F.col("v")).alias("neg"))).getField("neg")).alias("root"))
    large = large.join(best, "part").select(F.col("v").alias("cidx"), "root")
    merged = small.unionByName(large)
    alone = kb.concepts.select("cidx").join(merged.select("cidx"), "cidx", "left_anti")
    return merged.unionByName(alone.select("cidx", F.col("cidx").alias("root")))


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row, by ``order``, of every combination of ``keys`` (nulls are equal)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def _numbered(df: DataFrame, group: str, order: list[str], name: str, hot: bool) -> DataFrame:
    """``df`` with its rows numbered from 0 within ``group``; with ``hot`` groups of any size are spread over tasks."""
    if not hot:
        return df.withColumn(name, (F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1).cast("int"))
    placed = runtime.durable(runtime.positions(df, [group, *order], "__p"))
    starts = placed.groupBy(group).agg(F.min("__p").alias("__low"))
    found = runtime.lookup(placed, starts, group, F.col("__p"), runtime.hot_keys(placed, group), "inner")
    return found.withColumn(name, (F.col("__p") - F.col("__low")).cast("int")).drop("__p", "__low")


def merge(kb: KB, roots: DataFrame, dedupe: bool = False) -> KB:
    """The knowledge base with every concept's content under its root, the first of equal elements kept.

    Relationships are compared by their objects before those are re-pointed to
    roots, as the source pipeline does; ``dedupe`` compares them again after.
    Attributes of a relationship stay with the kept relationship.
    """
    r = runtime.durable(roots)
    # a merged concept's prefix joins the parts of its members' prefixes
    parts = runtime.lookup(kb.concepts.select("cidx", "prefix"), r, "cidx", F.col("cidx"), [], "inner").select("root", F.explode(F.split("prefix", "_")).alias("part")).distinct()
    joined = parts.groupBy("root").agg(F.array_join(F.array_sort(F.collect_set("part")), "_").alias("joined"))
    concepts = kb.concepts.join(joined.withColumnRenamed("root", "cidx"), "cidx", "left").join(r.where("cidx = root").select("cidx"), "cidx", "left_semi")
    concepts = concepts.select("cidx", "ui", F.coalesce("joined", "prefix").alias("prefix"), "num", "concept_type")

    def under(df: DataFrame) -> DataFrame:
        hot = runtime.hot_keys(df, "cidx")
        return runtime.lookup(df, r, "cidx", F.xxhash64(*[c for c in df.columns if c not in ("cidx", "attrs")]), hot, "inner")

    own = F.col("root") == F.col("cidx")
    atoms = first_wins(under(kb.atoms).withColumn("later", ~own), ["root", "term_lc", "src", "src_id", "term_type"], ["later", "cidx", "pos"])
    attributes = first_wins(under(kb.attributes).withColumn("later", ~own), ["root", "atr_name", "atr_value", "src"], ["later", "cidx", "pos"])
    rels = first_wins(under(kb.relationships).withColumn("later", ~own), ["root", "rel_name", "object_ui", "src"], ["later", "cidx", "ridx"])
    ids = first_wins(kb.concepts.select("ui", "cidx"), ["ui"], ["cidx"])
    target = ids.join(r, "cidx").join(ids.select(F.col("cidx").alias("root"), F.col("ui").alias("root_ui")), "root", "left").select(F.col("ui").alias("object_ui"), "root_ui")
    rels = runtime.lookup(rels, target, "object_ui", F.col("cidx"), runtime.hot_keys(rels, "object_ui")).withColumn("object_ui", F.coalesce("root_ui", "object_ui"))
    if dedupe:
        rels = first_wins(rels, ["root", "rel_name", "object_ui", "src"], ["later", "cidx", "ridx"])
    rels = runtime.durable(rels)
    kept = rels.select("cidx", "ridx", "root")
    owned = kb.rel_attributes.join(kept, ["cidx", "ridx"])
    hot = bool(runtime.hot_keys(r, "root") or runtime.hot_keys(kb.atoms, "cidx"))
    place = lambda d: _numbered(d.withColumnRenamed("pos", "old"), "root", ["later", "cidx", "old"], "pos", hot).drop("later", "cidx", "old").withColumnRenamed("root", "cidx")
    numbered = _numbered(rels, "root", ["later", "cidx", "ridx"], "new", hot)
    owned = owned.drop("root").join(numbered.select("cidx", "ridx", "root", "new"), ["cidx", "ridx"])
    return KB(
        concepts=concepts,
        atoms=place(atoms).select(*kb.atoms.columns),
        attributes=place(attributes).select(*kb.attributes.columns),
        rel_attributes=owned.select(F.col("root").alias("cidx"), F.col("new").alias("ridx"), "pos", "atr_name", "atr_value", "src"),
        relationships=numbered.select(F.col("root").alias("cidx"), F.col("new").alias("ridx"), "rel_name", "object_ui", "src"),
    )


def intersection(roots: DataFrame) -> DataFrame:
    """``root, n``: groups of two or more concepts."""
    return roots.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def difference(roots: DataFrame) -> DataFrame:
    """``root``: concepts that are alone."""
    return roots.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("root")


def _only(kb: KB, kept: DataFrame) -> KB:
    """What of a knowledge base belongs to the concepts ``cidx`` of ``kept``."""
    kept = runtime.durable(kept)
    return kb.map(lambda _, df: df.join(kept, "cidx", "left_semi"))


def intersection_kb(kb: KB, roots: DataFrame, dedupe: bool = False) -> KB:
    """The merged concepts of groups of two or more."""
    r = runtime.durable(roots)
    return _only(merge(kb, r, dedupe), intersection(r).select(F.col("root").alias("cidx")))


def difference_kb(kb: KB, roots: DataFrame) -> KB:
    """The concepts that matched no other; their relationships lead to the merged concepts."""
    r = runtime.durable(roots)
    return _only(merge(kb, r), difference(r).select(F.col("root").alias("cidx")))


def preferred_atoms(kb: KB, ranks: DataFrame) -> DataFrame:
    """Every concept's preferred atom: among preferred ones (else all) that of the best-ranked source, then the first.

    ``ranks`` is the declared list of sources (``src, src_rank``), compared
    without regard to case; unlisted sources rank last.
    """
    listed = F.broadcast(ranks.select(F.upper("src").alias("__src"), F.col("src_rank").alias("__rank")))
    atoms = kb.atoms.join(listed, F.upper(kb.atoms["src"]) == F.col("__src"), "left")
    w = Window.partitionBy("cidx").orderBy(F.desc("is_preferred"), F.coalesce("__rank", F.lit(1_000_000)), "pos")
    return atoms.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__src", "__rank")


def resolve_objects(kb: KB) -> DataFrame:
    """Relationships with the first concept (``object_cidx``) that has the object's ``ui``; null where there is none."""
    ids = first_wins(kb.concepts.select("ui", "cidx"), ["ui"], ["cidx"]).select(F.col("ui").alias("object_ui"), F.col("cidx").alias("object_cidx"))
    rels = kb.relationships
    return runtime.lookup(rels, ids, "object_ui", F.struct("cidx", "ridx"), runtime.hot_keys(rels, "object_ui"))


def surrogate_ids(df: DataFrame, name: str, order: str) -> DataFrame:
    """``<name>, id``: names numbered from 1 by first appearance, four digits at least.

    Numbers come from counts of ranges of the first appearances, so no task holds all names.
    """
    first = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(order).alias("first"))
    total = first.count()
    parts = max(1, -(-total // 200_000))
    placed = runtime.durable(first.repartitionByRange(parts, "first").withColumn("part", F.spark_partition_id()))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("start", before)
    local = F.row_number().over(Window.partitionBy("part").orderBy("first", name))
    numbered = placed.withColumn("at", local).join(F.broadcast(starts.select("part", "start")), "part")
    return numbered.select(name, F.format_string("%04d", (F.col("start") + F.col("at")).cast("bigint")).alias("id"))


def merge_by_source_id(kb: KB, preferred: DataFrame) -> DataFrame:
    """``cidx, root``: concepts whose preferred atoms share a ``src_id`` merge into the first of them."""
    ids = preferred.select("cidx", "src_id")
    roots = ids.where("src_id is not null").groupBy("src_id").agg(F.min("cidx").alias("root"))
    joined = runtime.lookup(ids, roots, "src_id", F.col("cidx"), runtime.hot_keys(ids, "src_id"))
    return joined.select("cidx", F.coalesce("root", "cidx").alias("root"))
