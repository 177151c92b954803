import random

import pytest
from pyspark.sql import functions as F

from termloom import model
from termloom.operators import pairs, quality, resolve
from termloom.plans import pipelines


def kb_of(spark, concepts):
    """A knowledge base of ``(cidx, ui, type, [(term, src, src_id, preferred)], [(rel, object)])``."""
    rows = []
    for cidx, ui, kind, atoms, rels in concepts:
        syn = [(t, s, i, "SY", p, None, None) for t, s, i, p in atoms]
        rows.append((cidx, ui, kind, syn, [("n", "v", "S")], [(r, o, "S", [("a", "b", "S")]) for r, o in rels]))
    kind = (
        "cidx bigint, ui string, concept_type string, synonyms array<struct<term:string,src:string,src_id:string,term_type:string,is_preferred:boolean,linked_string:string,linking_score:double>>, "
        f"attributes array<{model.ATTRIBUTE}>, relationships array<struct<rel_name:string,object:string,src:string,attributes:array<{model.ATTRIBUTE}>>>"
    )
    return model.from_records(spark.createDataFrame(rows, kind))


def test_smoke_union(spark):
    """Two concepts of three and four atoms that share two: one concept of five distinct atoms."""
    a = [("A", "S", "1", True), ("B", "S", "1", False), ("C", "S", "1", False)]
    b = [("a", "S", "1", False), ("b", "S", "1", False), ("D", "S", "2", True), ("E", "S", "3", False)]
    kb = kb_of(spark, [(0, "X0000000", "SDSI", a, []), (1, "X0000001", "SDSI", b, [])])
    merged = pipelines.resolve_kb(kb)
    assert merged.concepts.count() == 1
    assert merged.atoms.count() == 5


def brute(edges):
    parent = {}
    for a, b in edges:
        parent.setdefault(a, a)
        parent.setdefault(b, b)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = sorted((find(a), find(b)))
        parent[rb] = ra
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", range(3))
def test_components_random(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(200, 201 + i) for i in range(30)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges + edges[:5] + [(None, 3), (4, None)], "i bigint, j bigint")
    for one_task in (0, resolve.ONE_TASK_LINKS):
        assert {r["v"]: r["root"] for r in resolve.components(df, one_task).collect()} == brute(edges)


def test_components_empty(spark):
    assert resolve.components(spark.createDataFrame([], "i bigint, j bigint")).collect() == []


def replay(edges, atoms):
    parent, names = {}, {}
    for a in atoms:
        parent[a], names[a] = a, set(atoms[a])

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in sorted(edges):
        a, b = find(i), find(j)
        if a != b:
            if len(names[b]) > len(names[a]):
                a, b = b, a
            parent[b] = a
            names[a] |= names[b]
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", range(2))
def test_union_roots_replay(spark, seed):
    rng = random.Random(seed)
    concepts = [(k, f"X{k:07d}", "SDSI", [(f"t{rng.randrange(30)}", "S", "1", True) for _ in range(rng.randrange(0, 5))], []) for k in range(40)]
    edges = sorted({tuple(sorted(rng.sample(range(40), 2))) for _ in range(25)})
    kb = kb_of(spark, concepts)
    roots = resolve.union_roots(kb, spark.createDataFrame(edges + [(1, 999)], "i bigint, j bigint"))
    want = replay(edges, {c[0]: {a[0] for a in c[3]} for c in concepts})
    assert {r["cidx"]: r["root"] for r in roots.collect()} == want


def test_union_roots_closed_form(spark):
    concepts = [(k, f"X{k:07d}", "SDSI", [(f"t{k}{x}", "S", "1", True) for x in range(k)], []) for k in range(4)]
    roots = resolve.union_roots(kb_of(spark, concepts), spark.createDataFrame([(0, 1), (1, 2), (2, 3)], "i bigint, j bigint"), replay_links=1)
    assert {r["root"] for r in roots.collect()} == {3}


def test_union_roots_do_not_depend_on_links_that_merge_nothing(spark, monkeypatch):
    """A component over the limit only by links that close cycles is replayed; so is one over the former limit."""
    monkeypatch.setattr(resolve, "FOREST_LINKS", 60)
    rng = random.Random(5)
    concepts = [(k, f"X{k:07d}", "SDSI", [(f"t{rng.randrange(12)}", "S", "1", True) for _ in range(rng.randrange(1, 5))], []) for k in range(16)]
    edges = [(i, j) for i in range(16) for j in range(i + 1, 16)]
    want = replay(edges, {c[0]: {a[0] for a in c[3]} for c in concepts})
    kb = kb_of(spark, concepts)
    roots = resolve.union_roots(kb, spark.createDataFrame(edges, "i bigint, j bigint"), replay_links=15)
    assert {r["cidx"]: r["root"] for r in roots.collect()} == want
    assert resolve.REPLAY_LINKS > 10_000


def test_empty_connections_link_nothing(spark):
    kb = kb_of(spark, [(0, "X0000000", "SDSI", [("a", "S", "1", True)], []), (1, "X0000001", "SDSI", [("a", "S", "1", True)], [])])
    assert pipelines.resolve_kb(kb, spark.createDataFrame([], "i bigint, j bigint")).concepts.count() == 2


def test_intersection_and_difference_cover(spark):
    roots = spark.createDataFrame([(0, 0), (1, 0), (2, 2)], "cidx bigint, root bigint")
    both = {r["root"] for r in resolve.intersection(roots).collect()} | {r["root"] for r in resolve.difference(roots).collect()}
    assert both == {0, 2}


def test_repointing_keeps_duplicates_unless_asked(spark):
    kb = kb_of(spark, [(0, "X0000000", "SDSI", [("a", "S", "1", True)], [("r", "X0000001"), ("r", "X0000002")]), (1, "X0000001", "SS", [("b", "S", "1", True)], []), (2, "X0000002", "SS", [("c", "S", "1", True)], [])])
    roots = spark.createDataFrame([(0, 0), (1, 1), (2, 1)], "cidx bigint, root bigint")
    assert [r["object_ui"] for r in resolve.merge(kb, roots).relationships.collect()] == ["X0000001", "X0000001"]
    merged = resolve.merge(kb, roots, dedupe=True)
    assert merged.relationships.count() == 1 and merged.rel_attributes.count() == 1


def test_basic_filter_quirk(spark):
    kb = kb_of(spark, [(0, "X0000000", "SS", [("a", "S", "1", False)], []), (1, "X0000001", "SS", [("b", "S", "1", True)], [])])
    p = spark.createDataFrame([(0, 1)], "i bigint, j bigint")
    assert pairs.filter_basic(kb, p).count() == 1
    assert pairs.filter_basic(kb, p, symmetric=True).count() == 0
    assert pairs.filter_basic(kb, p, ["SS"]).count() == 0


def test_records_round_trip(spark):
    kb = kb_of(spark, [(0, "X0000000", "SDSI", [("a", "S", "1", True), ("b", "T", "2", False)], [("r", "X0000001")])])
    again = model.from_records(model.to_records(kb))
    for name in ("concepts", "attributes", "rel_attributes", "relationships"):
        assert sorted(map(tuple, getattr(kb, name).collect())) == sorted(map(tuple, getattr(again, name).collect()))
    cols = ["cidx", "pos", "term", "src", "src_id", "is_preferred"]
    assert sorted(map(tuple, kb.atoms.select(*cols).collect())) == sorted(map(tuple, again.atoms.select(*cols).collect()))


def test_remove_source_cascade(spark):
    kb = kb_of(spark, [(0, "X0000000", "SDSI", [("a", "S", "1", True)], [("r", "X0000001")]), (1, "X0000001", "SS", [("b", "GONE", "1", True)], [])])
    rels = kb.relationships.withColumn("src", F.lit("OTHER"))
    kb = model.KB(kb.concepts, kb.atoms, kb.attributes, kb.rel_attributes, rels)
    assert quality.remove_source(kb, "GONE").relationships.count() == 0
    assert quality.remove_source(kb, "GONE", cascade=False).relationships.count() == 1


def test_surrogate_ids_follow_first_appearance(spark):
    df = spark.createDataFrame([("b", 0), ("a", 1), ("b", 2), (None, 3), ("c", 4)], "name string, row_id bigint")
    assert {r["name"]: r["id"] for r in resolve.surrogate_ids(df, "name", "row_id").collect()} == {"b": "0001", "a": "0002", "c": "0003"}


def test_removed_elements_must_be_there(spark):
    table = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "cidx bigint, term string")
    gone = spark.createDataFrame([(1, None), (1, None)], "cidx bigint, term string")
    assert sorted(map(tuple, quality.remove_elements(table, gone, ["cidx", "term"]).collect())) == [(1, "a"), (2, "a")]
    absent = spark.createDataFrame([(3, "a")], "cidx bigint, term string")
    with pytest.raises(KeyError):
        quality.remove_elements(table, absent, ["cidx", "term"])
    assert quality.remove_elements(table, absent, ["cidx", "term"], strict=False).count() == 3


def test_intersection_and_difference_are_merged_concepts(spark):
    a = [("A", "S", "1", True)]
    kb = kb_of(spark, [(0, "X0000000", "SDSI", a, []), (1, "Y0000001", "SDSI", [("a", "S", "1", True), ("B", "S", "2", False)], []), (2, "X0000002", "SDSI", [("C", "S", "3", True)], [("R", "Y0000001")])])
    roots = spark.createDataFrame([(0, 0), (1, 0), (2, 2)], "cidx bigint, root bigint")
    both = resolve.intersection_kb(kb, roots)
    assert [(r["cidx"], r["ui"], r["prefix"]) for r in both.concepts.collect()] == [(0, "X0000000", "X_Y")] and both.atoms.count() == 2
    alone = resolve.difference_kb(kb, roots)
    assert [r["cidx"] for r in alone.concepts.collect()] == [2] and [r["object_ui"] for r in alone.relationships.collect()] == ["X0000000"]


def test_merge_of_a_hot_group_numbers_alike(spark, monkeypatch):
    """Places are the same whether a group is one task's or spread over many."""
    concepts = [(k, f"X{k:07d}", "SDSI", [(f"t{k}{x}", "S", str(x), True) for x in range(3)], [("R", f"X{(k + 1) % 30:07d}")]) for k in range(30)]
    kb = kb_of(spark, concepts)
    roots = spark.createDataFrame([(k, 0 if k < 20 else k) for k in range(30)], "cidx bigint, root bigint")
    tables = lambda: [sorted(map(tuple, t.drop("attrs").collect())) for t in (lambda m: (m.atoms, m.attributes, m.relationships, m.rel_attributes))(resolve.merge(kb, roots))]
    plain = tables()
    monkeypatch.setattr(resolve.runtime, "HOT_ROWS", 5)
    monkeypatch.setattr(resolve.runtime, "RANGE_ROWS", 7)
    assert tables() == plain
