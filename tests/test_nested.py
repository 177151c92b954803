import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termloom.operators import nested


def walk(value):
    """Brute force: places of objects in a list field."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return []
        return walk(value)
    if isinstance(value, dict):
        return [(0, value)] if value else []
    out = []
    for i, x in enumerate(value if isinstance(value, list) else []):
        if isinstance(x, dict):
            out += [(i, x)] if x else []
        elif isinstance(x, (list, str)):
            out += walk(x) if isinstance(x, list) else []
    return out


ITEM = st.one_of(st.none(), st.just({}), st.integers(), st.dictionaries(st.sampled_from(["term", "atr_name", "src"]), st.text(max_size=3), max_size=2))
LIST = st.one_of(st.none(), st.just(""), ITEM, st.lists(ITEM, max_size=4), st.lists(st.lists(ITEM, max_size=3), max_size=2), st.lists(ITEM, max_size=3).map(json.dumps))
REL = st.one_of(st.none(), st.fixed_dictionaries({"rel_name": st.just("r"), "attributes": LIST}))


@settings(max_examples=200, deadline=None)
@given(st.fixed_dictionaries({"ui": st.just("u"), "synonyms": LIST, "attributes": LIST, "relationships": st.lists(REL, max_size=3)}))
def test_labels_equal_brute_force(record):
    record = json.loads(json.dumps(record))
    want = []
    for kind, field in (("synonym", "synonyms"), ("attribute", "attributes"), ("relationship", "relationships")):
        for i, x in walk(record[field]):
            want.append((kind, -1, i))
            if kind == "relationship":
                want += [("rel_attribute", i, k) for k, _ in walk(x.get("attributes"))]
    nodes = list(nested.label(record))
    got = []
    for kind, depth, pre, post, pos, _ in nodes:
        up = [n for n in nodes if n[2] < pre and n[3] > post and n[1] == depth - 1]
        if depth:
            assert len(up) == 1
            got.append((kind, up[0][4] if up[0][0] == "relationship" else -1, pos))
    assert sorted(got) == sorted(want)


def test_nodes_and_parents(spark):
    good = {"ui": "A", "synonyms": [None, {"term": "x"}, {}], "relationships": {"rel_name": "r", "attributes": [[{"atr_name": "a"}, {"atr_name": "b"}]]}}
    lines = [(1, json.dumps(good)), (2, json.dumps(good) + "x"), (3, None), (4, ""), (5, "[]"), (6, "null"), (7, '{"a": NaN}'), (8, "[" * 5000), (1, json.dumps(good)), (9, json.dumps({"synonyms": [{"term": "y" * 200_000}]}))]
    df = spark.createDataFrame(lines, "line_no bigint, line string").withColumn("pos", F.lit(7)).withColumn("kind", F.lit("z"))
    got = sorted((r["rec"], r["kind"], r["parent_kind"], r["parent_pos"], r["pos"]) for r in nested.children(df.where("line_no <> 1"), "line_no", "line").collect())
    assert got == [(9, "synonym", "record", 0, 0)]
    one = df.where("line_no = 1").dropDuplicates(["line_no"])
    got = sorted((r["kind"], r["parent_kind"], r["parent_pos"], r["pos"]) for r in nested.children(one, "line_no", "line").collect())
    assert got == [("rel_attribute", "relationship", 0, 0), ("rel_attribute", "relationship", 0, 1), ("relationship", "record", 0, 0), ("synonym", "record", 0, 1)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "line_no bigint, line string")
    assert nested.children(df, "line_no", "line").collect() == []


def test_flat_tables(spark):
    line = json.dumps({"ui": "A", "concept_type": "SDSI", "synonyms": [{"term": "x", "term_type": "SN"}], "attributes": [{"atr_name": "n", "atr_value": 3}]})
    flat = nested.flat_tables(spark.createDataFrame([(1, line)], "line_no bigint, line string"), "line_no", "line")
    assert [(r["ui"], r["concept_type"]) for r in flat["record"].collect()] == [("A", "SDSI")]
    assert [(r["term"], r["parent_pre"]) for r in flat["synonym"].collect()] == [("x", 0)]
    assert [r["atr_value"] for r in flat["attribute"].collect()] == ["3"]
