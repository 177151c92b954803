import collections
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termloom.llm import canonical_terms, catalog, components, entity_matching, formatting_duplicates, leaks, packing, subjects, survivors


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(name, same):
    same(catalog.QUERIES[name], catalog.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_runs(name, spark, data):
    assert catalog.QUERIES[name](spark, data).count() > 0


def clash(df, *names):
    """Extra columns with names the operators use inside."""
    for n in (*names, "value", "form", "h", "id", "n", "root", "key", "rank", "term", "size", "part", "share", "word"):
        if n not in df.columns:
            df = df.withColumn(n, F.lit(1))
    return df


# 1


ROW = "row_id bigint, product_id string, a string, b string"


def sets(spark, rows, exchangeable=True):
    df = clash(spark.createDataFrame(rows, ROW))
    got = formatting_duplicates.collapse(df, ["a", "b"], ["product_id"], "row_id", exchangeable).collect()
    return sorted((r["product_id"] or "", r["row_id"], r["copies"]) for r in got)


def test_collapse_edges(spark):
    long = "x" * 300_000
    rows = [(0, "p", "A-b c", "D"), (1, "p", "d.", "ABC"), (1, "p", "d.", "ABC"), (2, "p", "Abc", None), (3, "p", "abc", " – "), (4, "p", None, None), (5, "p", "", "?!"), (6, None, "Abc", "D"), (7, "p", "é", "e"), (8, "p", long, "q"), (9, "p", long.upper(), "Q")]
    assert sets(spark, rows) == [("", 6, 1), ("p", 0, 3), ("p", 2, 2), ("p", 4, 2), ("p", 7, 1), ("p", 8, 2)]
    assert ("p", 0, 1) in sets(spark, rows, exchangeable=False)
    assert sets(spark, []) == []


def test_collapse_hot_value(spark, monkeypatch):
    from termloom import runtime

    monkeypatch.setattr(runtime, "HOT_ROWS", 5)
    rows = [(i, f"p{i % 7}", "Hot", f"n{i % 3}") for i in range(60)] + [(100, "p0", None, "x")]
    want = collections.Counter((f"p{i % 7}", i % 3) for i in range(60))
    got = sets(spark, rows)
    assert sorted(c for _, _, c in got) == sorted([*want.values(), 1])


# 3


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
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("cell", [500_000, 20])
def test_components_random(spark, monkeypatch, cell):
    monkeypatch.setattr(components, "CELL_EDGES", cell)
    rng = random.Random(cell)
    edges = [(f"v{rng.randrange(80):02d}", f"v{rng.randrange(80):02d}") for _ in range(60)]
    edges += [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(60)] + [("hub", f"x{i}") for i in range(50)] + [("self", "self")]
    df = clash(spark.createDataFrame(edges + edges[:9] + [(None, "v00"), ("v01", None)], "u string, v string"))
    assert {r["v"]: r["root"] for r in components.components(df).collect()} == brute(edges)


def test_components_empty(spark):
    assert components.components(spark.createDataFrame([], "u string, v string")).collect() == []
    only = spark.createDataFrame([("a", "a"), (None, None)], "u string, v string")
    assert [tuple(r) for r in components.components(only).collect()] == [("a", "a")]


def test_record_links_edges(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, None)], "cidx bigint, ui string")
    pairs = spark.createDataFrame([(0, 1), (1, 0), (0, 2), (0, None), (None, 1), (1, 9), (3, 0)], "i bigint, j bigint")
    got = {tuple(sorted((r["u"], r["v"]))) for r in components.record_links(pairs, rows).collect()}
    assert got == {("a", "b"), ("a", "a")}


# 4


def test_closest_edges_and_both_paths(spark):
    entries = clash(spark.createDataFrame([(1, "burning hipbone flaking"), (2, "patchy thigh dryness"), (3, "acute kyntuvolosis"), (4, "patchy thigh dryness"), (5, None), (6, "")], "ref_id bigint, ref_term string"), "entry_id", "grams")
    said = ["BURNING_hipbone flakng", "burning hipbone flaking", "dryness, patchy thigh x2 days", "possible acute kyntuvolosis", "lost in transit", "", "?!", None, "z", "k" * 100_000, "burning hipbone flaking"]
    values = spark.createDataFrame([(s,) for s in said], "term string")
    one = {r["said"]: r["entry_id"] for r in canonical_terms.closest(values, "term", entries, "ref_id", "ref_term").collect()}
    two = {r["said"]: r["entry_id"] for r in canonical_terms.closest(values, "term", entries, "ref_id", "ref_term", most=0).collect()}
    assert one == two == {"burning hipbone flakng": 1, "burning hipbone flaking": 1, "dryness patchy thigh x2 days": 2, "possible acute kyntuvolosis": 3}
    none = spark.createDataFrame([], "ref_id bigint, ref_term string")
    assert canonical_terms.closest(values, "term", none, "ref_id", "ref_term").collect() == []
    assert canonical_terms.closest(values.limit(0), "term", entries, "ref_id", "ref_term").collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abcd", min_size=1, max_size=9), min_size=1, max_size=25), st.text("abcd", min_size=1, max_size=9))
def test_index_equals_brute_force(listed, said):
    grams = lambda s: list(dict.fromkeys(s[i : i + 2] for i in range(max(1, len(s) - 1))))
    index = canonical_terms.Index(list(range(len(listed))), [grams(s) for s in listed], 0.4)
    ids, _ = index.find(grams(said))
    jaccard = lambda a, b: len(a & b) / len(a | b)
    want = {k for k, s in enumerate(listed) if jaccard(set(grams(s)), set(grams(said))) >= 0.4}
    assert set(ids.tolist()) == want


def test_remarks_are_learned_from_the_values(spark):
    """What often leaves an entry when taken off is a remark; a word of the list, or one that never leaves an entry, is none."""
    entries = spark.createDataFrame([(1, "patchy thigh dryness"), (2, "acute kyntuvolosis"), (3, "kyntuvolosis")], "ref_id bigint, ref_term string")
    said = ["possible patchy thigh dryness", "possible acute kyntuvolosis x2 days", "Possible (acute kyntuvolosis)", "patchy thigh dryness x14 days", "patchy thigh zzz", "acute kyntuvolosis", "possible", "x2 days"]
    listed = entries.select(canonical_terms.normalise(F.col("ref_term")).alias("said"))
    forms = spark.createDataFrame([(s,) for s in said], "term string").select(canonical_terms.normalise(F.col("term")).alias("said")).distinct()
    got = {(r["back"], r["remark"]) for r in canonical_terms.remarks(forms, listed).collect()}
    assert (False, "possible") in got and (True, "x0 days") in got
    assert all("acute" not in r.split() for _, r in got) and (True, "zzz") not in got
    cores = {r["said"]: r["core"] for r in canonical_terms.without_remarks(forms, listed).collect()}
    assert cores["possible acute kyntuvolosis x2 days"] == "acute kyntuvolosis" and cores["possible"] == "possible"
    assert cores["patchy thigh dryness x14 days"] == "patchy thigh dryness"


# 5


def claims(spark, rows):
    return spark.createDataFrame(rows, "e string, v string, s string")


def planted():
    rng = random.Random(1)
    rows, truth = [], set()
    for e in range(300):
        values = [f"t{e}{k}" for k in range(rng.randrange(1, 3))]
        truth |= set(values)
        for s, sens, fp in (("good", 0.95, 0.02), ("fair", 0.8, 0.1), ("bad", 0.5, 0.6)):
            said = [v for v in values if rng.random() < sens] + ([f"f{e}{s}"] if rng.random() < fp else [])
            rows += [(f"e{e}", v, s) for v in said]
    return rows, truth


def test_truths_recover_planted_quality(spark):
    rows, truth = planted()
    judged, quality = survivors.truths(claims(spark, rows + rows[:20] + [(None, "x", "good"), ("e1", None, "good"), ("e1", "x", None)]), "e", "v", "s")
    got = {r["value"]: r["is_true"] for r in judged.collect()}
    right = sum(ok == (v in truth) for v, ok in got.items())
    assert right / len(got) > 0.9
    q = {r["source"]: (r["sensitivity"], r["specificity"]) for r in quality.collect()}
    assert min(q["good"][0], q["fair"][0]) > q["bad"][0] and min(q["good"][1], q["fair"][1]) > q["bad"][1]


def test_truths_both_paths_agree(spark, monkeypatch):
    rows, _ = planted()
    one = {(r["entity"], r["value"]): r["probability"] for r in survivors.truths(claims(spark, rows[:200]), "e", "v", "s", rounds=3)[0].collect()}
    monkeypatch.setattr(survivors, "DRIVER_PATTERNS", 0)
    two = {(r["entity"], r["value"]): r["probability"] for r in survivors.truths(claims(spark, rows[:200]), "e", "v", "s", rounds=3)[0].collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-5 for k in one)
    assert survivors.truths(claims(spark, []), "e", "v", "s")[0].collect() == []


SYN = "synonyms array<struct<term:string,src:string,is_preferred:boolean>>, attributes array<struct<atr_value:string>>, updated_at timestamp_ntz"


def test_survivor_edges(spark):
    import datetime as dt

    t = dt.datetime(2020, 1, 1)
    rows = [
        ("u", 1, [("a", "b.b", True), ("A ", "x", False)], None, None),
        ("u", 2, [("a", "First Source", True), (" ", "b", True), None], [None, (" ",)], t),
        ("u", 3, None, [("v",)], None),
        ("u", 4, [], [("v",)], None),
        ("alone", 5, [("a", "b", True)], [("v",)], t),
        ("none", 6, None, None, None),
        ("none", 7, [(None, "b", True)], [(None,)], t),
        (None, 8, None, None, None),
    ]
    df = clash(spark.createDataFrame(rows, f"ui string, cidx bigint, {SYN}"), "best", "terms", "valued")
    ranks = spark.createDataFrame([("b", "Second", 2), ("a", "first source", 1)], "src string, src_name string, src_rank int")
    got = sorted((r["ui"], r["survives"], r["cidx"]) for r in survivors.survivors(df, ranks).collect())
    assert got == [("u", "attributes", 3), ("u", "preferred_term", 2), ("u", "synonyms", 2)]
    assert survivors.survivors(df.limit(0), ranks).collect() == []
    assert survivors.survivors(df, ranks.limit(0)).count() == 3


def test_terms_of_missing_sources_get_a_probability(spark, tmp_path):
    rows = [("u", [("a", "b", True), ("c", None, False)]), ("v", [("d", " ", True)]), ("w", [(" ", None, True), None])]
    spark.createDataFrame(rows, "ui string, synonyms array<struct<term:string,src:string,is_preferred:boolean>>").write.parquet(f"{tmp_path}/ingredients.parquet")
    spark.createDataFrame([("b", "Second", 2)], "src string, src_name string, src_rank int").write.parquet(f"{tmp_path}/source_rank.parquet")
    got = survivors.p5_truths(spark, str(tmp_path)).collect()
    assert sorted((r["ui"], r["term"]) for r in got) == [("u", "a"), ("u", "c"), ("v", "d")]
    assert all(r["probability"] is not None for r in got)


# 6


def names(spark, rows):
    return spark.createDataFrame(rows, "id string, side int, term string, proper boolean")


def test_matching_edges(spark):
    rows = [
        ("N1", 0, "Tunpopotella sobonkerella", True), ("N1", 0, "Dwarf gocyszokaxcress", False),
        ("N2", 0, "Tunpopotella sobonkeriana", True), ("N2", 0, "Dwarf gocyszokaxcress", False),
        ("N3", 0, "D-favexnylidin complex", True), ("N4", 0, "L-favexnylidin complex", True), ("N5", 0, "Saccharella gykixtixantha BK-261", True),
        ("D1", 1, "T. sobonkerella", None), ("D1", 1, "dwarf gocyszokaxcress 500 mg", None),
        ("D2", 1, "seed of Tunpopotella sobonkeriana", None),
        ("D3", 1, "d favexnylidin complex (std.)", None),
        ("D4", 1, "L-favexnyldin complex", None),
        ("D5", 1, "Saccharella gykixtixantha BK 262", None),
        ("D6", 1, "Tunpopotella vykonkaxosa", None), ("D6", 1, "Dwarf gocyszokaxcress", None),
        ("D7", 1, None, None), ("D8", 1, "  ", None), ("D9", 1, "extract 500 mg", None), ("D0", 1, "z" * 5000, None), (None, 1, "Tunpopotella sobonkerella", None),
    ]
    df = clash(names(spark, rows + rows[:3]), "plain", "confidence")
    got = {(r["id_1"], r["id_2"]) for r in entity_matching.match(df).collect()}
    assert got == {("N1", "D1"), ("N2", "D2"), ("N3", "D3"), ("N4", "D4")}
    assert entity_matching.match(names(spark, [])).collect() == []


def test_neighbours_cross_partitions(spark, monkeypatch):
    monkeypatch.setattr(entity_matching, "TASK_ROWS", 7)
    rows = [(f"{i:03d}", i % 2, f"k{i // 3:03d}", f"k{i // 3:03d}", "", [], [], f"k{i // 3:03d}") for i in range(60)]
    df = spark.createDataFrame(rows, "id string, side int, plain string, ordered string, marks string, ends array<string>, words array<string>, key string")
    got = {(r["a"]["id"], r["b"]["id"]) for r in entity_matching.neighbours(df, 3).collect()}
    want = {(a, b) if int(a) % 2 == 0 else (b, a) for i in range(60) for j in range(i + 1, min(60, i + 4)) for a, b in [(f"{i:03d}", f"{j:03d}")] if (i + j) % 2}
    assert got == want


def test_runs_of_equal_names_are_compared_whole(spark):
    """An identical name meets however many others share it, and a slip in the first letters of a one-word name does not part it."""
    many = [(f"D{k:03d}", 1, "Tunpopotella", None) for k in range(20)] + [(f"D{k:03d}", 1, f"{'bcdfg'[k % 5]}o{'klmn'[k // 5]}azzuvit", None) for k in range(20)]
    rows = many + [("N000", 0, "Tunpopotella", True), ("N001", 0, "Saccharogykix", True), ("D900", 1, "Zhccharogykix", None)]
    fill = [(f"D{k}", 1, f"{a}{b}qupexomiw{a}", None) for k, (a, b) in enumerate(((a, b) for a in "stuvwxyz" for b in "abcdefgh"), 1000)]
    got = {(r["id_1"], r["id_2"]) for r in entity_matching.match(names(spark, rows + fill)).collect()}
    assert got == {("N001", "D900")} | {("N000", f"D{k:03d}") for k in range(20)}


# 8


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=20))
def test_plan_places_every_item(counts):
    groups = packing.plan(counts, 50)
    back = collections.Counter()
    for lengths, n in groups:
        assert n > 0 and sum(lengths) <= 50
        for x in lengths:
            back[x] += n
    assert back == collections.Counter(counts)
    used, total = sum(n for _, n in groups), sum(k * v for k, v in counts.items())
    assert used <= 2 * (total // 50) + 1


def test_plan_uses_exact_complements():
    assert sum(n for _, n in packing.plan({30: 5, 20: 5}, 50)) == 5
    assert sum(n for _, n in packing.plan({10: 3, 20: 2, 50: 1}, 50)) == 3
    assert sum(n for _, n in packing.plan({25: 4}, 50)) == 2


def test_pack_edges(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 3)
    rows = [(k, 30) for k in range(10)] + [(k, 20) for k in range(10, 20)] + [(20, 135), (21, 0), (22, None), (23, -4), (None, 7), (0, 30)]
    df = clash(spark.createDataFrame(rows, "doc_id bigint, tokens bigint"), "length", "container", "shift")
    got = packing.pack(df, "doc_id", "tokens", 50).collect()
    assert len(got) == 26 + 2
    room = collections.Counter()
    for r in got:
        room[r["container"]] += r["length"]
    assert max(room.values()) <= 50 and sum(room.values()) == 11 * 30 + 10 * 20 + 135 + 7
    assert [r["length"] for r in sorted((r for r in got if r["doc_id"] == 20), key=lambda r: r["part"])] == [50, 50, 35]
    assert packing.pack(df.limit(0), "doc_id", "tokens").collect() == []
    assert [r["container"] for r in packing.pack(spark.createDataFrame([(1, 0)], "doc_id bigint, tokens bigint"), "doc_id", "tokens").collect()] == [0]


def test_token_counts_round_trip(spark):
    texts = ["", None, "a b", "é 漢字 <|endoftext|>", "word " * 60_000, " " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    enc = packing._encoding(packing.TOKENIZER)
    got = {r["doc_id"]: r["tokens"] for r in packing.token_counts(df, "doc_id", "text").collect()}
    for k, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert got[k] == len(ids) and enc.decode(ids) == (t or "")


# 9


def items():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bcdfglmnprstvxz") + rng.choice("aeiouy") for _ in range(3))
    stock = "read the passage below and choose the best answer"
    return [(k, f"{stock}. " + " ".join(f"which {word()} of the {word()} holds once {word()} trails {word()} by {rng.randrange(400)}." for _ in range(4))) for k in range(12)]


def test_leaks_planted(spark):
    its = items()
    rng = random.Random(5)
    fill = lambda n: " ".join(rng.choice("the old road was wide and green under a slow sky while birds sang".split()) for _ in range(n))
    whole = its[0][1]
    parts = re.split(r"(?<=\.) ", its[1][1])
    loose = " ".join(w for k, w in enumerate(its[2][1].upper().split()) if k % 11)
    half = " ".join(its[3][1].split()[9:37])
    quote = " ".join(its[4][1].split()[9:20])
    docs = [(0, f"{fill(50)} {whole} {fill(900)}"), (1, f"{parts[3]} {fill(20)} {parts[1]}<br/>{parts[4]}\n{fill(5)} {parts[2]}"), (2, f"{fill(30)} {loose} {fill(3)}"), (3, f"{fill(4)} {half} {fill(60)}"), (4, f"{fill(40)} {quote} {fill(40)}"), (5, its[5][1].split(".")[0] + fill(30)), (6, ""), (7, None), (8, fill(60_000)), (0, whole)]
    df = clash(spark.createDataFrame(docs, "doc_id bigint, text string"), "item_id")
    q = clash(spark.createDataFrame(its + [(99, None), (98, "short one")], "item_id bigint, text string"))
    got = sorted((r["doc_id"], r["item_id"]) for r in leaks.leaks(df, q).collect())
    assert got == [(0, 0), (0, 0), (1, 1), (2, 2), (3, 3)]
    assert sorted((r["doc_id"], r["item_id"]) for r in leaks.leaks(df, q, block=4).collect()) == got
    assert leaks.leaks(df.limit(0), q).collect() == [] and leaks.leaks(df, q.limit(0)).collect() == []


def test_leaks_of_items_held_several_times(spark):
    """An item under several ids, in other markup or with a slip is reported for each, and blocks change nothing."""
    its = items()
    again = [(100 + k, its[0][1]) for k in range(5)] + [(110, f"<p>{its[0][1]}</p>")] + [(120 + k, its[1][1].replace("trails", "traiks", k)) for k in range(5)]
    docs = spark.createDataFrame([(0, f"the old road {its[0][1]} was wide"), (1, its[1][1]), (2, its[2][1])], "doc_id bigint, text string")
    q = spark.createDataFrame(its + again, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["share"] for r in leaks.leaks(docs, q).collect()}
    assert set(got) == {(0, 0), (0, 110), (1, 1), (2, 2)} | {(0, 100 + k) for k in range(5)} | {(1, 120 + k) for k in range(5)}
    assert {(r["doc_id"], r["item_id"]): r["share"] for r in leaks.leaks(docs, q, block=3).collect()} == got


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=6), st.lists(st.integers(0, 4), max_size=15))
def test_nearest_is_exact(pattern, text):
    cost = np.asarray([1, 1, 2, 2, 1], dtype=np.int16)

    def distance(p, t):
        row = list(range(len(t) + 1))
        for w in p:
            new = [row[0] + int(cost[w])]
            for j, x in enumerate(t, 1):
                new.append(min(row[j - 1] + (0 if x == w else int(cost[w])), row[j] + int(cost[w]), new[j - 1] + 1))
            row = new
        return row[-1]

    want = min(distance(pattern, text[a:b]) for a in range(len(text) + 1) for b in range(a, len(text) + 1))
    got = leaks.nearest(np.asarray([pattern], dtype=np.int32), np.asarray(text, dtype=np.int32), cost)[0]
    assert got == want


def brute_share(index, k, doc):
    """The share of an item that a document carries, from every window against the whole document."""
    item = index.tokens[k]
    carried = np.zeros(len(item), dtype=bool)
    for start, row in enumerate(leaks.windows(item)):
        if row.tobytes() not in index.stock and leaks.nearest(row[None, :], doc, index.cost)[0] <= leaks.EDITS:
            carried[start : start + leaks.WINDOW] = True
    return float(carried.mean())


def test_found_items_equal_brute_force():
    """Documents with loosely worded halves of items: shares are exact, and few pairs of half an item are lost."""
    its = items()
    index = leaks.ItemIndex(its)
    rng = random.Random(11)
    hit = total = 0
    for _ in range(150):
        doc = []
        for k in rng.sample(range(len(its)), 2):
            t = index.tokens[k].tolist()
            for _ in range(rng.randrange(1, 4)):
                start = rng.randrange(len(t) - 20)
                passage = t[start : start + rng.randrange(12, 40)]
                for _ in range(len(passage) // 9):
                    passage[rng.randrange(len(passage))] = rng.choice([0, 0, t[0]])
                doc += [0] * rng.randrange(30) + passage
        doc = np.asarray(doc, dtype=np.int32)
        got = dict(index.shares(doc, index.candidates([doc])[0], leaks.SHARE))
        want = {k: brute_share(index, k, doc) for k in range(len(its))}
        want = {k: s for k, s in want.items() if s >= leaks.SHARE}
        assert all(got[k] == want[k] for k in got)
        hit, total = hit + len(got), total + len(want)
    assert total > 50 and hit / total >= leaks.TARGET_RECALL


def test_passages_do_not_cross_a_gap():
    index = leaks.ItemIndex(items())
    t = index.tokens[0]
    doc = np.concatenate([np.concatenate([t[k : k + 3], np.zeros(40, dtype=np.int32)]) for k in range(0, len(t), 3)])
    assert index.share(0, doc) == brute_share(index, 0, doc) == 0.0


def test_candidates_reach_the_target_recall():
    """Windows with one word inserted, dropped or changed meet their item at the target rate, against brute force."""
    its = items()
    index = leaks.ItemIndex(its)
    rng = random.Random(7)
    hit = total = 0
    for k, t in enumerate(index.tokens):
        for _ in range(40):
            start = rng.randrange(9, len(t) - 24)
            passage = t[start : start + 22].tolist()
            for _ in range(2):
                passage.insert(rng.randrange(len(passage)), 0)
                passage.pop(rng.randrange(len(passage)))
            total += 1
            hit += k in index.candidates([np.asarray(passage, dtype=np.int32)])[0]
    assert hit / total >= leaks.TARGET_RECALL


# 10


def corpus():
    rng = random.Random(2)
    topics = {
        "law": ("court statute tribunal clause appeal decree licence penalty".split(), "upheld revoked prohibited issued".split()),
        "sport": ("runner goalkeeper league referee squad match final coach".split(), "scored trained beat paced".split()),
        "botany": ("petal rhizome shoot leaf stem canopy seedling moss".split(), "flowered grew climbed germinated".split()),
    }
    stock = ["the question stays open", "more will be added later"]
    docs, gold = [], {}
    for k in range(240):
        mine = rng.sample(sorted(topics), rng.choice([1, 1, 2]))
        lines = []
        for t in mine:
            n, v = topics[t]
            lines += [f"the {rng.choice(n)} {rng.choice(v)} the {rng.choice(n)} {rng.choice(['after', 'before'])} a {rng.choice(n)}" for _ in range(4)]
        lines.append(rng.choice(stock))
        rng.shuffle(lines)
        docs.append((k, ". ".join(lines) + ".", "en"))
        gold[k] = set(mine)
    return docs, gold


def test_subjects_held_out(spark):
    docs, gold = corpus()
    extra = [(900, "", "en"), (901, None, None), (902, "the question stays open.", "fr"), (0, docs[0][1], "en")]
    df = clash(spark.createDataFrame(docs + extra, "doc_id bigint, text string, lang string"), "subject", "ids")
    listed = clash(spark.createDataFrame([("law", "courts and statutes"), ("sport", "teams"), ("botany", None)], "subject string, about string"))
    labels = [(k, f" {s.upper()} ") for k in range(60) for s in gold[k]] + [(61, "cooking"), (None, "law"), (62, None)]
    lab = spark.createDataFrame(labels, "doc_id bigint, subject string")
    got = collections.defaultdict(set)
    for r in subjects.assign(df, listed, lab).collect():
        got[r["doc_id"]].add(r["subject"])
    held = [k for k in gold if k >= 60]
    tp = sum(len(got[k] & gold[k]) for k in held)
    assert tp / sum(len(got[k]) for k in held) > 0.95 and tp / sum(len(gold[k]) for k in held) > 0.95
    assert not got[900] and not got[901] and not got[902]
    assert subjects.assign(df.limit(0), listed, lab).collect() == []
    assert subjects.assign(df, listed.limit(0), lab).collect() == []


SUBJECTS = [("law", "courts and statutes"), ("sport", "teams"), ("botany", None)]


def subjects_of(spark, docs, gold):
    listed = spark.createDataFrame(SUBJECTS, "subject string, about string")
    lab = spark.createDataFrame([(k, s) for k in range(60) for s in gold[k]], "doc_id bigint, subject string")
    got = collections.defaultdict(set)
    for r in subjects.assign(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), listed, lab).collect():
        got[r["doc_id"]].add(r["subject"])
    return got


def test_near_copies_keep_their_subjects(spark):
    """A page copied with other markup, date or slip is no heap of stock lines, nor are lines that differ in figures."""
    docs, gold = corpus()
    nouns, verbs = "runner goalkeeper league referee squad match final coach".split(), "scored trained beat paced".split()
    page = [f"the {nouns[k % 8]} {verbs[k % 4]} the {nouns[(k + 3) % 8]} after a {nouns[(3 * k + 1) % 8]}" for k in range(12)]
    for k in range(100):
        mine = list(page)
        mine[k % 12] = mine[k % 12].replace("after", f"aft{k}er")
        docs.append((1000 + k, f"<p>Seen on day {k}</p>\n" + (". " if k % 2 else ".<br/>\n").join(mine) + ". the question stays open.", "en"))
    docs.append((902, "the question stays open.", "en"))
    got = subjects_of(spark, docs, gold)
    assert [got[1000 + k] for k in range(100)] == [{"sport"}] * 100
    assert not got[902]
    (_, one), (_, two) = subjects.sentences("clause 5 upheld. clause 7 upheld.")
    assert subjects._signature(one) != subjects._signature(two)


def test_words_beyond_the_most_frequent_have_subjects(spark):
    """Subject words that thousands of words of stock lines outnumber still tell the subject."""
    docs, gold = corpus()
    rng = random.Random(4)
    word = lambda k: "".join("bcdfghklmnprstvz"[k // 16**j % 16] + "aeiou"[(k + j) % 5] for j in range(3))
    lines = [" ".join(word(k) for k in range(low, low + 40)) for low in range(0, 2600, 40)]
    docs += [(5000 + k, ". ".join(rng.sample(lines, 4)) + ".", "en") for k in range(650)]
    rare = "gavel writ bailiff docket plea alibi".split()
    docs += [(9000 + k, f"{' '.join(rng.sample(rare, 3))} {k}.", "en") for k in range(40)]
    listed = spark.createDataFrame([*SUBJECTS, ("crime", None)], "subject string, about string")
    lab = spark.createDataFrame([(k, s) for k in range(60) for s in gold[k]] + [(9000 + k, "crime") for k in range(20)], "doc_id bigint, subject string")
    got = subjects.assign(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), listed, lab).where("doc_id >= 9020")
    assert sorted((r["doc_id"], r["subject"]) for r in got.collect()) == [(9000 + k, "crime") for k in range(20, 40)]
