import json
import random

import pytest
from pyspark.sql import functions as F

from termloom import catalog, model
from termloom.functions import text
from termloom.operators import export, link, quality, resolve
from termloom.plans import pipelines
from termloom.sources import builders, converters, files, records
from termloom.streaming import lint


def test_concepts_through_files(spark, tmp_path):
    rec = {"ui": "X0000001", "concept_type": "SDSI", "synonyms": [{"term": "a", "src": "S", "is_preferred": "true", "open": "k"}], "attributes": [], "relationships": []}
    for k in (1, 2):
        (tmp_path / f"f{k}.jsonl").write_text("\n".join(json.dumps(rec | {"ui": f"X000000{k}{i}"}) for i in range(3)) + "\nbroken\n")
    rows = files.read_concepts(spark, str(tmp_path / "f2.jsonl"), str(tmp_path / "f1.jsonl"))
    got = {r["cidx"]: r["ui"] for r in rows.collect()}
    assert [got[k] for k in range(8)] == ["X00000020", "X00000021", "X00000022", None, "X00000010", "X00000011", "X00000012", None]
    kb = model.from_records(rows.where("ui is not null"))
    assert kb.atoms.select("attrs").first()[0] == {"open": "k"}
    files.write_concepts(model.to_records(kb), str(tmp_path / "out"))
    assert files.read_concepts(spark, str(tmp_path / "out")).count() == 6


def test_connections_csv(spark, tmp_path):
    files.write_connections(spark.createDataFrame([(3, 4), (1, 2)], "i bigint, j bigint"), str(tmp_path / "c"))
    assert sorted(map(tuple, files.read_connections(spark, str(tmp_path / "c")).collect())) == [(1, 2), (3, 4)]
    (tmp_path / "bad.csv").write_text("1,x\n")
    with pytest.raises(Exception):
        files.read_connections(spark, str(tmp_path / "bad.csv")).collect()


def test_annotations_and_tasks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps({"_input_hash": 1, "answer": "accept", "accept": [1], "i": 1, "j": 2}) + "\n")
    assert files.read_annotations(spark, str(tmp_path / "a.jsonl")).first()["accept"] == [1]


def test_flat_to_csv(spark, tmp_path):
    (tmp_path / "h.txt").write_text("id\nname\n")
    (tmp_path / "d.txt").write_bytes("1|café\n2|b\n".encode("latin-1"))
    files.flat_to_csv(spark, str(tmp_path / "d.txt"), str(tmp_path / "h.txt"), str(tmp_path / "o"))
    assert sorted(map(tuple, files.read_text_csv(spark, str(tmp_path / "o")).collect())) == [("1", "café"), ("2", "b")]


def test_semantic_types_by_code_and_short_form(spark, tmp_path):
    (tmp_path / "s").write_text("STY|T1|Organism|A1||||||\n".replace("||||||", "||||" + "|orgm") + "STY|T2|Plant|A2|||||plnt\n")
    got = {r["key"]: r["code"] for r in files.read_semantic_types(spark, str(tmp_path / "s")).collect()}
    assert got["plnt"] == "T2" and got["T2"] == "T2"
    assert {r["code"] for r in files.read_semantic_types(spark, str(tmp_path / "s"), ["Plant"]).collect()} == {"T2"}


def plain_repair(text, columns):
    """Brute force: one character after the other."""
    out, record, fields, quoted = [], "", 1, False
    for k, c in enumerate(text):
        if c == "\n":
            if not quoted and fields >= columns and (k + 1 == len(text) or any(x in "0123456789" for x in text[k + 1 : k + 7])):
                out.append(record)
                record, fields = "", 1
            continue
        if c == '"':
            quoted = not quoted
        if c == "," and not quoted:
            fields += 1
        if fields <= columns:
            record += c
    return [r for r in [*out, record] if r]


def repaired(spark, texts, columns, block=records.BLOCK_LINES):
    lines = [(str(p), k, x) for p, t in enumerate(texts) for k, x in enumerate(t.removesuffix("\n").split("\n")) if t]
    rows = records.repair(spark.createDataFrame(lines, "path string, pos bigint, line string"), columns, block).sort("path", "pos").collect()
    return [[r["record"] for r in rows if r["path"] == str(p)] for p in range(len(texts))]


def test_repair_of_broken_records(spark):
    good = '1,"a, b",c'
    cases = {
        f"{good}\n2,x,y\n": [good, "2,x,y"], '1,"a\nb",c\n2,x,y\n': ['1,"ab",c', "2,x,y"], "1,a\n,c\n2,x,y\n": ["1,a,c", "2,x,y"],
        "1,a,c,,\n2,x,y\n": ["1,a,c", "2,x,y"], "1,a,c\nmore text here\n2,x,y\n": ["1,a,cmore text here", "2,x,y"], "": [],
        '1,a,b,"x\n2,b,"\n3,c,d': ["1,a,b", "3,c,d"],
    }
    assert repaired(spark, list(cases), 3) == list(cases.values()) == [plain_repair(t, 3) for t in cases]
    assert repaired(spark, [], 3) == []


@pytest.mark.parametrize("block", [1, 7, 100_000])
def test_repair_equals_brute_force_whatever_the_blocks(spark, block):
    rng = random.Random(block)
    texts = ["".join(rng.choice('abcdefgh1,,"\n') for _ in range(rng.randrange(1, 120))).strip("\n") for _ in range(60)]
    texts = [t for t in texts if t]
    for columns in (1, 3):
        assert repaired(spark, texts, columns, block) == [plain_repair(t, columns) for t in texts]


def test_repair_files(spark, tmp_path):
    (tmp_path / "f.csv").write_text("1,a\n2,b\n")
    assert [r["record"] for r in records.repair_files(spark, str(tmp_path / "f.csv"), 2).sort("pos").collect()] == ["1,a", "2,b"]


def test_ini_refers():
    settings = ("[1.0]\nsources =\n    UMLS\n    NMCD\n[1.1]\nrefer_to = 1.0\n[a]\nrefer_to = b\n[b]\nrefer_to = a\n")
    assert files.source_ranks(settings, "1.1")["sources"] == ["UMLS", "NMCD"]
    with pytest.raises(ValueError):
        files.source_ranks(settings, "a")


def test_schema_parser(spark):
    schema = files.parse_schema('CREATE (a:SDSI {preferred_name: "", links_to: "x.y"})\nCREATE (b:SS {preferred_name: ""})\nCREATE (a)-[:HAS {rating: ""}]->(b)\n')
    assert schema == {"nodes": {"SDSI": {"preferred_name": "", "links_to": "x.y"}, "SS": {"preferred_name": ""}}, "edges": {"HAS": {"rating": ""}}}
    labels, props, edges = files.schema_tables(spark, schema)
    assert labels.where("links_to = 'x.y'").count() == 1 and edges.count() == 2 and props.count() == 3


def test_linker_settings_use_the_registry():
    got = files.linker_settings('{"t": {"class_name": "captured", "min_score": 700}}', link.REGISTRY)
    assert got["t"][0](None, **got["t"][1]).min_score == 700
    with pytest.raises(KeyError):
        files.linker_settings('{"t": {"class_name": "os"}}', link.REGISTRY)


def test_polymorphic_lists(spark):
    df = spark.createDataFrame([('["a","b"]',), ('"a"',), ('""',), (None,)], "c string")
    assert [r[0] for r in df.select(files.as_list(F.col("c"))).collect()] == [["a", "b"], ["a"], [], []]


@pytest.mark.parametrize("name, bad", [("", True), (None, True), (" ", True), ("a", True), ("8", True), ("1.5", True), ("...", True), (" ", True), ("ab", False), ("B12", False), (" x1 ", False)])
def test_invalid_names(spark, name, bad):
    assert spark.createDataFrame([(name,)], "n string").select(text.invalid_name(F.col("n"))).first()[0] is bad


def test_registry_chain(spark):
    """Rows of one ingredient id become one concept; names are kept where they first stand."""
    kind = "row_id bigint, ingredient_id string, product_id string, proper_name string, proper_name_f string, common_name string, common_name_f string, source_material string, source_material_f string"
    rows = [(0, "0001.0", "p", "Aa  bb", "Aa f", "cc", None, "root", None), (1, "0001", "q", "Aa bb", "Aa f", "dd", None, None, "racine"), (2, "0002", "p", "8", None, None, None, None, None), (3, "0003", "p", None, None, "x", None, None, None)]
    df = spark.createDataFrame(rows, kind)
    assert sorted((r["row_id"], r["term"]) for r in converters.registry_atoms(df).collect()) == [(0, "Aa bb"), (0, "Aa f"), (0, "cc"), (1, "Aa bb"), (1, "dd")]
    assert [(r["src_id"], r["n_atoms"], r["n_rows"]) for r in converters.registry_concepts(df).collect()] == [("0001", 4, 2)]
    assert sorted((r["row_id"], r["atr_value"]) for r in converters.registry_attributes(df).collect()) == [(0, "root"), (1, "racine")]
    edges, unknown = converters.connect_products(df, spark.createDataFrame([("p.0", "P"), ("q", None)], "product_id string, product_name string"))
    assert [tuple(r) for r in edges.select("ingredient_id", "product_id").collect()] == [("0001", "p")]
    assert [tuple(r) for r in unknown.collect()] == [("q", 1)]


def test_label_products(spark):
    p = spark.createDataFrame([("1", [(7,), (8,)])], "DSLD_ID string, ingredients array<struct<Ingredient_Group_GRP_ID:int>>")
    edges, unknown = converters.label_products(p, spark.createDataFrame([("7",)], "group_id string"))
    assert [tuple(r) for r in edges.select("product_id", "group_id").collect()] == [("1", "7")] and unknown.count() == 1


def test_herb_pages(spark):
    line = json.dumps({"herb_name": "H", "common_name": ["a, b", "c"], "scientific_name": "s; t", "purported_uses": "Pain/ache\nGeneral\nDose 5 mg/ml", "warnings": "", "herb-drug_interactions": ["Drug (x): text", "None known."]})
    got = {(r["role"], r["name"], r["value"]) for r in converters.herb_pages(spark.createDataFrame([(1, line), (2, "broken"), (3, None)], "page int, line string")).collect()}
    assert {("atom", "CN", v) for v in "abc"} <= got and ("edge", "interacts_with", "Drug") in got
    assert {v for r, n, v in got if n == "is_effective_for"} == {"Pain", "ache", "Dose 5 mg/ml"}


def test_builders_of_small_sources(spark):
    """Registry rows of one id become one concept with edges both ways; denied label groups go; herbs come with what they name."""
    kind = "row_id bigint, ingredient_id string, product_id string, proper_name string, proper_name_f string, common_name string, common_name_f string, source_material string, source_material_f string"
    rows = [(0, "7.0", "p.0", "Aa  bb", None, "cc", None, None, "racine"), (1, "7", "q", "AA bb", None, "dd", None, "leaf", None), (2, "3", "p", "Zz", None, None, None, None, None), (3, "4", "p", "9", None, None, None, None, None), (4, None, "r", "Yy", "", None, None, None, None)]
    kb = builders.registry_kb(spark.createDataFrame(rows, kind), spark.createDataFrame([("p", "P one"), ("p.0", "P two"), ("q", None)], "product_id string, product_name string"))
    got = {r["ui"]: (r["concept_type"], r["synonyms"], r["attributes"], r["relationships"]) for r in builders.flat_records(kb).collect()}
    assert got == {
        "NHPID0000001": ("SDSI", "Aa bb|NHPID|7|SN|true; cc|NHPID|7|SY|false; dd|NHPID|7|SY|false", "source_material|racine|NHPID", "ingredient_of|NHPID0000004|NHPID"),
        "NHPID0000002": ("SDSI", "Zz|NHPID|3|SN|true", None, "ingredient_of|NHPID0000004|NHPID"),
        "NHPID0000003": ("SDSI", "Yy|NHPID||SN|true", None, None),
        "NHPID0000004": ("DSP", "P one|NHPID|p|SY|true; P two|NHPID|p|SY|true", None, "has_ingredient|NHPID0000001|NHPID; has_ingredient|NHPID0000002|NHPID"),
    }
    assert model.to_records(kb).count() == 4
    groups = spark.createDataFrame([(1, "Acai", " botanical ", '"Acai, acai (euterpe oleracea)  juice;ACAI"'), (2, "Header", "x", "y"), (3, None, "x", "y"), (4, "Empty", "x", "5 mg")], "group_id bigint, group_name string, category string, synonyms string")
    sold = spark.createDataFrame([("S", "9", "Kind", [("1",), ("2",), ("1",)]), (None, "8", "", None)], "Product_Name string, DSLD_ID string, LanguaL_Product_Type string, ingredients array<struct<Ingredient_Group_GRP_ID:string>>")
    got = [tuple(r) for r in builders.flat_records(builders.label_kb(groups, sold)).sort("ui").collect()]
    assert got == [
        ("DSLD0000001", "SDSI", "Acai|DSLD|1|SY|true; Acai, acai|DSLD|1|SY|false; euterpe oleracea|DSLD|1|SY|false", "ingredient_category|botanical|DSLD", None),
        ("DSLD0000002", "DSP", "S|DSLD|9|SY|true", "langual_type|Kind|DSLD", "has_ingredient|DSLD0000001|DSLD"),
    ]
    page = json.dumps({"herb_name": "H", "common_name": ["a, b", "A"], "clinical_summary": ["x", "General", "y"], "purported_uses": "Pain/ache", "adverse_reactions": "", "herb-drug_interactions": ["Drug (x): text"]})
    got = [tuple(r) for r in builders.flat_records(builders.herb_kb(spark.createDataFrame([(1, page), (2, "broken"), (3, None), (None, page)], "page int, line string"))).sort("ui").collect()]
    assert [(u, t, s) for u, t, s, _, _ in got] == [("MSKCC0000001", "DIS", "Pain|MSKCC|0|SY|false"), ("MSKCC0000002", "DIS", "ache|MSKCC|0|SY|false"), ("MSKCC0000003", "PD", "Drug|MSKCC|0|SY|false"), ("MSKCC0000004", "SDSI", "H|MSKCC|0|SY|true; a|MSKCC|0|CN|false; b|MSKCC|0|CN|false")]
    assert got[3][3:] == ("background|x y|MSKCC", "is_effective_for|MSKCC0000001|MSKCC; is_effective_for|MSKCC0000002|MSKCC; interacts_with|MSKCC0000003|MSKCC")
    none = builders.registry_kb(spark.createDataFrame([], kind), spark.createDataFrame([], "product_id string, product_name string"))
    assert none.concepts.collect() == []


def test_html_sections(spark):
    page = '<h3 data-listname="Purported Uses">Purported Uses</h3><div><ul class="x bullet-list"><li>a &amp; b</li><li> <b>c</b></li></ul></div><h3 data-listname="Warnings"> Warnings</h3><p>No <i>use</i>.</p>'
    got = {(r["k"], r["header"]): (r["bullets"], r["body"]) for r in converters.html_sections(spark.createDataFrame([(1, page), (2, None)], "k int, html string"), "k").collect()}
    assert got[1, "purported_uses"] == (["a & b", "c"], None) and got[1, "warnings"] == (None, "No use.")
    assert got[1, "food_sources"] == (None, "") and got[2, "warnings"] == (None, "") and len(got) == 16


def test_crawl_and_captured(spark):
    pages = spark.createDataFrame([(1, '<a class="x" href="/h/1">A  b</a><a href="http://o/2">A b</a>')], "page_id bigint, html string")
    assert [tuple(r) for r in converters.crawl(pages, "http://s").collect()] == [("A b", "http://s/h/1")]
    answers = spark.createDataFrame([(1, 200, "x"), (2, 404, ""), (3, 200, "y")], "id bigint, status int, body string")
    assert [r["id"] for r in converters.captured_labels(answers).collect()] == [1]


def captured():
    cand = lambda n, s, t: {"CandidatePreferred": n, "CandidateCUI": f"C{n}", "CandidateScore": s, "SemTypes": t}
    phrases = [{"PhraseText": "p", "Mappings": [{"MappingCandidates": [cand("1", "-900", ["x"]), cand("2", "-950", ["y"])]}, {"MappingCandidates": [cand("3", "-700", ["y"])]}]}]
    return json.dumps({"AllDocuments": [{"Document": {"Utterances": [{"PMID": "7", "Phrases": phrases}]}}]})


def test_captured_linker(spark):
    q = spark.createDataFrame([("7", "p"), ("8", "q")], "id string, text string")
    outputs = spark.createDataFrame([(captured(),), ("broken",), (None,)], "json string")
    linker = link.CapturedLinker(outputs, min_score=800)
    assert [(r["code"], r["score"]) for r in linker.best(linker.link(q)).collect()] == [("C2", 950.0)]
    assert {r["code"] for r in link.CapturedLinker(outputs, semtypes=["x"]).link(q).collect()} == {"C1"}
    assert linker.link(q.where("id = '8'")).collect() == []


def test_route_gives_every_linker_its_queries(spark):
    """The rule linker's three queries, and captured answers, side by side."""
    queries = [("1", "Renal", "rules"), ("2", "Cardiovascular", "rules"), ("3", "genitourinary", "rules"), ("7", "p", "mapper"), ("9", "blood electrolytes", "notes"), ("5", "x", "unknown")]
    answers = [("9", "blood", 0, "Blood", "MEDDRA", "A1"), ("9", "blood", 1, "Blood cell", "MEDDRA", "A2"), ("9", "electrolytes", 2, "Electrolyte", "MEDDRA", "A3"), ("8", "y", 0, "Y", "MEDDRA", "A4")]
    linkers = {
        "rules": link.RuleLinker(),
        "mapper": link.CapturedLinker(spark.createDataFrame([(captured(),)], "json string")),
        "notes": link.AnnotatorLinker(spark.createDataFrame(answers, "id string, matched string, pos int, term string, src string, code string")),
        "dictionary": link.DictionaryLinker(spark.createDataFrame([("a", "", "C", ["x"])], "term string, preferred string, code string, semtypes array<string>")),
    }
    got = link.route(spark.createDataFrame(queries, "id string, text string, terminology string"), linkers)
    assert sorted((r["id"], r["matched"], r["code"]) for r in got.collect()) == [
        ("1", "renal", "10038359"), ("2", "cardio", "10007541"), ("2", "vascular", "10047065"), ("3", "genito", "10038604"), ("3", "urinary", "10038359"),
        ("7", "p", "C2"), ("9", "blood", "A1"), ("9", "electrolytes", "A3"),
    ]


def test_dictionary_linker(spark):
    entries = spark.createDataFrame([("ginkgo biloba", "", "C1", ["x"]), ("biloba", "", "C2", ["x"]), ("headache", "Headache", "C3", ["y"])], "term string, preferred string, code string, semtypes array<string>")
    q = spark.createDataFrame([("1", "Ginkgo biloba (dry) for HEADACHE"), ("2", ""), ("3", None)], "id string, text string")
    linker = link.DictionaryLinker(entries)
    got = sorted((r["id"], r["matched"], r["code"]) for r in linker.best(linker.link(q)).collect())
    assert got == [("1", "Ginkgo biloba", "C1"), ("1", "HEADACHE", "C3")]
    scores = {r["code"]: r["score"] for r in linker.link(q).collect()}
    assert scores == {"C1": 1.0, "C3": 1.0}
    near = link.DictionaryLinker(entries).link(spark.createDataFrame([("1", "ginkgo bilobas")], "id string, text string"))
    assert [(r["code"], round(r["score"], 3)) for r in near.collect()] == [("C1", 0.722)]


def test_link_pipeline(spark, data):
    kb = model.load(spark, data)
    ranks = spark.createDataFrame([("NMCD", 1)], "src string, src_rank int")
    labels = catalog._labels(spark)[0]
    out = pipelines.link_kb(kb, ranks, labels, {"umls.dictionary": catalog._dictionary(spark, data)})
    assert out.concepts.groupBy("ui").count().where("count > 1").count() <= kb.concepts.groupBy("ui").count().where("count > 1").count()
    assert out.atoms.where("linking_score is not null and term_type = 'SY' and src = 'UMLS'").count() > 0


def test_publish(spark, data, tmp_path):
    kb = model.load(spark, data)
    pipelines.publish(kb, spark.createDataFrame([("NMCD", 1)], "src string, src_rank int"), str(tmp_path / "k"))
    again = files.read_rrf(spark, str(tmp_path / "k/MRSTY.RRF"), ["CUI", "STY"], header=True)
    assert again.count() == kb.concepts.count() == again.select("CUI").distinct().count()
    export.write_rrf({"MRSTY": again}, str(tmp_path / "crlf"), "\r\n")


def test_version_folder(spark, tmp_path):
    folder = str(tmp_path / "v")
    with pytest.raises(FileNotFoundError):
        pipelines.load_kb(spark, folder)
    pipelines.make_version(spark, folder, "1.0")
    (tmp_path / "v/concepts").mkdir()
    (tmp_path / "v/concepts/concepts_merged.jsonl").write_text(json.dumps({"ui": "X0000001", "concept_type": "SDSI", "synonyms": [{"term": "a"}]}) + "\n")
    kb, known = pipelines.load_kb(spark, folder)
    assert kb.atoms.count() == 1 and known == {}
    pipelines.make_version(spark, folder, "1.0", "[1.0]\nsources =\n    A\n")
    assert pipelines.load_kb(spark, folder)[1] == {"sources": ["A"]}
    (tmp_path / "v/release").mkdir()
    assert pipelines.release(str(tmp_path / "v"), str(tmp_path / "z")).endswith(".zip")


def test_preferred_atom_by_rank(spark):
    rows = [(0, "X0000000", "SDSI", [("a", "B", "1", "SY", True, None, None), ("b", "a", "1", "SY", True, None, None), ("c", "a", "1", "SY", False, None, None)], None, None)]
    kind = f"cidx bigint, ui string, concept_type string, synonyms array<struct<term:string,src:string,src_id:string,term_type:string,is_preferred:boolean,linked_string:string,linking_score:double>>, attributes array<{model.ATTRIBUTE}>, relationships array<struct<rel_name:string,object:string,src:string,attributes:array<{model.ATTRIBUTE}>>>"
    kb = model.from_records(spark.createDataFrame(rows, kind))
    ranks = spark.createDataFrame([("A", 1), ("B", 2)], "src string, src_rank int")
    assert resolve.preferred_atoms(kb, ranks).first()["term"] == "b"


def test_statistics_are_the_biased_forms(spark):
    got = quality.statistics(spark.createDataFrame([(x,) for x in (1, 2, 2, 9)], "n int"), "n").first()
    assert round(got["skew"], 6) == round(36 / 10.25**1.5, 6) and got["least"] == 1


def test_stream_lint(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text('{"a": 1}\nbroken\n[]\n')
    q = lint.broken_lines(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("broken").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["line"] for r in spark.table("broken").collect()) == ["[]", "broken"]
