"""Queries that go through files: each writes its input in an exchange format to the shared folder and reads it back."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import model, runtime
from termloom.functions import text
from termloom.operators import export, link, pairs, quality, resolve
from termloom.oracle import _IDS, _KB, _LINT, _PAIRS, _PREF, _SCHEMA, _clean, _with
from termloom.plans import pipelines
from termloom.sources import converters, files, records

# Settings, a schema, linker settings, semantic types and filter words in their file formats.
INI = "[1.0]\nsources =\n    UMLS\n    MEDDRA\n    NMCD\nterm_types =\n    SN\n    CN\n[1.1]\nrefer_to = 1.0\n"
DDL = 'CREATE (a:SDSI {preferred_name: "", links_to: "umls.dictionary"})\nCREATE (b:SS {preferred_name: ""})\nCREATE (a)-[:HAS_ADVERSE_REACTION {rating: ""}]->(b)\n'
LINKERS = '{"umls.dictionary": {"class_name": "dictionary", "threshold": 0.8}, "meddra.rules": {"class_name": "rules"}}'
SEMANTIC_TYPES = "STY|T121|Pharmacologic Substance|A1.4.1.1.1|||||phsu\nSTY|T184|Sign or Symptom|A2.2.2|||||sosy\nSTY|T047|Disease or Syndrome|B2.2.1.2.1|||||dsyn\n"
FILTER_WORDS = "powder\n extract \n\nroot\n"


def _kb(spark: SparkSession, d: str) -> model.KB:
    return model.load(spark, d)


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    c = runtime.table(spark, d, "connections")
    return c.where("i is not null and j is not null and i <> j").select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct()


def _written(spark: SparkSession, write: Callable[[str], None]) -> str:
    path = runtime.scratch(spark)
    write(path)
    return path


def _small(spark: SparkSession, text: str) -> str:
    return _written(spark, lambda p: runtime.write_small(spark, p, text))


def _flat_atoms(rows: DataFrame) -> DataFrame:
    atoms = model.from_records(rows).atoms
    return atoms.select("cidx", "pos", "term", "src", "src_id", "term_type", "is_preferred", F.round("linking_score", 6).alias("linking_score"), F.try_element_at("attrs", F.lit("linked_string")).alias("linked_string"))


def file_concepts(spark: SparkSession, d: str) -> DataFrame:
    path = _written(spark, lambda p: files.write_concepts(model.to_records(_kb(spark, d)), p))
    return _flat_atoms(files.read_concepts(spark, path))


def file_concepts_joined(spark: SparkSession, d: str) -> DataFrame:
    """Two files, the odd concepts first, numbered through."""
    whole = runtime.durable(model.to_records(_kb(spark, d)))
    odd, even = (_written(spark, lambda p, k=k: files.write_concepts(whole.where(F.col("cidx") % 2 == k), p)) for k in (1, 0))
    return files.read_concepts(spark, odd, even).select("cidx", "ui", "concept_type")


def file_broken_concepts(spark: SparkSession, d: str) -> DataFrame:
    """Raw lines as a file: which are a record at all."""
    lines = runtime.table(spark, d, "ingredients_jsonl").where("line is not null and not line rlike '[\\\\r\\\\n]' and line <> ''")
    path = _written(spark, lambda p: lines.sort("line_no").select("line").write.text(p))
    return quality.lint_lines(files.numbered_lines(spark, path), "cidx", "line")


def file_connections(spark: SparkSession, d: str) -> DataFrame:
    return files.read_connections(spark, _written(spark, lambda p: files.write_connections(_pairs(spark, d), p)))


def _judgements(spark: SparkSession, d: str) -> DataFrame:
    """Judgements made of the pairs themselves: every third judged, every second of those equal."""
    judged = _pairs(spark, d).where("(i + j) % 3 = 0")
    return judged.select(F.lit(1).cast("bigint").alias("_input_hash"), F.lit("accept").alias("answer"), F.when(F.expr("(i + j) % 2 = 0"), F.array(F.lit(1))).otherwise(F.array(F.lit(2))).alias("accept"), "i", "j")


def file_annotations(spark: SparkSession, d: str) -> DataFrame:
    path = _written(spark, lambda p: files.write_annotation_tasks(_judgements(spark, d), p))
    return pairs.filter_annotated(_pairs(spark, d), files.read_annotations(spark, path))


def file_annotation_stream(spark: SparkSession, d: str) -> DataFrame:
    kb = _kb(spark, d)
    tasks = pairs.annotation_tasks(kb, _pairs(spark, d), resolve.preferred_atoms(kb, _ranks(spark, d)))
    path = _written(spark, lambda p: files.write_annotation_tasks(pairs.annotation_stream(tasks, "<b>{{term}}</b>"), p))
    back = spark.read.schema("_input_hash bigint, _task_hash bigint, html string, i bigint, j bigint, ing_i struct<term:string>, ing_j struct<term:string>, matched_on array<string>, options array<struct<id:int,text:string>>").json(path)
    options = F.array_join(F.transform("options", lambda o: F.concat_ws("=", o["id"], o["text"])), ",")
    return back.select("_input_hash", "_task_hash", "html", "i", "j", F.col("ing_i.term").alias("term_i"), F.col("ing_j.term").alias("term_j"), F.array_join("matched_on", "|").alias("matched_on"), options.alias("options"))


def _ranks(spark: SparkSession, d: str) -> DataFrame:
    return runtime.table(spark, d, "source_rank").select("src", "src_rank")


def file_keyed_rrf(spark: SparkSession, d: str) -> DataFrame:
    rows = runtime.table(spark, d, "reference_terms").select(F.format_string("C%07d", "ref_id"), "ref_term", "concept_type")
    path = _written(spark, lambda p: rows.write.option("sep", "|").csv(p))
    kept = files.read_rrf(spark, path, ["cui", "name", "kind"])
    return kept.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min("cui").alias("first_cui"), F.max("name").alias("last_name"))


def file_semantic_types(spark: SparkSession, d: str) -> DataFrame:
    return files.read_semantic_types(spark, _small(spark, SEMANTIC_TYPES), ["Sign or Symptom", "Disease or Syndrome"])


def file_rrf_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Statistics from the published name and type files."""
    kb = _kb(spark, d)
    tables = export.rrf(kb, runtime.durable(export.concept_ids(kb)))
    path = _written(spark, lambda p: export.write_rrf({k: tables[k] for k in ("MRCONSO", "MRSTY")}, p))
    conso, sty = (files.read_rrf(spark, f"{path}/{k}.RRF", tables[k].columns, header=True) for k in ("MRCONSO", "MRSTY"))
    return quality.published_statistics(conso, sty)


def file_flat(spark: SparkSession, d: str) -> DataFrame:
    """A pipe-delimited Latin-1 file and its header file as one UTF-8 CSV."""
    rows = runtime.table(spark, d, "nhp_medicinal_ingredients").select(F.col("row_id").cast("string"), "source_material", "source_material_f")
    flat = _written(spark, lambda p: rows.write.options(**files.KEEP_BLANKS).option("sep", "|").option("encoding", "ISO-8859-1").option("escape", '"').csv(p))
    out = runtime.scratch(spark)
    files.flat_to_csv(spark, flat, _small(spark, "\n".join(rows.columns)), out)
    return files.read_text_csv(spark, out)


def file_text_csv(spark: SparkSession, d: str) -> DataFrame:
    rows = runtime.table(spark, d, "nhp_medicinal_ingredients").select("row_id", "ingredient_id", "proper_name", "common_name", "potency_amount", "quantity")
    path = _written(spark, lambda p: rows.write.options(**files.KEEP_BLANKS).option("header", True).option("escape", '"').csv(p))
    # whole-number text stays text
    return files.read_text_csv(spark, path).select(F.col("row_id").cast("bigint").alias("row_id"), *[F.nullif(text.squeeze(F.col(c)), F.lit("")).alias(c) for c in rows.columns[1:]])


def file_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Registry rows whose names were broken over lines and that carry surplus fields, put together again."""
    clean = F.regexp_replace(F.col("proper_name"), r'[",\r\n\d|]', " ")
    rows = runtime.table(spark, d, "nhp_medicinal_ingredients").where("proper_name is not null").select("row_id", clean.alias("name"))
    half = F.floor(F.length("name") / 2).cast("int")
    broken = F.concat(F.substring("name", F.lit(1), half), F.when(F.col("row_id") % 3 == 0, "\n").otherwise(""), F.substring("name", half + 1, F.length("name")))
    line = F.concat(F.col("row_id").cast("string"), F.lit(',"'), broken, F.lit('"'), F.when(F.col("row_id") % 5 == 0, ",,surplus").otherwise(""))
    path = _written(spark, lambda p: rows.sort("row_id").select(line).coalesce(1).write.text(p))
    return records.repair_files(spark, path, 2).select("record")


def _label_csv(spark: SparkSession, d: str) -> DataFrame:
    names = F.array_join(F.array_sort(F.collect_set("common_name")), ";")
    g = runtime.table(spark, d, "nhp_medicinal_ingredients").where("ingredient_id rlike '^[0-9]+$'").groupBy("ingredient_id").agg(F.min("proper_name").alias("name"), names.alias("synonyms"))
    return g.select(F.col("ingredient_id").alias("Ingredient - Group ID"), F.col("name").alias("Ingredient - Group Name"), F.col("synonyms").alias("Synonyms/Sources"), F.lit("other").alias("CATEGORY"), F.lit("x").alias("NOTE"))


def file_label_groups(spark: SparkSession, d: str) -> DataFrame:
    g = _label_csv(spark, d)
    path = _written(spark, lambda p: g.unionByName(g).write.options(**files.KEEP_BLANKS).option("header", True).option("escape", '"').csv(p))
    return files.read_label_groups(spark, path).select("group_id", "group_name", "category")


def file_label_products(spark: SparkSession, d: str) -> DataFrame:
    ids = F.transform(F.array_sort(F.collect_set("ingredient_id")), lambda x: F.struct(x.alias("Ingredient_Group_GRP_ID")))
    rows = runtime.table(spark, d, "nhp_medicinal_ingredients").where("product_id is not null").groupBy(F.col("product_id").alias("DSLD_ID")).agg(F.min("common_name").alias("Product_Name"), ids.alias("ingredients"))
    path = _written(spark, lambda p: rows.write.json(p))
    groups = runtime.table(spark, d, "nhp_medicinal_ingredients").where("ingredient_id like '%1'").select(F.col("ingredient_id").alias("group_id"))
    return converters.label_products(files.read_label_products(spark, path), groups)[0]


def file_answers(spark: SparkSession, d: str) -> DataFrame:
    """Captured service answers up to the first that failed."""
    rows = runtime.table(spark, d, "ingredients_jsonl").select(F.col("line_no").alias("id"), F.when(F.col("line_no") % 97 == 96, 404).otherwise(200).alias("status"), F.md5("line").alias("body"))
    path = _written(spark, lambda p: rows.write.json(p))
    return converters.captured_labels(spark.read.schema("id bigint, status int, body string").json(path))


def crawl_links(spark: SparkSession, d: str) -> DataFrame:
    """Index pages of links named by terms: the first address of each name, relative ones completed."""
    kb = _kb(spark, d)
    name = text.squeeze(F.regexp_replace("term", "[<>]", " "))
    named = kb.atoms.select("cidx", "pos", name.alias("n")).where("n <> ''")
    url = F.when(F.col("pos") == 0, F.concat(F.lit("/t/"), "cidx")).otherwise(F.concat(F.lit("http://other/"), "cidx", F.lit("/"), "pos"))
    link_to = F.concat(F.lit('<li><a class="x" href="'), url, F.lit('">'), "n", F.lit("</a></li>"))
    pages = named.groupBy(F.col("cidx").alias("page_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", link_to.alias("a")))), lambda e: e["a"]), "\n").alias("html"))
    return converters.crawl(pages, "http://site")


def html_sections(spark: SparkSession, d: str) -> DataFrame:
    """Pages with a section of bullets and a section of text."""
    kb = _kb(spark, d)
    safe = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    items = F.concat(F.lit("<li>"), safe(text.strip(F.col("term"))), F.lit("</li>"))
    listed = kb.atoms.groupBy("cidx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", items.alias("x")))), lambda e: e["x"]), "\n").alias("items"))
    head = lambda n: f'<div class="accordion "><h3 class="accordion__headline" data-listname="{n}">{n}</h3><div class="field-item">'
    body = F.concat(F.lit("<p>"), safe(F.col("ui")), F.lit("<br/></p></div></div>"))
    html = F.concat(F.lit(head("Purported Uses") + '<ul class="bullet-list">'), "items", F.lit("</ul></div></div>" + head("Unknown") + "x</div></div>" + head("Warnings ")), body)
    pages = kb.concepts.join(listed, "cidx").select("cidx", html.alias("html"))
    found = converters.html_sections(pages, "cidx")
    return found.select("cidx", "header", F.array_join("bullets", "\n").alias("bullets"), "body")


def ini_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return files.vocabulary_table(spark, files.source_ranks(runtime.read_small(spark, _small(spark, INI)), "1.1"))


def linker_conf(spark: SparkSession, d: str) -> DataFrame:
    got = files.linker_settings(runtime.read_small(spark, _small(spark, LINKERS)), link.REGISTRY)
    return spark.createDataFrame([(k, c.__name__, json.dumps(p)) for k, (c, p) in got.items()], "terminology string, linker string, parameters string")


def filter_word_list(spark: SparkSession, d: str) -> DataFrame:
    """Label names cleaned with the words of a list file."""
    words = files.read_words(spark, _small(spark, FILTER_WORDS))
    names = runtime.table(spark, d, "nhp_medicinal_ingredients").select(F.col("common_name").alias("name")).where("name is not null").distinct()
    return names.select("name", text.clean_label_name(F.concat("name", F.lit(" (root) [EXTRACT]")), words).alias("clean"))


def schema_ddl(spark: SparkSession, d: str) -> DataFrame:
    path = runtime.scratch(spark)
    files.create_schema(spark, runtime.read_small(spark, _small(spark, DDL)), path)
    node = spark.read.parquet(f"{path}/properties").select(F.lit("node").alias("part"), F.col("label").alias("name"), "property")
    return node.unionByName(spark.read.parquet(f"{path}/edges").select(F.lit("edge").alias("part"), F.col("edge").alias("name"), "property"))


def lint_file_report(spark: SparkSession, d: str) -> DataFrame:
    from termloom.catalog import _labels

    kb = _kb(spark, d)
    origin = kb.concepts.select("cidx", F.concat(F.lit("f"), F.col("cidx") % 3).alias("file"))
    report = quality.lint_report(quality.lint(kb, *_labels(spark)), origin)
    path = _written(spark, lambda p: quality.write_report(report, p))
    back = spark.read.schema("value string, file string").text(path)
    return back.select("file", F.substring_index("value", "\t", 1).alias("message"), F.substring_index("value", "\t", -1).cast("bigint").alias("n"))


def version_folder(spark: SparkSession, d: str) -> DataFrame:
    """Two sources put together in a version folder, loaded with its vocabularies."""
    whole = runtime.durable(model.to_records(_kb(spark, d)))
    parts = [_written(spark, lambda p, k=k: files.write_concepts(whole.where((F.col("concept_type") == "SDSI") == k), p)) for k in (True, False)]
    folder = runtime.scratch(spark)
    pipelines.make_version(spark, folder, "1.1", INI)
    pipelines.concat_sources(spark, parts, f"{folder}/{pipelines.MERGED}")
    kb, known = pipelines.load_kb(spark, folder)
    return kb.atoms.where(F.upper("src").isin(known["sources"])).select("cidx", "pos", "term", "src")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        file_concepts, file_concepts_joined, file_broken_concepts, file_connections, file_annotations, file_annotation_stream, file_keyed_rrf, file_semantic_types, file_rrf_statistics, file_flat,
        file_text_csv, file_repaired, file_label_groups, file_label_products, file_answers, crawl_links, html_sections, ini_vocabulary, linker_conf, filter_word_list, schema_ddl, lint_file_report, version_folder,
    )
}

_RANKED = "rk AS (SELECT cidx, row_number() OVER (ORDER BY {0}) - 1 AS k FROM concepts)"
_SQ = r"trim(regexp_replace({}, '[\s\p{{Z}}]+', ' ', 'g'))"
_ST = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_DENSE = "(row_number() OVER (PARTITION BY a.cidx ORDER BY a.pos) - 1)::INT"
_NUMBERED = "n AS (SELECT line, row_number() OVER (ORDER BY line_no) - 1 AS cidx FROM ingredients_jsonl WHERE line IS NOT NULL AND NOT regexp_matches(line, '[\\r\\n]') AND line <> '')"

SQL: dict[str, str] = {
    "file_concepts": _with(
        f"SELECT k AS cidx, {_DENSE} AS pos, a.term, a.src, a.src_id, a.term_type, a.is_preferred, round(a.linking_score, 6) AS linking_score, s.linked_string AS linked_string FROM atoms a JOIN atoms_ x USING (cidx, pos) JOIN rk USING (cidx)",
        _KB, _RANKED.format("cidx"),
    ),
    "file_concepts_joined": _with("SELECT k AS cidx, ui, concept_type FROM concepts JOIN rk USING (cidx)", _KB, _RANKED.format("cidx % 2 DESC, cidx")),
    "file_broken_concepts": f"WITH {_NUMBERED} SELECT cidx FROM n WHERE NOT coalesce(json_valid(line), false) OR CASE WHEN json_valid(line) THEN json_type(line) <> 'OBJECT' ELSE true END",
    "file_connections": _with("SELECT i, j FROM cpairs", _PAIRS),
    "file_annotations": _with("SELECT i, j FROM cpairs WHERE (i + j) % 3 <> 0 OR (i + j) % 2 = 0", _PAIRS),
    "file_annotation_stream": _with(
        "SELECT row_number() OVER (ORDER BY i, j) - 1 AS _input_hash, -row_number() OVER (ORDER BY i, j) AS _task_hash, '<b>{{term}}</b>' AS html, i, j, term_i, term_j, matched_on, '1=Equal,2=Not Equal,3=Parent-Child,4=Child-Parent' AS options FROM t",
        _KB, _PAIRS, _PREF, "al AS (SELECT cidx, list(DISTINCT term_lc) AS al FROM atoms GROUP BY cidx)",
        "t AS (SELECT p.i, p.j, a.term AS term_i, b.term AS term_j, array_to_string(list_sort(list_intersect(x.al, y.al)), '|') AS matched_on FROM cpairs p JOIN pref a ON a.cidx = p.i JOIN pref b ON b.cidx = p.j JOIN al x ON x.cidx = p.i JOIN al y ON y.cidx = p.j WHERE lower(a.term) <> lower(b.term))",
    ),
    "file_keyed_rrf": "SELECT concept_type AS kind, count(*) AS n, printf('C%07d', min(ref_id)) AS first_cui, max(ref_term) AS last_name FROM reference_terms GROUP BY concept_type",
    "file_semantic_types": "SELECT code, tree, short, long, unnest([code, short]) AS key FROM (VALUES ('T184', 'A2.2.2', 'sosy', 'Sign or Symptom'), ('T047', 'B2.2.1.2.1', 'dsyn', 'Disease or Syndrome')) t(code, tree, short, long)",
    "file_rrf_statistics": _with('SELECT concept_type AS "STY", src AS "SAB", count(DISTINCT cui) AS concepts, count(*) AS atoms FROM atoms JOIN concepts USING (cidx) JOIN ids USING (cidx) GROUP BY ALL', _KB, _IDS),
    "file_flat": "SELECT row_id::VARCHAR AS row_id, source_material, source_material_f FROM nhp_medicinal_ingredients",
    "file_text_csv": "SELECT row_id, " + ", ".join(f"nullif({_SQ.format(c)}, '') AS {c}" for c in ("ingredient_id", "proper_name", "common_name", "potency_amount", "quantity")) + " FROM nhp_medicinal_ingredients",
    "file_repaired": "SELECT row_id || ',\"' || regexp_replace(proper_name, '[\",\\r\\n\\d|]', ' ', 'g') || '\"' AS record FROM nhp_medicinal_ingredients WHERE proper_name IS NOT NULL",
    "file_label_groups": "SELECT ingredient_id::BIGINT AS group_id, min(proper_name) AS group_name, 'other' AS category FROM nhp_medicinal_ingredients WHERE regexp_matches(ingredient_id, '^[0-9]+$') GROUP BY ingredient_id",
    "file_label_products": "SELECT DISTINCT product_id, ingredient_id AS group_id FROM nhp_medicinal_ingredients WHERE product_id IS NOT NULL AND ingredient_id LIKE '%1'",
    "file_answers": "SELECT line_no AS id, md5(line) AS label FROM ingredients_jsonl WHERE line_no < (SELECT coalesce(min(line_no), 9e18) FROM ingredients_jsonl WHERE line_no % 97 = 96)",
    "crawl_links": _with(
        "SELECT n AS name, CASE WHEN pos = 0 THEN 'http://site/t/' || cidx ELSE 'http://other/' || cidx || '/' || pos END AS url FROM t WHERE n <> '' QUALIFY row_number() OVER (PARTITION BY n ORDER BY cidx, pos) = 1",
        _KB, f"t AS (SELECT cidx, pos, {_SQ.format(chr(39).join(['regexp_replace(term, ', '[<>]', ', ', ' ', ', ', 'g', ')']))} AS n FROM atoms)",
    ),
    "html_sections": _with(
        f"SELECT cidx, h AS header, CASE h WHEN 'purported_uses' THEN b END AS bullets, CASE h WHEN 'purported_uses' THEN NULL WHEN 'warnings' THEN ui ELSE '' END AS body FROM (SELECT cidx, ui, string_agg({_ST.format('term')}, chr(10) ORDER BY pos) AS b FROM atoms JOIN concepts USING (cidx) GROUP BY ALL), "
        + "(SELECT unnest(['" + "', '".join(converters.PAGE_HEADERS) + "']) AS h)",
        _KB,
    ),
    "ini_vocabulary": "VALUES ('sources', 1, 'UMLS'), ('sources', 2, 'MEDDRA'), ('sources', 3, 'NMCD'), ('term_types', 1, 'SN'), ('term_types', 2, 'CN')",
    "linker_conf": "SELECT 'umls.dictionary' AS terminology, 'DictionaryLinker' AS linker, '{\"threshold\": 0.8}' AS parameters UNION ALL SELECT 'meddra.rules', 'RuleLinker', '{}'",
    "filter_word_list": f"SELECT name, {_clean(chr(40) + 'name || ' + chr(39) + ' (root) [EXTRACT]' + chr(39) + chr(41), ['powder', 'extract', 'root'])} AS clean FROM (SELECT DISTINCT common_name AS name FROM nhp_medicinal_ingredients WHERE common_name IS NOT NULL)",
    "schema_ddl": "SELECT 'node' AS part, 'SDSI' AS name, 'preferred_name' AS property UNION ALL VALUES ('node', 'SDSI', 'links_to'), ('node', 'SS', 'preferred_name'), ('edge', 'HAS_ADVERSE_REACTION', NULL), ('edge', 'HAS_ADVERSE_REACTION', 'rating')",
    "lint_file_report": _with(
        "SELECT 'f' || cidx % 3 AS file, rule || ': ' || regexp_replace(coalesce(value, 'none'), '[\\n\\t\\r]', ' ', 'g') AS message, count(DISTINCT cidx) AS n FROM breaches GROUP BY ALL",
        _KB, _SCHEMA, f"breaches AS ({_LINT})",
    ),
    "version_folder": _with(f"SELECT cidx, pos, term, src FROM (SELECT k AS cidx, {_DENSE} AS pos, term, src FROM atoms a JOIN rk USING (cidx)) WHERE upper(src) IN ('UMLS', 'MEDDRA', 'NMCD')", _KB, _RANKED.format("(concept_type = 'SDSI') DESC, cidx")),
}
SQL["ini_vocabulary"] = f"SELECT * FROM ({SQL['ini_vocabulary']}) t(vocabulary, rank, value)"
