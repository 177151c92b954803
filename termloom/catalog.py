"""All queries of the core, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import model, runtime
from termloom.functions import text
from termloom.operators import export, link, nested, pairs, quality, resolve, units
from termloom.plans import pipelines
from termloom.sources import builders, converters, files

# The domain schema (labels with their terminology, properties, edges with theirs).
SCHEMA = {
    "nodes": {
        "SDSI": "umls_semantic_type preferred_name synonym scientific_name source_material ingredient_category background safety mechanism_of_action links_to=umls.dictionary",
        "DSP": "preferred_name langual_type",
        "PD": "preferred_name umls_semantic_type links_to=umls.dictionary",
        "DIS": "preferred_name umls_semantic_type links_to=umls.dictionary",
        "TC": "preferred_name umls_semantic_type links_to=umls.dictionary",
        "SOC": "preferred_name umls_semantic_type links_to=meddra.rules",
        "SS": "preferred_name umls_semantic_type links_to=umls.dictionary",
    },
    "edges": {"HAS_INGREDIENT": "", "INTERACTS_WITH": "rating severity", "IS_EFFECTIVE_FOR": "rating", "HAS_THERAPEUTIC_CLASS": "", "HAS_ADVERSE_EFFECT_ON": "", "HAS_ADVERSE_REACTION": ""},
}


def schema() -> dict:
    """The domain schema in the form of ``files.parse_schema``."""
    read = lambda s: dict((x.split("=") + [""])[:2] for x in s.split())
    return {part: {k: read(v) for k, v in body.items()} for part, body in SCHEMA.items()}


def _labels(spark: SparkSession):
    return files.schema_tables(spark, schema())


def _kb(spark: SparkSession, d: str) -> model.KB:
    return model.load(spark, d)


def _of_type(kb: model.KB, kind: str) -> model.KB:
    """The concepts of one type, with all relationships."""
    return model.KB(kb.concepts.where(F.col("concept_type") == kind), kb.atoms, kb.attributes, kb.rel_attributes, kb.relationships)


def _ranks(spark: SparkSession, d: str) -> DataFrame:
    return runtime.table(spark, d, "source_rank").select("src", "src_rank")


def doc_terms(spark: SparkSession, d: str) -> DataFrame:
    """Documents as concepts: type is the language, terms are the distinct lower-case lines that are not empty."""
    docs = runtime.table(spark, d, "documents").where("text is not null")
    lines = docs.select(F.col("doc_id").alias("cidx"), F.coalesce("lang", F.lit("")).alias("concept_type"), F.explode(F.split("text", "\n")).alias("l"))
    return lines.select("cidx", "concept_type", F.lower(F.trim("l")).alias("term_lc")).where("term_lc <> ''").distinct()


def _ordered_pairs(spark: SparkSession, d: str) -> DataFrame:
    c = runtime.table(spark, d, "connections")
    return c.where("i is not null and j is not null and i <> j").select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct()


def _doc_components(spark: SparkSession, d: str) -> DataFrame:
    terms = runtime.durable(doc_terms(spark, d))
    joined = resolve.components(resolve.stars(terms))
    alone = terms.select(F.col("cidx").alias("v")).distinct().join(joined.select("v"), "v", "left_anti")
    return joined.unionByName(alone.select("v", F.col("v").alias("root")))


def _roots(spark: SparkSession, d: str) -> DataFrame:
    """Every concept with the least concept of its connected group."""
    kb = _kb(spark, d)
    known = kb.concepts.select("cidx")
    links = _ordered_pairs(spark, d).join(known.withColumnRenamed("cidx", "i"), "i", "left_semi").join(known.withColumnRenamed("cidx", "j"), "j", "left_semi")
    groups = resolve.components(links)
    return known.join(groups.withColumnRenamed("v", "cidx"), "cidx", "left").select("cidx", F.coalesce("root", "cidx").alias("root"))


def _merged(spark: SparkSession, d: str) -> model.KB:
    return resolve.merge(_kb(spark, d), _roots(spark, d))


def _annotations(spark: SparkSession, d: str) -> DataFrame:
    """Judgements made of the pairs themselves: every third judged, every second of those equal."""
    p = _ordered_pairs(spark, d)
    judged = p.where("(i + j) % 3 = 0")
    return judged.select("i", "j", F.lit("accept").alias("answer"), F.when(F.expr("(i + j) % 2 = 0"), F.array(F.lit(1))).otherwise(F.array(F.lit(2))).alias("accept"))


def _nhp(spark: SparkSession, d: str) -> DataFrame:
    return runtime.table(spark, d, "nhp_medicinal_ingredients")


def _label_groups(spark: SparkSession, d: str) -> DataFrame:
    """Registry ingredients in the shape of label groups: synonyms joined by ';'."""
    names = F.array_join(F.array_sort(F.collect_set("common_name")), ";")
    return _nhp(spark, d).groupBy(F.col("ingredient_id").alias("group_id")).agg(F.min("proper_name").alias("group_name"), names.alias("synonyms")).withColumn("category", F.lit("other"))


def _label_products(spark: SparkSession, d: str) -> DataFrame:
    """Registry products in the shape of label products: the ingredients of a product as an array of groups."""
    parts = F.array_sort(F.collect_set("ingredient_id")).alias("ids")
    rows = _nhp(spark, d).where("product_id is not null").groupBy("product_id").agg(parts)
    sold = runtime.table(spark, d, "nhp_products").select(text.source_id(F.col("product_id")).alias("product_id"), F.col("product_name").alias("Product_Name"))
    kind = F.when(F.col("product_id").endswith("0"), "").otherwise("Dietary supplement")
    ids = F.transform("ids", lambda x: F.struct(x.alias("Ingredient_Group_GRP_ID")))
    return sold.join(rows, "product_id").select("Product_Name", F.col("product_id").alias("DSLD_ID"), kind.alias("LanguaL_Product_Type"), ids.alias("ingredients"))


def _herb_lines(spark: SparkSession, d: str) -> DataFrame:
    """Ingredient concepts in the shape of herb page records (``page, line``)."""
    kb = _kb(spark, d)
    first = runtime.durable(kb.atoms.groupBy("cidx").agg(F.min_by("term", "pos").alias("t"), F.min("pos").alias("low")))
    listed = lambda df, at, v: df.groupBy("cidx").agg(F.transform(F.array_sort(F.collect_list(F.struct(at, v))), lambda e: e[v]).alias(v))
    names = listed(kb.atoms.join(first, "cidx").where("pos > low"), "pos", "term").withColumnRenamed("term", "common_name")
    told = listed(kb.attributes.where("atr_value is not null"), "pos", "atr_value").withColumnRenamed("atr_value", "clinical_summary")
    edges = runtime.durable(resolve.resolve_objects(kb).where("object_cidx is not null").join(first.select(F.col("cidx").alias("object_cidx"), "t"), "object_cidx"))
    of = lambda name: listed(edges.where(F.col("rel_name") == name), "ridx", "t")
    uses = of("IS_EFFECTIVE_FOR").select("cidx", F.array_join("t", "\n").alias("purported_uses"))
    harms = of("HAS_ADVERSE_REACTION").withColumnRenamed("t", "adverse_reactions")
    drugs = of("INTERACTS_WITH").select("cidx", F.transform("t", lambda x: F.concat(x, F.lit(" (class): may interact"))).alias("herb-drug_interactions"))
    herbs = kb.concepts.where("concept_type = 'SDSI'").select("cidx").join(first.select("cidx", F.col("t").alias("herb_name")), "cidx")
    for part in (names, told, uses, harms, drugs):
        herbs = herbs.join(part, "cidx", "left")
    return herbs.select(F.col("cidx").alias("page"), F.to_json(F.struct(*[f"`{c}`" for c in herbs.columns if c != "cidx"])).alias("line"))


def _distinct_names(spark: SparkSession, d: str, column: str) -> DataFrame:
    return _nhp(spark, d).select(F.col(column).alias("name")).where("name is not null").distinct()


def _queries_of_events(spark: SparkSession, d: str) -> DataFrame:
    """Key words of organ systems, as free queries, made of the rule table itself and of part names."""
    keys = [(i, k) for i, k in enumerate(dict.fromkeys(k for k, *_ in link.ORGAN_CLASSES))]
    fixed = spark.createDataFrame([(str(i), f" {k.title()}  (unspecified)") for i, k in keys], "id string, text string")
    return fixed.unionByName(runtime.table(spark, d, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), F.col("p_name").alias("text")))


def _dictionary(spark: SparkSession, d: str) -> link.DictionaryLinker:
    e = runtime.table(spark, d, "reference_terms").select(F.col("ref_term").alias("term"), F.col("ref_term").alias("preferred"), F.format_string("C%07d", "ref_id").alias("code"), F.array("concept_type").alias("semtypes"))
    return link.DictionaryLinker(e)


def _linkable(spark: SparkSession, d: str) -> DataFrame:
    kb = _kb(spark, d)
    return link.linkables(kb, resolve.preferred_atoms(kb, _ranks(spark, d)), _labels(spark)[0])


def _exact_links(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Linkables and, as links, the reference terms that equal their text."""
    q = runtime.durable(_linkable(spark, d))
    r = runtime.table(spark, d, "reference_terms").select(F.col("ref_term").alias("term"), F.format_string("C%07d", "ref_id").alias("code"), F.col("concept_type").alias("st"))
    best = q.join(r, F.lower(q["text"]) == r["term"]).select("id", F.col("text").alias("matched"), "term", F.lit("UMLS").alias("src"), "code", F.lit(1.0).alias("score"), F.array("st").alias("semtypes"))
    return q, best


def _rrf(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        kb = _kb(spark, d)
        return export.rrf(kb, export.concept_ids(kb))[name]

    return run


def _graph(part: int) -> Callable[[SparkSession, str], DataFrame]:
    """Nodes or edges, their properties as sorted text."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        kb = _kb(spark, d)
        out = export.graph(kb, resolve.preferred_atoms(kb, _ranks(spark, d)), export.concept_ids(kb))[part]
        entries = F.array_sort(F.map_entries(F.from_json("properties", "map<string,string>")))
        return out.withColumn("properties", F.nullif(F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; "), F.lit("")))

    return run


def _captured_outputs(spark: SparkSession, d: str) -> DataFrame:
    """Captured mapper output for every linkable: each reference term of its text's first letter and length is a candidate."""
    q = _linkable(spark, d).withColumn("k", F.concat(F.lower(F.substring("text", 1, 1)), F.length("text")))
    r = runtime.table(spark, d, "reference_terms").select(F.concat(F.substring("ref_term", 1, 1), F.length("ref_term")).alias("k"), "ref_id", "ref_term", "concept_type")
    one = F.struct(F.col("ref_id").alias("o"), F.struct(F.col("ref_term").alias("CandidatePreferred"), F.format_string("C%07d", "ref_id").alias("CandidateCUI"), F.format_string("-%d", (700 + F.pmod(F.col("ref_id") * 37, F.lit(300))).cast("int")).alias("CandidateScore"), F.array("concept_type").alias("SemTypes")).alias("c"))
    listed = q.join(r, "k").groupBy("id", "text").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["c"]).alias("MappingCandidates"))
    mappings = F.array(F.struct("MappingCandidates")).alias("Mappings")
    phrases = F.array(F.struct(F.col("text").alias("PhraseText"), mappings)).alias("Phrases")
    document = F.struct(F.array(F.struct(F.col("id").alias("PMID"), phrases)).alias("Utterances")).alias("Document")
    return listed.select(F.to_json(F.struct(F.array(F.struct(document)).alias("AllDocuments"))).alias("json"))


def _service_answers(spark: SparkSession, d: str) -> DataFrame:
    """Captured answers of an annotation service: the linkables' words that are the first word of a reference term."""
    words = _linkable(spark, d).select("id", F.posexplode(F.split(F.lower("text"), " ")).alias("at", "matched"))
    r = runtime.table(spark, d, "reference_terms").select(F.substring_index("ref_term", " ", 1).alias("matched"), F.col("ref_term").alias("term"), F.format_string("C%07d", "ref_id").alias("code"))
    return words.join(r, "matched").select("id", "matched", F.struct("at", "code").alias("pos"), "term", F.lit("MEDDRA").alias("src"), "code")


def _routed(spark: SparkSession, d: str) -> DataFrame:
    """Diseases to the mapper, signs to the service, organ systems to the rules; others have no linker."""
    q = _linkable(spark, d).join(_kb(spark, d).concepts.select("cidx", "concept_type"), "cidx")
    where = F.when(F.col("concept_type") == "DIS", "mapper").when(F.col("concept_type") == "SS", "service").otherwise("none")
    q = q.select("id", "text", where.alias("terminology")).unionByName(_queries_of_events(spark, d).select("id", "text", F.lit("rules").alias("terminology")))
    linkers = {"mapper": link.CapturedLinker(_captured_outputs(spark, d), 800), "service": link.AnnotatorLinker(_service_answers(spark, d)), "rules": link.RuleLinker()}
    return link.route(q, linkers).select("id", "terminology", "matched", "code", "score")


def _rewritten(spark: SparkSession, d: str) -> model.KB:
    return link.rewrite(_kb(spark, d), *_exact_links(spark, d))


def _union(spark: SparkSession, d: str) -> model.KB:
    return pipelines.resolve_kb(_kb(spark, d), _ordered_pairs(spark, d))


def _metathesaurus(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Reference terms as a metathesaurus, extended by the knowledge base."""
    refs = runtime.table(spark, d, "reference_terms")
    cui = F.format_string("C%07d", F.col("ref_id"))
    fixed = {c: F.lit("") for c in export.CONSO} | {"CUI": cui, "STR": F.col("ref_term"), "SAB": F.lit("REF")}
    conso = refs.select(*[fixed[c].alias(c) for c in export.CONSO])
    code = F.when(F.col("concept_type") == "PD", "T121").when(F.col("concept_type") == "SS", "T184").otherwise("T047")
    own = {c: F.lit("") for c in export.STY} | {"CUI": cui, "TUI": code, "ATUI": F.format_string("AT%08d", F.col("ref_id"))}
    sty = refs.select(*[own[c].alias(c) for c in export.STY])
    rows = [("T121", "A1.4.1.1.1", "phsu", "Pharmacologic Substance"), ("T184", "A2.2.2", "sosy", "Sign or Symptom"), ("T047", "B2.2.1.2.1", "dsyn", "Disease or Syndrome"), ("T033", "A2.2", "fndg", "Finding")]
    types = spark.createDataFrame([(k, c, t, s, n) for c, t, s, n in rows for k in (c, s)], "key string, code string, tree string, short string, long string")
    kb = _kb(spark, d)
    # codes of UMLS atoms as CUIs of the reference list
    atoms = kb.atoms.withColumn("src_id", F.when(F.col("src") == "UMLS", F.format_string("C%07d", F.pmod(F.col("src_id").try_cast("bigint"), F.lit(2000)))).otherwise(F.col("src_id")))
    kb = model.KB(kb.concepts, atoms, kb.attributes, kb.rel_attributes, kb.relationships)
    return export.extend_metathesaurus(kb, export.concept_ids(kb), conso, sty, types, "TLKB")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(c).cast("double"), 6).alias(c) for c in df.columns])


def _statement(kb_table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda s, d: getattr(_kb(s, d), kb_table)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": nested.p2_found,
    "p2_synonyms": nested.p2_synonyms,
    "p7_found": units.p7_found,
    "kb_concepts": _statement("concepts"),
    "kb_atoms": lambda s, d: _kb(s, d).atoms.withColumn("linked_string", F.try_element_at("attrs", F.lit("linked_string"))).drop("attrs"),
    "kb_attributes": _statement("attributes"),
    "kb_rel_attributes": _statement("rel_attributes"),
    "kb_relationships": _statement("relationships"),
    "product_records": lambda s, d: runtime.table(s, d, "events").select("event_id", F.get_json_object("props", "$.page").alias("page"), F.get_json_object("props", "$.k").alias("k")),
    "find_connections": lambda s, d: resolve.find_connections(runtime.durable(resolve.typed_terms(_kb(s, d)))),
    "connection_classes": lambda s, d: resolve.classes(resolve.typed_terms(_kb(s, d))),
    "connection_stars_docs": lambda s, d: resolve.stars(doc_terms(s, d)),
    "components_docs": lambda s, d: _doc_components(s, d).select(F.col("v").alias("doc_id"), F.col("root").alias("component")),
    "intersection_docs": lambda s, d: resolve.intersection(_doc_components(s, d)),
    "difference_docs": lambda s, d: resolve.difference(_doc_components(s, d)),
    "components_connections": lambda s, d: _roots(s, d),
    "union_roots": lambda s, d: resolve.union_roots(_kb(s, d), _ordered_pairs(s, d)),
    "merged_atoms": lambda s, d: _merged(s, d).atoms.drop("attrs"),
    "merged_attributes": lambda s, d: _merged(s, d).attributes,
    "repointed_relationships": lambda s, d: _merged(s, d).relationships,
    "merged_concepts": lambda s, d: _merged(s, d).concepts,
    "union_atoms": lambda s, d: _union(s, d).atoms.drop("attrs"),
    "intersection_atoms": lambda s, d: resolve.intersection_kb(_kb(s, d), _roots(s, d)).atoms.select("cidx", "pos", "term", "src"),
    "intersection_concepts": lambda s, d: resolve.intersection_kb(_kb(s, d), _roots(s, d)).concepts.select("cidx", "ui", "prefix", "concept_type"),
    "difference_relationships": lambda s, d: resolve.difference_kb(_kb(s, d), _roots(s, d)).relationships.select("cidx", "rel_name", "object_ui", "src"),
    "removed_elements": lambda s, d: quality.remove_elements(_kb(s, d).atoms, _kb(s, d).atoms.where("src = 'MSKCC' and is_preferred"), ["cidx", "term_lc", "src", "src_id", "term_type"]).select("cidx", "pos"),
    "merged_source_ids": lambda s, d: resolve.merge_by_source_id(_kb(s, d), resolve.preferred_atoms(_kb(s, d), _ranks(s, d))),
    "preferred_atoms": lambda s, d: resolve.preferred_atoms(_kb(s, d), _ranks(s, d)).select("cidx", "pos", "term"),
    "atoms_by_name": lambda s, d: quality.atoms_named(_kb(s, d), quality.shared_name(_kb(s, d))).select("cidx", "pos", "term", "src", "src_id"),
    "attributes_by_name": lambda s, d: _kb(s, d).attributes.where("atr_name = 'source_material'"),
    "relationships_by_name": lambda s, d: _kb(s, d).relationships.where("rel_name = 'INTERACTS_WITH'"),
    "atom_counts": lambda s, d: _kb(s, d).atoms.groupBy("cidx").agg(F.count(F.lit(1)).alias("n")),
    "resolve_objects": lambda s, d: resolve.resolve_objects(_kb(s, d)),
    "dangling_objects": lambda s, d: resolve.resolve_objects(_of_type(_kb(s, d), "SDSI")).where("object_cidx is null").groupBy("object_ui").agg(F.count(F.lit(1)).alias("n")),
    "dedupe_first_wins": lambda s, d: resolve.first_wins(_kb(s, d).atoms, ["cidx", "term_lc", "src", "src_id", "term_type"], ["pos"]).select("cidx", "pos"),
    "surrogate_ids": lambda s, d: resolve.surrogate_ids(_nhp(s, d), "proper_name", "row_id"),
    "vocabulary_breaches": lambda s, d: quality.vocabulary_breaches(_kb(s, d), model.SOURCES, model.TERM_TYPES, model.CONCEPT_TYPES),
    "filter_pairs_basic": lambda s, d: pairs.filter_basic(_kb(s, d), _ordered_pairs(s, d), ["SS", "PD"]),
    "filter_pairs_basic_symmetric": lambda s, d: pairs.filter_basic(_kb(s, d), _ordered_pairs(s, d), ["SS", "PD"], symmetric=True),
    "linked_idf": lambda s, d: pairs.linked_idf(_kb(s, d)).select("src_id", F.round("idf", 9).alias("idf")),
    "filter_pairs_idf": lambda s, d: pairs.filter_idf(_kb(s, d), _ordered_pairs(s, d)),
    "filter_pairs_annotated": lambda s, d: pairs.filter_annotated(_ordered_pairs(s, d), _annotations(s, d)),
    "annotation_tasks": lambda s, d: pairs.annotation_tasks(_kb(s, d), _ordered_pairs(s, d), resolve.preferred_atoms(_kb(s, d), _ranks(s, d))).select("i", "j", F.col("ing_i.term").alias("term_i"), F.col("ing_j.term").alias("term_j"), F.array_join("matched_on", "|").alias("matched_on")),
    "lint_schema": lambda s, d: quality.lint(_kb(s, d), *_labels(s)),
    "lint_lines": lambda s, d: quality.lint_lines(runtime.table(s, d, "ingredients_jsonl"), "line_no", "line"),
    "remove_source_atoms": lambda s, d: quality.remove_source(_kb(s, d), "NMCD").atoms.select("cidx", "pos"),
    "remove_source_relationships": lambda s, d: quality.remove_source(_kb(s, d), "NMCD", ["SS", "DIS"]).relationships.select("cidx", "ridx"),
    "count_concepts": lambda s, d: quality.concept_count(_kb(s, d)),
    "count_types": lambda s, d: quality.type_counts(_kb(s, d)),
    "count_type_source": lambda s, d: quality.type_source_counts(_kb(s, d)),
    "source_overlap": lambda s, d: quality.source_overlap(_kb(s, d)),
    "atom_count_stats": lambda s, d: _rounded(quality.statistics(quality.atoms_per_concept(_kb(s, d)), "n")),
    "atom_count_extremes": lambda s, d: quality.extremes(quality.atoms_per_concept(_kb(s, d)), "cidx", "n"),
    "linked_code_stats": lambda s, d: _rounded(quality.statistics(quality.codes_per_concept(_kb(s, d)), "n")),
    "linked_code_ratio": lambda s, d: quality.code_ratio(_kb(s, d)).select("codes", "concepts", F.round("ratio", 6).alias("ratio")),
    "rel_counts": lambda s, d: quality.relationship_counts(_kb(s, d)),
    "attr_counts": lambda s, d: quality.attribute_counts(_kb(s, d)),
    "invalid_names": lambda s, d: _nhp(s, d).where(text.invalid_name(F.col("potency_amount"))).groupBy("potency_amount").agg(F.count(F.lit(1)).alias("n")),
    "clean_synonyms": lambda s, d: _distinct_names(s, d, "common_name").select("name", text.clean_label_name(F.col("name")).alias("clean")),
    "expand_parens": lambda s, d: _distinct_names(s, d, "common_name").select("name", F.explode(text.expand_parentheses(F.col("name"))).alias("part")),
    "group_synonyms": lambda s, d: converters.label_synonyms(_label_groups(s, d)).select("group_id", F.array_join("synonyms", "|").alias("synonyms")),
    "split_content": lambda s, d: runtime.table(s, d, "documents").where("text is not null").select("doc_id", F.explode(text.split_content(F.col("text"))).alias("part")),
    "normalize_queries": lambda s, d: _distinct_names(s, d, "proper_name").select("name", text.normalise_query(F.col("name")).alias("query")),
    "registry_atoms": lambda s, d: converters.registry_atoms(_nhp(s, d)),
    "registry_attributes": lambda s, d: converters.registry_attributes(_nhp(s, d)),
    "registry_products": lambda s, d: converters.registry_products(runtime.table(s, d, "nhp_products")),
    "connect_products": lambda s, d: converters.connect_products(_nhp(s, d), runtime.table(s, d, "nhp_products"))[0],
    "unknown_products": lambda s, d: converters.connect_products(_nhp(s, d), runtime.table(s, d, "nhp_products"))[1],
    "registry_records": lambda s, d: builders.flat_records(builders.registry_kb(_nhp(s, d), runtime.table(s, d, "nhp_products"))),
    "label_records": lambda s, d: builders.flat_records(builders.label_kb(_label_groups(s, d), _label_products(s, d))),
    "herb_records": lambda s, d: builders.flat_records(builders.herb_kb(_herb_lines(s, d))),
    "registry_concepts": lambda s, d: converters.registry_concepts(_nhp(s, d)),
    "page_sections": lambda s, d: converters.page_sections(runtime.table(s, d, "documents").where("source = 'herb_page'"), "doc_id", "text"),
    "section_headers": lambda s, d: converters.header_counts(converters.page_sections(runtime.table(s, d, "documents").where("source = 'herb_page'"), "doc_id", "text")),
    "link_rules": lambda s, d: link.RuleLinker().link(_queries_of_events(s, d)).select("id", "matched", "term", "code"),
    "link_rules_best": lambda s, d: link.RuleLinker().best(link.RuleLinker().link(_queries_of_events(s, d))).select("id", "matched", "code"),
    "linkables": _linkable,
    "dictionary_link": lambda s, d: _dictionary(s, d).best(_dictionary(s, d).link(_linkable(s, d).where("terminology = 'umls.dictionary'").select("id", "text"))).select("id", "matched", "term", "code", F.round("score", 9).alias("score")),
    "captured_links": lambda s, d: link.CapturedLinker(_captured_outputs(s, d), 800, ["DIS", "SS"]).link(_linkable(s, d)).select("id", "matched", "term", "code", "score"),
    "captured_links_best": lambda s, d: (lambda k: k.best(k.link(_linkable(s, d)), 2))(link.CapturedLinker(_captured_outputs(s, d), 800)).select("id", "matched", "code", "score"),
    "annotator_links": lambda s, d: (lambda k: k.best(k.link(_linkable(s, d))))(link.AnnotatorLinker(_service_answers(s, d))).select("id", "matched", "term", "code"),
    "routed_links": _routed,
    "rewritten_concepts": lambda s, d: _rewritten(s, d).concepts,
    "rewritten_atoms": lambda s, d: _rewritten(s, d).atoms.select("cidx", "pos", "term", "src", "src_id", "term_type", "is_preferred", "linking_score", F.try_element_at("attrs", F.lit("linked_string")).alias("linked_string")),
    "rewritten_attributes": lambda s, d: _rewritten(s, d).attributes,
    "rewritten_relationships": lambda s, d: _rewritten(s, d).relationships,
    "rrf_mrsty": _rrf("MRSTY"),
    "rrf_mrconso": _rrf("MRCONSO"),
    "rrf_mrsat": _rrf("MRSAT"),
    "rrf_mrrel": _rrf("MRREL"),
    "graph_nodes": _graph(0),
    "graph_edges": _graph(1),
    "mth_conso": lambda s, d: _metathesaurus(s, d)["MRCONSO"],
    "mth_semtypes": lambda s, d: _metathesaurus(s, d)["MRSTY"],
    "mth_new_cuis": lambda s, d: _metathesaurus(s, d)["new"],
    "mth_source_row": lambda s, d: export.source_summary(_kb(s, d), "TLKB", "1.0.1"),
    "mth_rank": lambda s, d: export.rank_table(_ranks(s, d).select(F.format_string("%04d", F.col("src_rank").cast("int")).alias("rank"), F.col("src").alias("SAB"), F.lit("PT").alias("TTY"), F.lit("N").alias("suppress")), "TLKB"),
}

from termloom import file_queries, oracle  # noqa: E402

QUERIES |= file_queries.QUERIES
SQL = oracle.SQL | file_queries.SQL

__all__ = ["QUERIES", "SQL"]
