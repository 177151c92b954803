"""Converters from raw source tables to concepts: a product registry, a label database, herb pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions import text
from termloom.operators.resolve import first_wins

NAME_COLUMNS = ["proper_name", "proper_name_f", "common_name", "common_name_f"]


def registry_rows(rows: DataFrame) -> DataFrame:
    """The registry's ingredient rows as they become concepts: distinct, with a valid proper name; ``row_id`` is the first."""
    columns = ["ingredient_id", "product_id", *NAME_COLUMNS, "source_material", "source_material_f"]
    kept = rows.where(F.col("proper_name").isNotNull()).groupBy(*columns).agg(F.min("row_id").alias("row_id"))
    clean = kept.withColumn("name", text.squeeze(F.col("proper_name")))
    return clean.where(~text.invalid_name(F.col("name")))


def registry_names(rows: DataFrame) -> DataFrame:
    """``row_id, col, src_id, term, term_type``: names of the registry's rows.

    Every row keeps its proper name; any other (term, type) is kept where it
    comes first, by row and column, among all rows.
    """
    d = registry_rows(rows)
    src_id = text.source_id(F.coalesce("ingredient_id", F.lit(""))).alias("src_id")
    kinds = F.array(*[F.struct(F.lit(k).alias("col"), text.squeeze(F.coalesce(c, F.lit(""))).alias("term"), F.lit("SN" if c.startswith("proper") else "SY").alias("term_type")) for k, c in enumerate(NAME_COLUMNS)])
    each = d.select("row_id", src_id, F.explode(kinds).alias("e")).select("row_id", "src_id", "e.*").where("term <> ''")
    w_first = each.groupBy("term", "term_type").agg(F.min(F.struct("row_id", "col")).alias("at"))
    first = w_first.select(F.col("at.row_id").alias("row_id"), F.col("at.col").alias("col"), "term", "term_type")
    others = each.where("col > 0").join(first, ["row_id", "col", "term", "term_type"], "left_semi")
    return each.where("col = 0").unionByName(others)


def registry_atoms(rows: DataFrame) -> DataFrame:
    """``row_id, src_id, term, term_type, is_preferred``: the names of ``registry_names``; proper names are preferred."""
    return registry_names(rows).select("row_id", "src_id", "term", "term_type", (F.col("col") == 0).alias("is_preferred"))


def registry_attributes(rows: DataFrame) -> DataFrame:
    """``row_id, atr_name, atr_value``: the source material in English, or else in French."""
    d = registry_rows(rows)
    value = F.when(F.coalesce("source_material", F.lit("")) != "", text.strip(F.col("source_material"))).when(F.coalesce("source_material_f", F.lit("")) != "", text.strip(F.col("source_material_f")))
    return d.select("row_id", F.lit("source_material").alias("atr_name"), value.alias("atr_value")).where("atr_value is not null")


def registry_products(products: DataFrame) -> DataFrame:
    """``src_id, term``: product concepts, one per id; products without a name are dropped."""
    d = products.select(text.source_id(F.col("product_id")).alias("src_id"), text.squeeze(F.col("product_name")).alias("term"))
    return d.where("src_id is not null and term <> ''").groupBy("src_id").agg(F.min("term").alias("term"))


def connect_products(rows: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``ingredient_id, product_id``: has-ingredient edges between known products and ingredients; and the product ids that are unknown."""
    d = registry_rows(rows).select(text.source_id(F.col("ingredient_id")).alias("ingredient_id"), text.source_id(F.col("product_id")).alias("product_id")).where("product_id is not null").distinct()
    known = registry_products(products).select(F.col("src_id").alias("product_id"))
    return d.join(known, "product_id", "left_semi"), d.join(known, "product_id", "left_anti").groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))


def registry_concepts(rows: DataFrame) -> DataFrame:
    """``src_id, n_atoms, n_rows``: registry concepts after the merge of rows that share an ingredient id."""
    atoms = registry_atoms(rows)
    distinct = atoms.select("src_id", F.lower("term").alias("t"), "term_type").distinct().groupBy("src_id").agg(F.count(F.lit(1)).alias("n_atoms"))
    return distinct.join(registry_rows(rows).groupBy(text.source_id(F.col("ingredient_id")).alias("src_id")).agg(F.count(F.lit(1)).alias("n_rows")), "src_id")


def label_synonyms(groups: DataFrame, filter_words: Sequence[str] = ()) -> DataFrame:
    """``group_id, group_name, category, synonyms``: cleaned, expanded and grouped synonyms of label ingredients.

    ``groups`` has ``group_id, group_name, category, synonyms`` (';'-separated,
    quoted). Groups with a null key vanish.
    """
    keys = ["group_id", "group_name", "category"]
    one = groups.select(*keys, F.explode(F.split(F.regexp_replace("synonyms", '"', ""), ";")).alias("synonym")).where("synonym is not null")
    clean = one.withColumn("synonym", text.clean_label_name(F.col("synonym"), filter_words)).distinct().where("synonym <> ''")
    wide = clean.select(*keys, F.explode(text.expand_parentheses(F.col("synonym"))).alias("synonym")).distinct()
    return wide.dropna(subset=keys).groupBy(*keys).agg(F.array_sort(F.collect_list("synonym")).alias("synonyms"))


def label_products(products: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``product_id, group_id`` edges of label products (``DSLD_ID, ingredients``) to known groups; and counts of unknown groups."""
    d = products.select(F.col("DSLD_ID").alias("product_id"), F.explode("ingredients").alias("i")).select("product_id", F.col("i.Ingredient_Group_GRP_ID").cast("string").alias("group_id"))
    known = groups.select(F.col("group_id").cast("string").alias("group_id")).distinct()
    return d.join(known, "group_id", "left_semi").distinct(), d.join(known, "group_id", "left_anti").groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))


# Sections of herb pages and what they become.
SECTIONS = [
    ("scientific_name", "atom", "SN", None),
    ("common_name", "atom", "CN", None),
    ("clinical_summary", "attribute", "background", None),
    ("mechanism_of_action", "attribute", "mechanism_of_action", None),
    ("warnings", "attribute", "safety", None),
    ("purported_uses", "edge", "is_effective_for", "DIS"),
    ("adverse_reactions", "edge", "has_adverse_reaction", "SS"),
    ("herb-drug_interactions", "edge", "interacts_with", "PD"),
]


def herb_pages(pages: DataFrame, key: str = "page", line: str = "line") -> DataFrame:
    """``<key>, place, role, name, object_type, pos, value``: names, attributes and edges that page records (JSON in ``line``) state.

    A section is a text or a list of texts. Names are split at ', ' and '; ';
    an attribute joins its list; edge sections are split at line ends (a text)
    and '/', those of drugs are cut to the drug's name first. Placeholders go,
    repeats too; ``place`` orders the sections, the page's own name first.
    """
    variant = F.try_parse_json(line)
    title = pages.select(key, F.lit(0).alias("place"), F.lit("atom").alias("role"), F.lit("SY").alias("name"), F.lit(None).cast("string").alias("object_type"), F.lit(0).alias("pos"), F.get_json_object(line, "$.herb_name").alias("value"))
    out = title
    for k, (section, role, name, kind) in enumerate(SECTIONS, 1):
        many = F.try_variant_get(variant, f"$['{section}']", "array<string>")
        one = F.try_variant_get(variant, f"$['{section}']", "string")
        is_list = many.isNotNull()
        listed = F.coalesce(many, F.when(one != "", F.array(one)), F.array().cast("array<string>"))
        if role == "atom":
            values = F.flatten(F.transform(listed, text.split_names))
        elif role == "edge":
            if kind == "PD":
                lines = F.transform(listed, text.clean_interaction)
            else:
                lines = F.when(is_list, listed).otherwise(F.flatten(F.transform(listed, lambda x: F.split(x, "\n"))))
            values = F.flatten(F.transform(lines, text.split_slashes))
        else:
            values = F.array(F.array_join(F.filter(listed, text.valid_content), " "))
        each = pages.select(key, F.posexplode(F.array_distinct(F.transform(values, text.squeeze))).alias("pos", "value"))
        out = out.unionByName(each.select(key, F.lit(k).alias("place"), F.lit(role).alias("role"), F.lit(name).alias("name"), F.lit(kind).cast("string").alias("object_type"), "pos", "value"))
    return out.withColumn("value", text.squeeze(F.col("value"))).where(text.valid_content(F.col("value")))


def page_sections(pages: DataFrame, key: str, body: str) -> DataFrame:
    """``<key>, pos, header, value``: sections 'Header: text' of text pages, from a line's start to the next header."""
    found = F.regexp_extract_all(F.col(body), F.lit(r"(?m)^(?:<h\d>)?([A-Z][A-Za-z ]{2,40})(?:</h\d>)?:[ \t]+\S"), 1)
    split = F.split(F.concat(F.lit("\n"), F.col(body)), r"\n(?:<h\d>)?[A-Z][A-Za-z ]{2,40}(?:</h\d>)?:[ \t]+(?=\S)")
    d = pages.select(key, found.alias("h"), split.alias("v")).where("size(h) > 0")
    both = F.arrays_zip(F.col("h").alias("header"), F.slice("v", F.lit(2), F.size("h")).alias("value"))
    each = d.select(key, F.posexplode(both).alias("pos", "e"))
    return each.select(key, "pos", F.regexp_replace(F.lower("e.header"), " ", "_").alias("header"), text.strip(F.col("e.value")).alias("value"))


def header_counts(sections: DataFrame) -> DataFrame:
    """``header, n``: how often each section header stands."""
    return sections.groupBy("header").agg(F.count(F.lit(1)).alias("n"))


def crawl(pages: DataFrame, base: str) -> DataFrame:
    """``name, url``: links of index pages (``html``), the first address of each name; relative addresses are completed."""
    links = F.regexp_extract_all("html", F.lit(r'(<a\s[^>]*href="[^"]+"[^>]*>[^<]+</a>)'), 1)
    each = pages.select("page_id", F.posexplode(links).alias("pos", "a"))
    each = each.select("page_id", "pos", text.squeeze(F.regexp_extract("a", r">([^<]+)<", 1)).alias("name"), F.regexp_extract("a", r'href="([^"]+)"', 1).alias("url"))
    full = F.when(F.col("url").startswith("/"), F.concat(F.lit(base), "url")).otherwise(F.col("url"))
    return first_wins(each.where("name <> ''").withColumn("url", full), ["name"], ["page_id", "pos"]).select("name", "url")


def captured_labels(answers: DataFrame) -> DataFrame:
    """``id, label``: captured service answers (``id, status, body``) in order of id, up to the first that is not 200."""
    bad = answers.where("status <> 200").agg(F.min("id").alias("stop"))
    return answers.crossJoin(F.broadcast(bad)).where("stop is null or id < stop").select("id", F.col("body").alias("label"))


# Sections of a herb page that are read; an absent one is empty.
PAGE_HEADERS = ["scientific_name", "clinical_summary", "purported_uses", "food_sources", "mechanism_of_action", "warnings", "adverse_reactions", "herb-drug_interactions"]


def _plain(c: Column) -> Column:
    """The text of a piece of HTML."""
    text_only = F.regexp_replace(c, r"(?s)<!--.*?-->|<[^>]*>", "")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text_only = F.replace(text_only, F.lit(entity), F.lit(sign))
    return text.strip(text_only)


def html_sections(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``<key>, header, bullets, body``: the known sections of HTML pages (``PAGE_HEADERS``).

    A section runs from the tag that carries its name (``data-listname``) to
    the next such tag; names are lower-cased and joined by '_'. Its bullets are
    the items of its first bullet list; without one its body is its whole text.
    A section that is absent has an empty body; of repeated ones the last
    counts. Null pages have empty sections.
    """
    block = F.lit(r'(?s)data-listname="([^"]*)"[^>]*>(.*?)(?=<[^<>]*data-listname="|\z)')
    found = F.arrays_zip(F.regexp_extract_all(html, block, 1).alias("h"), F.regexp_extract_all(html, block, 2).alias("b"))
    each = pages.select(key, F.posexplode(found).alias("pos", "s")).select(key, "pos", F.regexp_replace(F.lower(text.strip(F.col("s.h"))), " ", "_").alias("header"), F.col("s.b").alias("b"))
    last = each.where(F.col("header").isin(PAGE_HEADERS)).groupBy(key, "header").agg(F.max_by("b", "pos").alias("b"))
    listed = F.regexp_extract("b", r'(?s)<ul[^>]*class="[^"]*bullet-list[^"]*"[^>]*>(.*?)</ul>', 1)
    bullets = F.transform(F.regexp_extract_all(listed, F.lit(r"(?s)<li[^>]*>(.*?)</li>"), 1), _plain)
    has = F.col("b").rlike(r'(?s)<ul[^>]*class="[^"]*bullet-list')
    # the headline's own text stands before its closing tag
    inner = F.regexp_replace("b", r"(?s)\A[^<]*</[^>]*>", "")
    said = last.select(key, "header", F.when(has, bullets).alias("bullets"), F.when(~has, _plain(inner)).alias("body"))
    every = pages.select(key).distinct().withColumn("header", F.explode(F.array(*[F.lit(h) for h in PAGE_HEADERS])))
    joined = every.join(said, [key, "header"], "left")
    return joined.select(key, "header", "bullets", F.when(F.col("bullets").isNull(), F.coalesce("body", F.lit(""))).alias("body"))
