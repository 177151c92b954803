"""From source tables to knowledge bases: a product registry, a label database, herb pages.

Every builder gives the tables of a ``KB``; ``model.to_records`` makes interchange
records of them. Concepts are numbered from 1 under the source's prefix, in the
order stated, so numbers do not depend on how the data are spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom import runtime
from termloom.functions import text
from termloom.model import KB
from termloom.operators.resolve import first_wins
from termloom.sources import converters

# Names of label groups that are no ingredients.
DENIED = ["header", "fat calories", "polyunsaturated fat"]
NO_ATTRIBUTES = "cidx bigint, ridx int, pos int, atr_name string, atr_value string, src string"


def _place(*order: str | Column, within: str = "cidx") -> Column:
    return (F.row_number().over(Window.partitionBy(within).orderBy(*order)) - 1).cast("int")


def _concepts(keys: DataFrame, order: list[str], prefix: str, concept_type: str | Column) -> DataFrame:
    """``keys`` with ``cidx, ui, prefix, num, concept_type`` in the given order."""
    kind = F.lit(concept_type) if isinstance(concept_type, str) else concept_type
    placed = runtime.positions(keys, order, "cidx")
    num = (F.col("cidx") + 1).cast("bigint")
    return runtime.durable(placed.withColumn("ui", text.ui(prefix, num)).withColumn("prefix", F.lit(prefix)).withColumn("num", num).withColumn("concept_type", kind))


def _atoms(atoms: DataFrame, src: str, order: list[str]) -> DataFrame:
    """Atoms of ``cidx, term, src_id, term_type, is_preferred``: the first of equal ones by ``order``, in that order."""
    kept = first_wins(atoms.withColumn("term_lc", F.lower("term")), ["cidx", "term_lc", "src_id", "term_type"], order)
    none = F.create_map().cast("map<string,string>")
    return kept.select("cidx", _place(*order).alias("pos"), "term", "term_lc", F.lit(src).alias("src"), "src_id", "term_type", "is_preferred", F.lit(None).cast("double").alias("linking_score"), none.alias("attrs"))


def _kb(concepts: DataFrame, atoms: DataFrame, attributes: DataFrame, relationships: DataFrame) -> KB:
    none = concepts.sparkSession.createDataFrame([], NO_ATTRIBUTES)
    own = concepts.select("cidx", "ui", "prefix", "num", "concept_type")
    return KB(own, runtime.durable(atoms), runtime.durable(attributes), none, runtime.durable(relationships))


def registry_kb(rows: DataFrame, products: DataFrame) -> KB:
    """Ingredients and products of a registry, with edges both ways.

    Rows of one ``ingredient_id`` are one ingredient (SDSI): names of its rows
    in their order, the source material of its first row, an ``ingredient_of``
    edge to each known product. A product (DSP) has the names given under its
    id and a ``has_ingredient`` edge to each of its ingredients. Ingredients
    come first, by their first row; then products, by id.

    Edge cases: rows without a valid proper name, products without an id or a
    name, and edges to unknown products are left out; repeated rows count once.
    """
    src = "NHPID"
    names = runtime.durable(converters.registry_names(rows))
    first = names.groupBy("src_id").agg(F.min("row_id").alias("first"))
    made = products.select(text.source_id(F.col("product_id")).alias("src_id"), text.squeeze(F.col("product_name")).alias("term")).where("src_id is not null and term <> ''").distinct()
    made = runtime.durable(made)
    keys = first.select(F.lit("SDSI").alias("kind"), F.lit(0).alias("part"), "first", "src_id").unionByName(made.select(F.lit("DSP").alias("kind"), F.lit(1).alias("part"), F.lit(0).cast("bigint").alias("first"), "src_id").distinct())
    concepts = _concepts(keys, ["part", "first", "src_id"], src, F.col("kind"))
    ingredient, product = (concepts.where(F.col("part") == k).select("src_id", "cidx", "ui") for k in (0, 1))
    own = runtime.lookup(names, ingredient.select("src_id", "cidx"), "src_id", F.col("row_id"), runtime.hot_keys(names, "src_id"), "inner")
    atoms = _atoms(own.withColumn("is_preferred", F.col("col") == 0), src, ["row_id", "col"])
    named = made.join(product.select("src_id", "cidx"), "src_id").withColumn("term_type", F.lit("SY")).withColumn("is_preferred", F.lit(True))
    atoms = atoms.unionByName(_atoms(named, src, ["term"]))
    material = converters.registry_attributes(rows).join(concepts.where("part = 0").select(F.col("first").alias("row_id"), "cidx"), "row_id")
    attributes = material.select("cidx", F.lit(0).alias("pos"), "atr_name", "atr_value", F.lit(src).alias("src"))
    pairs = converters.registry_rows(rows).select(text.source_id(F.coalesce("ingredient_id", F.lit(""))).alias("src_id"), text.source_id(F.col("product_id")).alias("product"), "row_id")
    pairs = runtime.durable(pairs.where("product is not null").groupBy("src_id", "product").agg(F.min("row_id").alias("row_id")))
    edges = runtime.lookup(pairs, product.select(F.col("src_id").alias("product"), F.col("cidx").alias("to"), F.col("ui").alias("to_ui")), "product", F.col("row_id"), runtime.hot_keys(pairs, "product"), "inner")
    edges = runtime.durable(runtime.lookup(edges, ingredient, "src_id", F.col("to"), runtime.hot_keys(pairs, "src_id"), "inner"))
    forth = edges.select("cidx", _place("row_id", "to").alias("ridx"), F.lit("ingredient_of").alias("rel_name"), F.col("to_ui").alias("object_ui"), F.lit(src).alias("src"))
    back = edges.select(F.col("to").alias("cidx"), _place("cidx", within="to").alias("ridx"), F.lit("has_ingredient").alias("rel_name"), F.col("ui").alias("object_ui"), F.lit(src).alias("src"))
    return _kb(concepts, atoms, attributes, forth.unionByName(back))


def label_kb(groups: DataFrame, products: DataFrame, filter_words: Sequence[str] = (), denied: Sequence[str] = DENIED) -> KB:
    """Ingredient groups and products of a label database.

    ``groups`` is as ``converters.label_synonyms`` takes it; ``products`` has
    ``Product_Name, DSLD_ID, LanguaL_Product_Type, ingredients`` (an array of
    structs with ``Ingredient_Group_GRP_ID``). A group (SDSI) has its name and
    cleaned synonyms, and its category; groups named in ``denied`` (whatever
    the case) are left out. A product (DSP) has its type and a
    ``has_ingredient`` edge to each known group. Groups come first, by id and
    name; then products, by id and name.

    Edge cases: groups without a synonym left, products without an id or a
    name, and edges to unknown groups are left out; repeated rows count once.
    """
    src = "DSLD"
    made = converters.label_synonyms(groups, filter_words).withColumn("src_id", F.col("group_id").cast("string"))
    made = runtime.durable(made.where(~F.lower("group_name").isin([d.lower() for d in denied])))
    sold = products.select(F.col("DSLD_ID").cast("string").alias("src_id"), F.col("Product_Name").alias("name"), F.col("LanguaL_Product_Type").alias("detail"), F.col("ingredients.Ingredient_Group_GRP_ID").cast("array<string>").alias("parts"))
    sold = runtime.durable(sold.where("src_id is not null and name is not null").distinct())
    mine = made.select(F.lit("SDSI").alias("kind"), F.lit(0).alias("part"), "src_id", F.col("group_name").alias("name"), F.col("category").alias("detail"), F.col("synonyms").alias("list"))
    keys = mine.unionByName(sold.select(F.lit("DSP").alias("kind"), F.lit(1).alias("part"), "src_id", "name", "detail", F.col("parts").alias("list")))
    concepts = _concepts(keys, ["part", "src_id", "name", "detail", "list"], src, F.col("kind"))
    named = F.when(F.col("part") == 0, F.concat(F.array("name"), F.filter("list", lambda x: x != ""))).otherwise(F.array("name"))
    atoms = concepts.select("cidx", "src_id", F.posexplode(named).alias("at", "term"))
    # a group's name stands once, whatever its case
    atoms = _atoms(atoms.withColumn("term_type", F.lit("SY")).withColumn("is_preferred", F.col("at") == 0), src, ["at"])
    said = F.when(F.col("part") == 0, text.strip(F.col("detail"))).otherwise(F.col("detail"))
    attributes = concepts.where("detail <> ''").select("cidx", F.lit(0).alias("pos"), F.when(F.col("part") == 0, "ingredient_category").otherwise("langual_type").alias("atr_name"), said.alias("atr_value"), F.lit(src).alias("src"))
    # the last group of an id is the one an edge means
    target = concepts.where("part = 0").groupBy(F.col("src_id").alias("to")).agg(F.max_by("ui", "cidx").alias("object_ui"))
    wants = concepts.where("part = 1").select("cidx", F.posexplode("list").alias("at", "to"))
    edges = runtime.lookup(wants, target, "to", F.col("cidx"), runtime.hot_keys(wants, "to"), "inner").groupBy("cidx", "object_ui").agg(F.min("at").alias("at"))
    rels = edges.select("cidx", _place("at").alias("ridx"), F.lit("has_ingredient").alias("rel_name"), "object_ui", F.lit(src).alias("src"))
    return _kb(concepts, atoms, attributes, rels)


def herb_kb(pages: DataFrame, key: str = "page", line: str = "line") -> KB:
    """Herbs of page records, and the diseases, signs and drugs they name.

    A herb (SDSI) has the names and attributes of ``converters.herb_pages``;
    each value of an edge section is a concept of its own, which the herb
    points to. Per page the values come first, by section and place, then the
    herb.

    Edge cases: a page without a herb's name, or whose ``line`` is no JSON, is
    left out; null keys are ignored; repeated pages are concepts each.
    """
    src = "MSKCC"
    stated = runtime.durable(converters.herb_pages(pages.where(F.col(key).isNotNull()), key, line).withColumnRenamed(key, "page"))
    herbs = stated.where("place = 0").select("page").distinct()
    stated = stated.join(herbs, "page", "left_semi")
    values = stated.where("role = 'edge'").select("page", F.lit(0).alias("last"), "place", "pos", F.col("object_type").alias("kind"), "name", "value")
    own = herbs.select("page", F.lit(1).alias("last"), F.lit(0).alias("place"), F.lit(0).alias("pos"), F.lit("SDSI").alias("kind"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("value"))
    concepts = _concepts(values.unionByName(own), ["page", "last", "place", "pos"], src, F.col("kind"))
    herb = concepts.where("last = 1").select("page", "cidx")
    named = stated.where("role = 'atom'").join(herb, "page").select("cidx", "place", "pos", F.col("value").alias("term"), F.col("name").alias("term_type"), (F.col("place") == 0).alias("is_preferred"))
    each = named.unionByName(concepts.where("last = 0").select("cidx", "place", "pos", F.col("value").alias("term"), F.lit("SY").alias("term_type"), F.lit(False).alias("is_preferred")))
    atoms = _atoms(each.withColumn("src_id", F.lit("0")), src, ["place", "pos"])
    told = stated.where("role = 'attribute'").join(herb, "page")
    attributes = told.select("cidx", _place("place", "pos").alias("pos"), F.col("name").alias("atr_name"), F.col("value").alias("atr_value"), F.lit(src).alias("src"))
    edges = concepts.where("last = 0").select("page", "place", "pos", "name", F.col("ui").alias("object_ui")).join(herb, "page")
    rels = edges.select("cidx", _place("place", "pos").alias("ridx"), F.col("name").alias("rel_name"), "object_ui", F.lit(src).alias("src"))
    return _kb(concepts, atoms, attributes, rels)


def flat_records(kb: KB) -> DataFrame:
    """``ui, concept_type, synonyms, attributes, relationships``: records with each list as one text, in order."""
    line = lambda *c: F.concat_ws("|", *[F.coalesce(F.col(x).cast("string"), F.lit("")) for x in c])
    listed = lambda df, at, name, *c: df.groupBy("cidx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, line(*c).alias("x")))), lambda e: e["x"]), "; ").alias(name))
    out = kb.concepts.select("cidx", "ui", "concept_type")
    out = out.join(listed(kb.atoms, "pos", "synonyms", "term", "src", "src_id", "term_type", "is_preferred"), "cidx", "left")
    out = out.join(listed(kb.attributes, "pos", "attributes", "atr_name", "atr_value", "src"), "cidx", "left")
    return out.join(listed(kb.relationships, "ridx", "relationships", "rel_name", "object_ui", "src"), "cidx", "left").drop("cidx")
