"""The knowledge base as related tables, and its interchange record."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom import runtime

ATTRIBUTE = "struct<atr_name:string,atr_value:string,src:string>"
#: Interchange record; synonyms are maps, so that open keys survive.
RECORD = (
    f"ui string, concept_type string, synonyms array<map<string,string>>, attributes array<{ATTRIBUTE}>, "
    f"relationships array<struct<rel_name:string,object:string,src:string,attributes:array<{ATTRIBUTE}>>>, _corrupt string"
)
# Vocabularies of the domain.
SOURCES = ["UMLS", "MEDDRA", "NMCD", "MSKCC", "DSLD", "NHPID"]
TERM_TYPES = ["SN", "CN", "SY"]
CONCEPT_TYPES = ["SDSI", "DSP", "PD", "DIS", "TC", "SOC", "SS"]
OWN_KEYS = ["term", "src", "src_id", "term_type", "is_preferred"]


@dataclass(frozen=True)
class KB:
    """Concepts and their atoms, attributes (of concepts and of relationships) and relationships, tied by ``cidx``."""

    concepts: DataFrame
    atoms: DataFrame
    attributes: DataFrame
    rel_attributes: DataFrame
    relationships: DataFrame

    def map(self, f) -> KB:
        """``f(name, table)`` applied to every table."""
        return KB(**{x.name: f(x.name, getattr(self, x.name)) for x in fields(self)})


def from_records(rows: DataFrame) -> KB:
    """The tables of concept records (``cidx, ui, concept_type, synonyms, attributes, relationships``).

    Null or empty lists and null entries give no rows; an atom without a term
    gives none; places count all entries of a list; extra columns are ignored.
    """
    kind = dict(rows.select("synonyms").dtypes)["synonyms"]
    s = F.col("s")
    if "map<" in kind:
        extra = F.map_filter(s, lambda k, v: ~k.isin([*OWN_KEYS, "linking_score"]))
        preferred, score = s["is_preferred"] == "true", s["linking_score"].try_cast("double")
    else:
        preferred, score = s["is_preferred"], s["linking_score"].cast("double")
        extra = F.map_filter(F.create_map(F.lit("linked_string"), s["linked_string"]), lambda k, v: v.isNotNull())
    atoms = rows.select("cidx", F.posexplode("synonyms").alias("pos", "s")).where("s is not null")
    atoms = atoms.select(
        "cidx", "pos", s["term"].alias("term"), F.lower(s["term"]).alias("term_lc"), s["src"].alias("src"), s["src_id"].alias("src_id"),
        s["term_type"].alias("term_type"), F.coalesce(preferred, F.lit(False)).alias("is_preferred"), score.alias("linking_score"), extra.alias("attrs"),
    ).where("term is not null")
    a = F.col("a")
    attribute = [a["atr_name"].alias("atr_name"), a["atr_value"].alias("atr_value"), a["src"].alias("src")]
    attributes = rows.select("cidx", F.posexplode("attributes").alias("pos", "a")).where("a is not null").select("cidx", "pos", *attribute)
    rels = rows.select("cidx", F.posexplode("relationships").alias("ridx", "r")).where("r is not null")
    return KB(
        concepts=rows.select("cidx", "ui", F.regexp_extract("ui", r"^(.+)[0-9]{7}$", 1).alias("prefix"), F.regexp_extract("ui", r"([0-9]{7})$", 1).try_cast("bigint").alias("num"), "concept_type"),
        atoms=atoms,
        attributes=attributes,
        rel_attributes=rels.select("cidx", "ridx", F.posexplode("r.attributes").alias("pos", "a")).where("a is not null").select("cidx", "ridx", "pos", *attribute),
        relationships=rels.select("cidx", "ridx", F.col("r.rel_name").alias("rel_name"), F.col("r.object").alias("object_ui"), F.col("r.src").alias("src")),
    )


def to_records(kb: KB) -> DataFrame:
    """The interchange records of a knowledge base, one row per concept, lists in their order."""
    own = F.create_map(*[x for k in [*OWN_KEYS, "linking_score"] for x in (F.lit(k), F.col(k).cast("string"))])
    atom = F.map_concat(F.map_filter(own, lambda k, v: v.isNotNull()), F.coalesce("attrs", F.create_map().cast("map<string,string>")))
    ordered = lambda key, *cols: F.transform(F.array_sort(F.collect_list(F.struct(key, F.struct(*cols).alias("x")))), lambda e: e["x"])
    # a map cannot be ordered or compared, so it rides as JSON
    atoms = kb.atoms.withColumn("j", F.to_json(atom)).groupBy("cidx").agg(F.array_sort(F.collect_list(F.struct("pos", "j"))).alias("l"))
    atoms = atoms.select("cidx", F.transform("l", lambda e: F.from_json(e["j"], T.MapType(T.StringType(), T.StringType()))).alias("synonyms"))
    attributes = kb.attributes.groupBy("cidx").agg(ordered("pos", "atr_name", "atr_value", "src").alias("attributes"))
    own = kb.rel_attributes.groupBy("cidx", "ridx").agg(ordered("pos", "atr_name", "atr_value", "src").alias("attributes"))
    rels = kb.relationships.withColumnRenamed("object_ui", "object").join(own, ["cidx", "ridx"], "left")
    rels = rels.withColumn("attributes", F.coalesce("attributes", F.array().cast(f"array<{ATTRIBUTE}>")))
    rels = rels.groupBy("cidx").agg(ordered("ridx", "rel_name", "object", "src", "attributes").alias("relationships"))
    out = kb.concepts.select("cidx", "ui", "concept_type")
    for part in (atoms, attributes, rels):
        out = out.join(part, "cidx", "left")
    return out


def load(spark: SparkSession, sf_dir: str) -> KB:
    """The knowledge base that the table ``ingredients`` of a data directory holds."""
    return from_records(runtime.table(spark, sf_dir, "ingredients"))
