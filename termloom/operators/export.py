"""Publishing a knowledge base: relational files, property-graph tables, extension of a metathesaurus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom import runtime
from termloom.functions import text
from termloom.model import KB
from termloom.operators.link import _running
from termloom.operators.resolve import first_wins, resolve_objects
from termloom.sources.files import KEEP_BLANKS


def concept_ids(kb: KB) -> DataFrame:
    """``cidx, cui``: the concept's number under the prefix DC; numbers that collide are given anew after the highest."""
    c = kb.concepts.select("cidx", "num")
    high = F.coalesce(F.max("num"), F.lit(0)).alias("high")
    kept = runtime.durable(c.where("num is not null").groupBy("num").agg(F.min("cidx").alias("cidx")).select("cidx", "num"))
    again = c.select("cidx").join(kept, "cidx", "left_anti").withColumn("one", F.lit(1))
    fresh = _running(again, "cidx", "one").crossJoin(F.broadcast(c.agg(high)))
    fresh = fresh.select("cidx", (F.col("high") + 1 + F.col("start")).alias("num"))
    return kept.unionByName(fresh).select("cidx", text.ui("DC", F.col("num")).alias("cui"))


def _ids(prefix: str, *parts: str):
    return F.concat(F.lit(prefix), F.concat_ws("_", *parts))


def rrf(kb: KB, ids: DataFrame, preferred: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four files MRSTY, MRCONSO, MRSAT and MRREL as tables.

    Element ids are made of the concept's position and the element's place, so
    they are unique without a global count. Relationships to objects that are
    no concept, and their attributes, are left out.
    """
    hot = runtime.hot_keys(kb.atoms, "cidx")
    name = lambda d, spread: runtime.lookup(d, ids, "cidx", spread, hot, "inner")
    rels = resolve_objects(kb).where("object_cidx is not null")
    objects = ids.select(F.col("cidx").alias("object_cidx"), F.col("cui").alias("cui2"))
    rels = runtime.lookup(rels, objects, "object_cidx", F.col("cidx"), runtime.hot_keys(rels, "object_cidx"), "inner")
    own = kb.rel_attributes.join(rels.select("cidx", "ridx"), ["cidx", "ridx"], "left_semi")
    sat = name(kb.attributes, F.col("pos")).select(_ids("DAT", "cidx", "pos").alias("ATUI"), F.col("cui").alias("UI"), F.lit("DSCUI").alias("STYPE"), F.col("atr_name").alias("ATN"), F.col("atr_value").alias("ATV"), F.col("src").alias("SAB"))
    rel_sat = own.select(F.concat(F.lit("DAT"), F.concat_ws("_", "cidx", F.lit("R"), "ridx", "pos")).alias("ATUI"), _ids("DR", "cidx", "ridx").alias("UI"), F.lit("DSRUI").alias("STYPE"), F.col("atr_name").alias("ATN"), F.col("atr_value").alias("ATV"), F.col("src").alias("SAB"))
    return {
        "MRSTY": kb.concepts.join(ids, "cidx").select(F.col("cui").alias("CUI"), F.col("concept_type").alias("STY")),
        "MRCONSO": name(kb.atoms, F.col("pos")).select(
            F.col("cui").alias("CUI"), _ids("DA", "cidx", "pos").alias("AUI"), F.col("term").alias("STR"), F.col("term_type").alias("TTY"), F.col("src").alias("SAB"), F.col("src_id").alias("SCODE"), F.when(F.col("is_preferred"), "Y").otherwise("N").alias("ISPREF")
        ),
        "MRSAT": sat.unionByName(rel_sat),
        "MRREL": rels.join(ids, "cidx").select(_ids("DR", "cidx", "ridx").alias("RUI"), F.col("cui").alias("CUI1"), F.col("rel_name").alias("REL"), F.col("cui2").alias("CUI2"), F.col("src").alias("SAB")),
    }


def write_rrf(files: dict[str, DataFrame], path: str, line_end: str = "\n") -> None:
    """Pipe-delimited files with a header, one folder each; ``line_end`` may be CR LF.

    The format has no quotes: line ends and pipes inside a value become blanks.
    """
    for name, df in files.items():
        plain = df.select(*[F.regexp_replace(F.col(c).cast("string"), r"[\r\n|]", " ").alias(c) for c in df.columns])
        if line_end == "\n":
            plain.write.options(**KEEP_BLANKS).option("sep", "|").option("header", True).option("emptyValue", "").option("quote", "\u0000").csv(f"{path}/{name}.RRF")
        else:
            line = F.concat(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in plain.columns]), F.lit("\r"))
            plain.select(line).write.text(f"{path}/{name}.RRF")


def graph(kb: KB, preferred: DataFrame, ids: DataFrame, lists: bool = False) -> tuple[DataFrame, DataFrame]:
    """Nodes ``id, label, name, properties`` and edges ``src_id, type, dst_id, properties`` of the property graph.

    Of several values of one property the last is kept, or all of them with
    ``lists``. Synonyms are nodes of their own; edges to objects that are no
    concept are left out.
    """
    value = F.collect_list("atr_value") if lists else F.max_by("atr_value", "pos")
    props = kb.attributes.where("atr_name is not null").groupBy("cidx", "atr_name").agg(value.alias("v"))
    props = props.groupBy("cidx").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("atr_name", "v")))).alias("m")).select("cidx", F.to_json("m").alias("properties"))
    named = kb.concepts.join(ids, "cidx").join(preferred.select("cidx", F.col("term").alias("name")), "cidx", "left").join(props, "cidx", "left")
    nodes = named.select(F.col("cui").alias("id"), F.col("concept_type").alias("label"), "name", "properties")
    atoms = kb.atoms.join(kb.concepts.select("cidx", "concept_type"), "cidx").join(ids, "cidx").withColumn("aid", _ids("DA", "cidx", "pos"))
    detail = F.to_json(F.struct("src", "src_id", "is_preferred"))
    nodes = nodes.unionByName(atoms.select(F.col("aid").alias("id"), F.concat("concept_type", F.lit("_ATOM")).alias("label"), F.col("term").alias("name"), detail.alias("properties")))
    has = atoms.select(F.col("cui").alias("src_id"), F.lit("has_synonym").alias("type"), F.col("aid").alias("dst_id"), F.lit(None).cast("string").alias("properties"))
    own = kb.rel_attributes.where("atr_name is not null").groupBy("cidx", "ridx", "atr_name").agg(F.max_by("atr_value", "pos").alias("v"))
    own = own.groupBy("cidx", "ridx").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("atr_name", "v")))).alias("m")).select("cidx", "ridx", F.to_json("m").alias("properties"))
    rels = resolve_objects(kb).where("object_cidx is not null").join(own, ["cidx", "ridx"], "left").join(ids, "cidx")
    objects = ids.select(F.col("cidx").alias("object_cidx"), F.col("cui").alias("dst_id"))
    rels = runtime.lookup(rels, objects, "object_cidx", F.struct("cidx", "ridx"), runtime.hot_keys(rels, "object_cidx"), "inner")
    return nodes, has.unionByName(rels.select(F.col("cui").alias("src_id"), F.col("rel_name").alias("type"), "dst_id", "properties"))


CONSO = "CUI LAT TS LUI STT SUI ISPREF AUI SAUI SCUI SDUI SAB TTY CODE STR SRL SUPPRESS CVF END".split()
STY = "CUI TUI STN STY ATUI CVF".split()


def extend_metathesaurus(kb: KB, ids: DataFrame, conso: DataFrame, sty: DataFrame, types: DataFrame, sab: str, default_type: str = "phsu") -> dict[str, DataFrame]:
    """MRCONSO and MRSTY of a metathesaurus with the ingredients of a knowledge base added.

    ``conso`` and ``sty`` have the columns CONSO and STY, ``types`` is
    ``sources.files.read_semantic_types``. A CUI that an ingredient (SDSI) links
    to by a UMLS atom gets the prefix D; unlinked ingredients get new CUIs
    after the highest; each CUI gets its concepts' semantic types and the
    default type once. Rows of unknown semantic types are dropped.
    """
    mine = kb.concepts.where("concept_type = 'SDSI'").select("cidx")
    cuis = conso.select("CUI").distinct()
    links = kb.atoms.where("src = 'UMLS'").join(mine, "cidx", "left_semi").select("cidx", F.col("src_id").alias("CUI")).distinct().join(cuis, "CUI")
    linked = links.select("CUI").distinct().withColumn("hit", F.lit(True))
    prefixed = lambda d: d.join(linked, "CUI", "left").withColumn("CUI", F.when(F.col("hit"), F.concat(F.lit("D"), "CUI")).otherwise(F.col("CUI"))).drop("hit")
    high = conso.agg(F.max(F.regexp_replace("CUI", "[^0-9]", "").try_cast("bigint")).alias("high"))
    free = mine.join(links.select("cidx").distinct(), "cidx", "left_anti").withColumn("one", F.lit(1))
    fresh = _running(free, "cidx", "one").crossJoin(F.broadcast(high)).select("cidx", text.ui("DC", F.coalesce("high", F.lit(0)) + 1 + F.col("start")).alias("CUI"))
    owner = runtime.durable(links.select("cidx", F.concat(F.lit("D"), "CUI").alias("CUI")).unionByName(fresh))
    aid = F.concat_ws("_", "cidx", "pos")
    fixed = {"LAT": "ENG", "TS": "S", "STT": "PF", "ISPREF": "N", "SAUI": "", "SCUI": "", "SDUI": "", "SAB": sab, "SRL": "0", "SUPPRESS": "N", "CVF": "", "END": ""}
    own = {"CUI": F.col("NEW"), "LUI": F.concat(F.lit("DL"), aid), "SUI": F.concat(F.lit("DS"), aid), "AUI": F.concat(F.lit("DA"), aid), "TTY": F.col("term_type"), "CODE": F.col("KB_UI"), "STR": F.col("term")}
    added = owner.withColumnRenamed("CUI", "NEW").join(kb.atoms, "cidx").where("coalesce(src, '') <> 'UMLS'").where(~F.col("term").rlike(r"[^\x00-\x7F]")).join(ids.withColumnRenamed("cui", "KB_UI"), "cidx")
    added = added.select(*[own[c].alias(c) if c in own else F.lit(fixed[c]).alias(c) for c in CONSO])
    # semantic types: the metathesaurus' own (known ones), then the concepts', then the default
    known = F.broadcast(types)
    base = prefixed(sty.join(known.select(F.col("key").alias("TUI")), "TUI", "left_semi").select(*STY))
    have = base.select("CUI", "TUI").distinct()
    said = kb.attributes.where("atr_name = 'umls_semantic_type'").join(owner, "cidx").join(known, F.col("atr_value") == F.col("key")).select("CUI", F.col("code").alias("TUI"), F.col("tree").alias("STN"), F.col("long").alias("STY"))
    default = types.where(F.col("key") == default_type).select(F.col("code").alias("TUI"), F.col("tree").alias("STN"), F.col("long").alias("STY"))
    every = said.unionByName(owner.select("CUI").distinct().crossJoin(F.broadcast(default))).distinct().join(have, ["CUI", "TUI"], "left_anti")
    every = first_wins(every, ["CUI", "TUI"], ["STY"]).withColumn("key", F.concat_ws("|", "CUI", "TUI")).withColumn("one", F.lit(1))
    last = sty.agg(F.max(F.regexp_replace("ATUI", "[^0-9]", "").try_cast("bigint")).alias("last"))
    every = runtime.durable(every)
    numbered = every.join(_running(every.select("key", "one"), "key", "one"), "key").crossJoin(F.broadcast(last))
    numbered = numbered.select("CUI", "TUI", "STN", "STY", text.ui("DAT", F.coalesce("last", F.lit(0)) + 1 + F.col("start")).alias("ATUI"), F.lit("111").alias("CVF"))
    return {"MRCONSO": prefixed(conso.select(*CONSO)).unionByName(added), "MRSTY": base.unionByName(numbered), "new": fresh, "owner": owner}


def source_summary(kb: KB, sab: str, version: str) -> DataFrame:
    """One MRSAB-like row: the source with its counts of terms and of concepts."""
    mine = kb.atoms.join(kb.concepts.where("concept_type = 'SDSI'").select("cidx", "ui"), "cidx")
    return mine.agg(F.count(F.lit(1)).alias("TFR"), F.countDistinct("ui").alias("CFR")).select(F.lit(f"{sab}_v{version}").alias("VSAB"), F.lit(sab).alias("RSAB"), F.lit(version).alias("SVER"), "TFR", "CFR", F.lit("SN,CN,SY").alias("TTYL"), F.lit("ENG").alias("LAT"), F.lit("UTF-8").alias("CENC"), F.lit("Y").alias("CURVER"), F.lit("Y").alias("SABIN"))


def rank_table(ranks: DataFrame, sab: str) -> DataFrame:
    """``rank, SAB, TTY, suppress``: the given ranks raised by three, and the source's three term types as the lowest."""
    moved = ranks.withColumn("rank", F.format_string("%04d", F.col("rank").cast("int") + 3))
    own = ranks.sparkSession.createDataFrame([("0003", sab, "SN", "N"), ("0002", sab, "CN", "N"), ("0001", sab, "SY", "N")], "rank string, SAB string, TTY string, suppress string")
    return moved.select("rank", "SAB", "TTY", "suppress").unionByName(own)
