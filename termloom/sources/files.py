"""Readers and writers of the exchange files."""

from __future__ import annotations

import configparser
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom import model, runtime


#: Writer's options under which blanks at the ends of a value stay.
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def strings(*names: str) -> str:
    return ", ".join(f"`{n}` string" for n in names)


def file_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``file, path, pos, line``: the lines of files, numbered from 0 within each; ``file`` is the argument's place.

    Numbers come from counts per file part (one row each), so no task holds a file.
    """
    parts = None
    for k, path in enumerate(paths):
        lines = spark.read.option("lineSep", "\n").text(path).select(F.lit(k).alias("file"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
        parts = lines if parts is None else parts.unionByName(lines)
    sizes = parts.groupBy("file", "path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file", "path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.withColumn("start", before).drop("n")
    return parts.join(F.broadcast(starts), ["file", "path", "block"]).select("file", "path", (F.col("start") + F.col("at") - F.col("low")).alias("pos"), "line")


def numbered_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``cidx, line``: the lines of the files in argument order, numbered from 0 through all of them."""
    lines = file_lines(spark, *paths)
    sizes = lines.groupBy("file", "path").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file", "path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return lines.join(F.broadcast(sizes.select("file", "path", before.alias("start"))), ["file", "path"]).select((F.col("start") + F.col("pos")).alias("cidx"), "line")


def read_concepts(spark: SparkSession, *paths: str) -> DataFrame:
    """Concept records of JSON Lines files with their position ``cidx``; broken lines carry ``_corrupt``."""
    record = F.from_json("line", model.RECORD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return numbered_lines(spark, *paths).select("cidx", "line", record.alias("r")).select("cidx", "line", "r.*")


def write_concepts(records: DataFrame, path: str) -> None:
    """Concept records as JSON Lines, in the order of ``cidx``."""
    columns = [c for c in ("ui", "concept_type", "synonyms", "attributes", "relationships") if c in records.columns]
    records.sort("cidx").select(F.to_json(F.struct(*columns))).write.text(path)


def read_connections(spark: SparkSession, path: str) -> DataFrame:
    """``i, j`` of a headerless CSV; a line of another shape fails the read."""
    return spark.read.schema("i bigint, j bigint").option("mode", "FAILFAST").csv(path)


def write_connections(pairs: DataFrame, path: str) -> None:
    pairs.select("i", "j").sort("i", "j").write.csv(path)


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """``_input_hash, answer, accept, i, j`` of annotation JSON Lines."""
    return spark.read.schema("_input_hash bigint, answer string, accept array<int>, i bigint, j bigint").json(path)


def write_annotation_tasks(tasks: DataFrame, path: str) -> None:
    tasks.write.json(path)


def read_rrf(spark: SparkSession, path: str, names: list[str], header: bool = False) -> DataFrame:
    """A pipe-delimited table, all strings."""
    reader = spark.read.schema(strings(*names)).option("sep", "|").option("header", header)
    return reader.option("emptyValue", "").option("quote", "\u0000").csv(path)


def read_semantic_types(spark: SparkSession, path: str, keep: list[str] | None = None) -> DataFrame:
    """``key, code, tree, short, long``: semantic types, once by code and once by short form; ``keep`` restricts long names."""
    rows = read_rrf(spark, path, ["kind", "code", "long", "tree", "c4", "c5", "c6", "c7", "short"])
    if keep:
        rows = rows.where(F.col("long").isin(keep))
    return rows.select("code", "tree", "short", "long", F.explode(F.array("code", "short")).alias("key")).dropDuplicates(["key"])


def read_text_csv(spark: SparkSession, path: str, names: list[str] | None = None, sep: str = ",", encoding: str = "UTF-8", header: bool = True, multiline: bool = True) -> DataFrame:
    """A CSV with all columns as strings; names come from the header or from ``names``.

    Quoted fields may hold line ends; a file is then one task. Without
    ``multiline`` files are split, and ``records.repair`` mends broken records.
    """
    reader = spark.read.option("sep", sep).option("encoding", encoding).option("multiLine", multiline).option("escape", '"').option("header", header)
    if names:
        reader = reader.schema(strings(*names))
    return reader.csv(path)


def flat_to_csv(spark: SparkSession, path: str, header_path: str, out: str) -> None:
    """A pipe-delimited Latin-1 file without header, and its header file, as one UTF-8 CSV."""
    names = [r[0].strip() for r in spark.read.text(header_path).collect() if r[0].strip()]
    read_text_csv(spark, path, names, sep="|", encoding="ISO-8859-1", header=False).write.options(**KEEP_BLANKS).option("header", True).option("escape", '"').csv(out)


def read_label_groups(spark: SparkSession, path: str) -> DataFrame:
    """``group_id, group_name, synonyms, category`` of a label database's CSV with a header: those columns, distinct rows, whole-number ids."""
    rows = read_text_csv(spark, path)
    column = lambda name: F.col(f"`{name}`")
    picked = rows.select(column("Ingredient - Group ID").cast("bigint").alias("group_id"), column("Ingredient - Group Name").alias("group_name"), column("Synonyms/Sources").alias("synonyms"), column("CATEGORY").alias("category"))
    return picked.distinct()


def read_label_products(spark: SparkSession, path: str) -> DataFrame:
    """Products of a label database's JSON Lines, with their array of ingredient groups."""
    return spark.read.schema("Product_Name string, DSLD_ID string, LanguaL_Product_Type string, ingredients array<struct<Ingredient_Group_GRP_ID:string>>").json(path)


def read_words(spark: SparkSession, path: str) -> list[str]:
    """The words of a list file, one a line, without blanks around them; empty lines go."""
    return [w.strip() for w in runtime.read_small(spark, path).splitlines() if w.strip()]


def source_ranks(settings: str, version: str) -> dict[str, list[str]]:
    """Vocabularies of a version in the text of an ini file; ``refer_to`` leads to another version's section."""
    ini = configparser.ConfigParser(allow_no_value=True)
    ini.optionxform = str
    ini.read_string(settings)
    seen: set[str] = set()
    while ini.has_option(version, "refer_to"):
        if version in seen:
            raise ValueError(f"refer_to goes in circles at {version}")
        seen.add(version)
        version = ini.get(version, "refer_to").strip()
    return {k: [x.strip() for x in (v or "").splitlines() if x.strip()] for k, v in ini.items(version)}


def vocabulary_table(spark: SparkSession, vocabularies: dict[str, list[str]]) -> DataFrame:
    """``vocabulary, rank, value`` of declared vocabularies, in their order from 1 (small, driver-made)."""
    rows = [(name, k, value) for name, values in vocabularies.items() for k, value in enumerate(values, 1)]
    return spark.createDataFrame(rows, "vocabulary string, rank int, value string")


def as_list(c: Column) -> Column:
    """A JSON text that is a string or a list of strings, as an array; others give null."""
    variant = F.try_parse_json(c)
    many = F.try_variant_get(variant, "$", "array<string>")
    one = F.try_variant_get(variant, "$", "string")
    return F.when(F.schema_of_variant(variant).startswith("ARRAY"), many).when(one.isNotNull() & (one != ""), F.array(one)).otherwise(F.array().cast("array<string>"))


# Node and edge statements of the schema language that are read.
_NODE = re.compile(r"CREATE\s*\(\s*(\w+)\s*:\s*(\w+)\s*(\{.*?\})?\s*\)\s*(?=;|\n|$)", re.S | re.I)
_EDGE = re.compile(r"CREATE\s*\(\s*(\w+)\s*\)\s*-\s*\[\s*\w*\s*:\s*(\w+)\s*(\{.*?\})?\s*\]\s*->\s*\(\s*(\w+)\s*\)", re.S | re.I)
_PROPERTY = re.compile(r"(\w+)\s*:\s*(\"[^\"]*\"|'[^']*'|\w+)")


def parse_schema(text: str) -> dict[str, dict[str, dict[str, str]]]:
    """``{"nodes": {label: properties}, "edges": {type: properties}}`` of the CREATE statements of a schema file."""
    nodes, edges = {}, {}
    read = lambda body: {k: v.strip("\"'") for k, v in _PROPERTY.findall(body or "")}
    for _, kind, body, _ in _EDGE.findall(text):
        edges[kind.upper()] = read(body)
    for _, label, body in _NODE.findall(_EDGE.sub("", text)):
        nodes[label.upper()] = read(body)
    return {"nodes": nodes, "edges": edges}


def schema_tables(spark: SparkSession, schema: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``label, links_to``; ``label, property``; ``edge, property`` of a parsed schema (small, driver-made)."""
    nodes = [(k, v.get("links_to")) for k, v in schema["nodes"].items()]
    props = [(k, p) for k, v in schema["nodes"].items() for p in v]
    edges = [(k, p) for k, v in schema["edges"].items() for p in [None, *v]]
    make = spark.createDataFrame
    return make(nodes, "label string, links_to string"), make(props, "label string, property string"), make(edges, "edge string, property string")


def create_schema(spark: SparkSession, text: str, path: str) -> None:
    """The tables of a schema text under ``path``; refused if anything is there already."""
    if runtime.exists(spark, path):
        raise FileExistsError(f"{path} is not empty")
    for name, df in zip(("labels", "properties", "edges"), schema_tables(spark, parse_schema(text))):
        df.write.parquet(f"{path}/{name}")


def linker_settings(text: str, registry: dict[str, type]) -> dict[str, tuple[type, dict]]:
    """``terminology -> (class, parameters)`` of a JSON text; classes come from ``registry``, never from the text."""
    out = {}
    for key, conf in json.loads(text).items():
        conf = dict(conf)
        name = conf.pop("class_name")
        if name not in registry:
            raise KeyError(f"no linker named {name}")
        out[key] = (registry[name], conf)
    return out
