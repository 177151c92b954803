"""Deeply nested records as flat tables, linked by interval containment.

A depth-first traversal gives every node of a record a pre-order and a
post-order number. One table per node type comes out; a node lies under another
when its interval lies inside the other's, so children find their parents
without copies of the parents' data.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom import runtime

#: List-valued keys of a concept record, by node type; a type's own lists are nested below it.
CONCEPT_TREE: dict = {
    "synonym": ("synonyms", {}),
    "attribute": ("attributes", {}),
    "relationship": ("relationships", {"rel_attribute": ("attributes", {})}),
}
NODE = "rec bigint, kind string, depth int, pre int, post int, pos int, body string"


def _refuse(token: str) -> None:
    raise ValueError(f"{token} is no JSON")


def parse_object(line: str | None) -> dict | None:
    """The object that ``line`` is as a whole, or None: broken, trailing text, no object, nested beyond Python's limit."""
    if not line:
        return None
    try:
        value = json.loads(line, parse_constant=_refuse)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def entries(value: object) -> Iterator[tuple[int, dict]]:
    """``place, object`` of the non-empty objects in a list field, however it is wrapped.

    A list may stand as it is, inside further lists, as JSON text, or as a
    lone object (place 0). Other entries are skipped but keep their place.
    """
    todo: list[tuple[int, object]] = [(0, value)]
    while todo:
        place, x = todo.pop()
        if isinstance(x, str):
            try:
                inner = json.loads(x, parse_constant=_refuse)
            except (ValueError, RecursionError):
                continue
            if isinstance(inner, (list, dict, str)):
                todo.append((place, inner))
        elif isinstance(x, dict):
            if x:
                yield place, x
        elif isinstance(x, list):
            todo.extend(reversed(list(enumerate(x))))


def label(record: dict, tree: Mapping = CONCEPT_TREE) -> Iterator[tuple[str, int, int, int, int, str]]:
    """``kind, depth, pre, post, pos, body`` of every node of one record; the root is of kind 'record'."""
    nodes: list[list] = []
    clock = 0

    def visit(kind: str, pos: int, obj: dict, kids: Mapping, depth: int) -> None:
        nonlocal clock
        lists = {field for field, _ in kids.values()}
        body = json.dumps({k: v for k, v in obj.items() if k not in lists}, ensure_ascii=False)
        node = [kind, depth, clock, 0, pos, body]
        nodes.append(node)
        clock += 1
        for name, (field, below) in kids.items():
            for place, child in entries(obj.get(field)):
                visit(name, place, child, below, depth + 1)
        node[3] = clock
        clock += 1

    visit("record", 0, record, tree, 0)
    for n in nodes:
        yield tuple(n)


def nodes(lines: DataFrame, key: str, text: str, tree: Mapping = CONCEPT_TREE) -> DataFrame:
    """``rec, kind, depth, pre, post, pos, body``: one row per node of every line that is one whole JSON object.

    ``rec`` is the line's ``key``. Numbers are per line; a node lies under
    another when ``pre`` is greater and ``post`` smaller. ``body`` holds the
    node's own scalar and unlisted fields as JSON.

    Edge cases: null, empty, broken or non-object lines give no rows; repeated
    lines give rows under each key; when a key occurs twice in an object the
    last counts, as JSON readers have it; an empty table gives no rows; extra
    columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for rec, line in zip(batch["rec"], batch["line"]):
                record = parse_object(line)
                if record is not None:
                    out.extend((rec, *n) for n in label(record, tree))
            yield pd.DataFrame(out, columns=["rec", "kind", "depth", "pre", "post", "pos", "body"])

    source = lines.select(F.col(key).cast("bigint").alias("rec"), F.col(text).alias("line")).where("rec is not null")
    return source.mapInPandas(run, NODE)


def levels(tree: Mapping = CONCEPT_TREE) -> int:
    """Depth of the deepest node type below the record."""
    return max((1 + levels(below) for _, below in tree.values()), default=0)


def parents(tree: DataFrame, deepest: int = levels()) -> DataFrame:
    """Adds ``parent_kind, parent_pos, parent_pre``: the innermost node whose interval contains the node's.

    One pass over each record in pre-order: the last node one level up that
    opened before is the parent, and its interval must contain the node's.
    """
    w = Window.partitionBy("rec").orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
    above = F.lit(None).cast("struct<pre:int,post:int,pos:int,kind:string>")
    for d in range(deepest):
        last = F.last(F.when(F.col("depth") == d, F.struct("pre", "post", "pos", "kind")), ignorenulls=True).over(w)
        above = F.when(F.col("depth") == d + 1, last).otherwise(above)
    with_above = tree.withColumn("__up", above)
    inside = (F.col("__up.pre") < F.col("pre")) & (F.col("post") < F.col("__up.post"))
    up = F.when(inside, F.col("__up"))
    return with_above.withColumn("__up", up).select(
        *tree.columns, F.col("__up.kind").alias("parent_kind"), F.col("__up.pos").alias("parent_pos"), F.col("__up.pre").alias("parent_pre")
    )


def children(lines: DataFrame, key: str, text: str) -> DataFrame:
    """Every node of a concept record below the record itself, with its parent's place (see ``nodes``)."""
    return parents(nodes(lines, key, text)).where("depth > 0")


def flat_tables(lines: DataFrame, key: str, text: str) -> dict[str, DataFrame]:
    """One table per node type: concepts, synonyms, attributes, relationships and relationship attributes."""
    tree = runtime.durable(parents(nodes(lines, key, text)))
    out = {}
    columns = {
        "record": ["ui", "concept_type"],
        "synonym": ["term", "src", "src_id", "term_type", "is_preferred", "linked_string", "linking_score"],
        "attribute": ["atr_name", "atr_value", "src"],
        "relationship": ["rel_name", "object", "src"],
        "rel_attribute": ["atr_name", "atr_value", "src"],
    }
    for kind, names in columns.items():
        fields = [F.get_json_object("body", f"$.{n}").alias(n) for n in names]
        out[kind] = tree.where(F.col("kind") == kind).select("rec", "pre", "post", "pos", "parent_pre", "parent_pos", *fields)
    return out


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = children(runtime.table(spark, sf_dir, "ingredients_jsonl"), "line_no", "line")
    up = F.when(F.col("parent_kind") == "relationship", F.col("parent_pos")).otherwise(F.lit(-1))
    return found.select(F.col("rec").alias("line_no"), F.col("kind").alias("child"), up.alias("parent_pos"), "pos")


def p2_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The synonym table with its parent concept found by interval containment."""
    flat = flat_tables(runtime.table(spark, sf_dir, "ingredients_jsonl"), "line_no", "line")
    concept = flat["record"].select("rec", "pre", "ui", "concept_type")
    child = flat["synonym"].select("rec", F.col("parent_pre").alias("pre"), "pos", "term", "term_type")
    return child.join(concept, ["rec", "pre"]).select(F.col("rec").alias("line_no"), "ui", "concept_type", "pos", "term", "term_type")
