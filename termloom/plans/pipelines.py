"""Whole pipelines composed of operators."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import DataFrame, SparkSession

from termloom import model, runtime
from termloom.model import KB
from termloom.operators import export, link, resolve
from termloom.sources import files


MERGED = "concepts/concepts_merged.jsonl"


def load_kb(spark: SparkSession, folder: str) -> tuple[KB, dict[str, list[str]]]:
    """The merged concepts of a version folder, and the vocabularies of its version (none without ``config/kb.ini``)."""
    if not runtime.exists(spark, f"{folder}/.version"):
        raise FileNotFoundError(f"{folder} is no version folder: it has no .version")
    version = runtime.read_small(spark, f"{folder}/.version").strip()
    settings = f"{folder}/config/kb.ini"
    known = files.source_ranks(runtime.read_small(spark, settings), version) if runtime.exists(spark, settings) else {}
    return model.from_records(files.read_concepts(spark, f"{folder}/{MERGED}").where("ui is not null")), known


def make_version(spark: SparkSession, folder: str, version: str, settings: str | None = None) -> None:
    """A new version folder, with its settings if given."""
    runtime.write_small(spark, f"{folder}/.version", f"{version}\n")
    if settings is not None:
        runtime.write_small(spark, f"{folder}/config/kb.ini", settings)


def concat_sources(spark: SparkSession, paths: list[str], out: str) -> None:
    """The concept lines of several sources as one set of files, in argument order."""
    files.numbered_lines(spark, *paths).sort("cidx").select("line").write.text(out)


def release(folder: str, out: str) -> str:
    """A zip of a version's release folder (on the driver's own disk)."""
    return shutil.make_archive(out, "zip", os.path.join(folder, "release"))


def resolve_kb(kb: KB, connections: DataFrame | None = None, ignore_types: tuple[str, ...] = (), dedupe: bool = False) -> KB:
    """Union: concepts that ``connections`` (or shared terms, if None) link, merged. An empty table links nothing."""
    links = resolve.stars(resolve.typed_terms(kb, ignore_types)) if connections is None else connections
    return resolve.merge(kb, resolve.union_roots(kb, links), dedupe)


def link_kb(kb: KB, ranks: DataFrame, labels: DataFrame, linkers: dict[str, link.Linker], top_n: int = 1) -> KB:
    """Entity linking: preferred terms to their type's terminology, concepts rewritten by what was found."""
    queries = runtime.durable(link.linkables(kb, resolve.preferred_atoms(kb, ranks), labels))
    best = runtime.durable(link.route(queries, linkers, top_n))
    return link.rewrite(kb, queries, best)


def publish(kb: KB, ranks: DataFrame, path: str) -> None:
    """The four relational files and the graph's tables under ``path``."""
    ids = runtime.durable(export.concept_ids(kb))
    preferred = runtime.durable(resolve.preferred_atoms(kb, ranks))
    export.write_rrf(export.rrf(kb, ids, preferred), path)
    nodes, edges = export.graph(kb, preferred, ids)
    nodes.write.parquet(f"{path}/nodes")
    edges.write.parquet(f"{path}/edges")
