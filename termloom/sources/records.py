"""Repair of delimited files whose records were broken over lines or carry too many fields.

Every line is a function from the state before it (inside quotes or not, fields
so far, one more when the record is beyond its last) to the state after it. Quotes and commas of a line are counted by column
functions; the functions of a block of lines are composed into one, blocks are
chained in order (one small row each), and each block then cuts its own lines
from its known start. No task holds a file.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import runtime
from termloom.sources import files

#: Lines of a block.
BLOCK_LINES = 100_000
#: Characters behind a line's end in which the next record's number must begin.
REACH = 6

_MARK = re.compile('[",]')
_NUMERAL = re.compile(r"\d", re.ASCII)
STEPS = "path string, block bigint, quoted array<int>, fields array<int>, ended array<bigint>"
PIECES = "path string, record bigint, pos bigint, piece string"


def _near(lines: list[str], own: int) -> list[bool]:
    """For each of the first ``own`` lines whether a digit is near behind it, or nothing."""
    near, after = [False] * own, ""
    for k in range(len(lines) - 1, -1, -1):
        if k < own:
            near[k] = k == len(lines) - 1 or _NUMERAL.search(after) is not None
        after = f"{lines[k]}\n{after}"[:REACH]
    return near


def _block(pdf: pd.DataFrame) -> tuple[pd.DataFrame, list[bool]]:
    """A block's own lines in order and ``_near`` of them; lines of the next block stand behind."""
    pdf = pdf.sort_values("pos")
    own = pdf[~pdf["ahead"]]
    return own, _near(pdf["line"].tolist(), len(own))


def _compose(columns: int):
    """The function of a block: for every start state the state after it and the records ended."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own, near = _block(pdf)
        most = columns + 1
        quoted = np.repeat(np.array([0, 1]), most)
        fields = np.tile(np.arange(1, most + 1), 2)
        ended = np.zeros(2 * most, dtype=np.int64)
        for odd, plain, turned, close in zip(own["odd"].tolist(), own["plain"].tolist(), own["turned"].tolist(), near):
            fields = np.minimum(fields + np.where(quoted == 0, plain, turned), most)
            if odd:
                quoted = 1 - quoted
            if close:
                ends = (quoted == 0) & (fields >= columns)
                ended += ends
                fields = np.where(ends, 1, fields)
        return pd.DataFrame({"path": [pdf["path"].iloc[0]], "block": [pdf["block"].iloc[0]], "quoted": [quoted.tolist()], "fields": [fields.tolist()], "ended": [ended.tolist()]})

    return run


def _cut(line: str, quoted: int, fields: int, columns: int) -> tuple[str, int, int]:
    """A line up to the comma beyond the last field, and the state after it."""
    end = 0 if fields > columns else len(line)
    for m in _MARK.finditer(line):
        if m[0] == '"':
            quoted = 1 - quoted
        elif not quoted and fields <= columns:
            fields += 1
            if fields > columns:
                end = m.start()
    return line[:end], quoted, fields


def _pieces(columns: int):
    """What every line of a block adds to its record."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own, near = _block(pdf)
        quoted, fields, record = (int(own[c].iloc[0]) for c in ("quoted", "fields", "record"))
        out = []
        for pos, line, close in zip(own["pos"].tolist(), own["line"].tolist(), near):
            piece, quoted, fields = _cut(line, quoted, fields, columns)
            out.append((own["path"].iloc[0], record, pos, piece))
            if close and not quoted and fields >= columns:
                record, fields = record + 1, 1
        return pd.DataFrame(out, columns=["path", "record", "pos", "piece"])

    return run


def repair(lines: DataFrame, columns: int, block: int = BLOCK_LINES) -> DataFrame:
    """``path, pos, record``: the records of delimited files, put together from their lines (``path, pos, line``).

    Quotes toggle wherever they stand. A line's end ends the record if it is
    outside quotes, all fields are there, and a digit is near behind it or
    nothing more; other line ends are dropped. A comma beyond the last field
    and what follows it in the record are dropped.

    Edge cases: an empty file has no record; what is left at a file's end is a
    record unless it is empty; a quote that is never closed takes the rest of
    its file; null lines are ignored.
    """
    block = max(block, REACH)
    parts = F.split("line", '"')
    commas = lambda x: F.length(x) - F.length(F.replace(x, F.lit(","), F.lit("")))
    total = lambda odd: F.aggregate(F.transform(F.filter(parts, lambda _, k: k % 2 == odd), commas), F.lit(0), lambda a, x: a + x)
    placed = lines.where("line is not null").select("path", "pos", "line", ((F.size(parts) - 1) % 2).alias("odd"), total(0).alias("plain"), total(1).alias("turned"))
    mine = F.floor(F.col("pos") / block)
    # the first lines of a block are also seen from the one before
    seen = F.when((F.col("pos") % block < REACH) & (mine > 0), F.array(mine, mine - 1)).otherwise(F.array(mine))
    placed = runtime.durable(placed.withColumn("block", F.explode(seen)).withColumn("ahead", F.col("block") < mine))
    steps = placed.groupBy("path", "block").applyInPandas(_compose(columns), STEPS)
    # one row per block of lines
    state: dict[str, tuple[int, int, int]] = {}
    starts = []
    for r in sorted(steps.collect(), key=lambda r: (r["path"], r["block"])):
        quoted, fields, record = state.get(r["path"], (0, 1, 0))
        starts.append((r["path"], r["block"], quoted, fields, record))
        k = quoted * (columns + 1) + fields - 1
        state[r["path"]] = (r["quoted"][k], r["fields"][k], record + r["ended"][k])
    begun = lines.sparkSession.createDataFrame(starts, "path string, block bigint, quoted int, fields int, record bigint")
    pieces = placed.join(F.broadcast(begun), ["path", "block"]).groupBy("path", "block").applyInPandas(_pieces(columns), PIECES)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), "")
    records = pieces.groupBy("path", "record").agg(joined.alias("text"))
    return records.where("text <> ''").select("path", F.col("record").alias("pos"), F.col("text").alias("record"))


def repair_files(spark: SparkSession, path: str, columns: int) -> DataFrame:
    """``path, pos, record``: the repaired records of every file."""
    return repair(files.file_lines(spark, path), columns)
