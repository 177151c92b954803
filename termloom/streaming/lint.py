"""Lint of concept lines as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.operators import quality


def broken_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the lines, in files that arrive in ``folder``, that are no JSON object."""
    lines = spark.readStream.schema("value string").format("text").load(folder)
    return quality.lint_lines(lines.select(F.col("value").alias("line")), "line", "line")
