"""Shared plumbing: table loading, durable intermediate tables, skew-proof lookups.

Nothing here depends on the size of the data: hot keys are found by share (so
their number is bounded by 1 / share), and intermediate results go to the
shared checkpoint folder, where they outlive the loss of executors.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A key is hot when it holds at least this share of the rows; at most 1 / HOT_SHARE keys can be.
HOT_SHARE = 0.001
#: Below this many rows a key is never worth salting.
HOT_ROWS = 20_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application, so that no path need be shared."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = os.path.dirname(os.path.abspath(__file__))
    with tempfile.TemporaryDirectory() as folder:  # the driver's own; Spark copies the archive
        copy = os.path.join(folder, "content", os.path.basename(package))
        shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
        archive = shutil.make_archive(os.path.join(folder, "termloom-package"), "zip", os.path.join(folder, "content"))
        kept = os.path.join(tempfile.mkdtemp(prefix="termloom-"), "termloom-package.zip")
        shutil.copy(archive, kept)
    atexit.register(shutil.rmtree, os.path.dirname(kept), True)
    spark.sparkContext.addPyFile(kept)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a local one is set only where the session names none."""
    sc = spark.sparkContext
    where = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="termloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(where)
    return where


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM may be gone already
        pass


def scratch(spark: SparkSession) -> str:
    """A new folder's path in the shared folder; removed when the process ends."""
    path = f"{shared_dir(spark)}/termloom-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _file(spark: SparkSession, path: str) -> tuple:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system."""
    fs, p = _file(spark, path)
    return fs.exists(p)


def read_small(spark: SparkSession, path: str) -> str:
    """The text of one small file (settings, a schema) on whatever file system."""
    fs, p = _file(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """One small file on whatever file system; its folders are made, an old one is replaced."""
    fs, p = _file(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Cuts the lineage, gives Catalyst true sizes, and survives lost executors.
    The files are removed when the process ends.
    """
    spark = df.sparkSession
    ship(spark)
    path = scratch(spark)
    df.write.option("compression", "zstd").parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._termloom_path = path
    return kept


def drop(*tables: DataFrame) -> None:
    """Remove the files of tables that ``durable`` wrote and nothing reads any more."""
    for df in tables:
        _remove(df.sparkSession, df._termloom_path)


#: Rows of a range that ``positions`` numbers in one task.
RANGE_ROWS = 200_000


def positions(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its rows numbered from 0 in the order of columns that together are unique.

    Numbers come from counts of ranges (one row each), so no task holds all rows.
    """
    parts = max(1, -(-df.count() // RANGE_ROWS))
    placed = durable(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).select("__part", before.alias("__start"))
    at = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return placed.withColumn("__at", at).join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")


def frame(columns: dict) -> pd.DataFrame:
    """A pandas frame for a task's output; an empty list becomes a column of objects, which fits any type."""
    return pd.DataFrame({k: pd.Series(v, dtype=object) if isinstance(v, list) and not v else v for k, v in columns.items()})


def hot_keys(df: DataFrame, key: str, total: int | None = None, weight: Column | None = None) -> list:
    """Values of ``key`` that hold at least HOT_SHARE of the rows (at most 1 / HOT_SHARE of them)."""
    if total is None:
        total = df.count()
    least = max(HOT_ROWS, int(total * HOT_SHARE))
    if total < least:
        return []
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return [r[0] for r in df.where(F.col(key).isNotNull()).groupBy(key).agg(n.alias("n")).where(F.col("n") >= least).select(key).collect()]


def lookup(left: DataFrame, right: DataFrame, key: str, spread: Column, hot: list, how: str = "left") -> DataFrame:
    """Equi-join ``left`` to ``right`` on ``key`` with hot keys (and nulls) spread over salted copies.

    ``spread`` is an expression over ``left`` that varies within a key (a row
    id); the right rows of a hot key are copied to every salt, so one key never
    fills one task. A key that is not hot is joined as usual, and a left join
    spreads null keys too.
    """
    salts = max(2, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    if not hot:
        if how == "left":
            left = left.withColumn("__salt", F.when(F.col(key).isNull(), salt).otherwise(F.lit(0)))
            return left.join(right.withColumn("__salt", F.lit(0)), [key, "__salt"], how).drop("__salt")
        return left.join(right, key, how)
    is_hot = F.col(key).isin(hot)
    left = left.withColumn("__salt", F.when(is_hot | F.col(key).isNull(), salt).otherwise(F.lit(0)))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return left.join(right.withColumn("__salt", F.explode(copies)), [key, "__salt"], how).drop("__salt")


def blank(c: Column) -> Column:
    """True for null and for text of nothing but white space of any sort."""
    return c.isNull() | ~c.rlike(r"(?U)[^\s\p{Z}\p{Cf}]")


def squash(c: Column) -> Column:
    """Runs of any white space become one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\p{Z}]+", " "))
