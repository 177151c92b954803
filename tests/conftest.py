import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def oracle():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


@pytest.fixture
def same(spark, data, oracle):
    """Compares a query with its SQL: columns, rows and values."""

    def check(query, sql):
        df = query(spark, data)
        columns = sorted(df.columns)
        mine = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
        wide = ", ".join(f'"{c}"' for c in columns)
        theirs = sorted(repr(tuple(r)) for r in oracle.execute(f"SELECT {wide} FROM ({sql})").fetchall())
        assert mine == theirs

    return check
