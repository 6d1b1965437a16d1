import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(value):
    """A value as both engines can be made to spell it."""
    if isinstance(value, float):
        return "nan" if value != value else repr(round(value, 6))
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if hasattr(value, "is_nan"):
        return repr(round(float(value), 6))
    return str(value)


@pytest.fixture(scope="session")
def same(duck):
    """Compares a frame with the rows of an SQL text, by column name and in any order."""

    def check(df, sql):
        columns = sorted(df.columns)
        rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
        found = duck.execute(sql)
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert rows == sorted(tuple(plain(x[i]) for i in at) for x in found.fetchall())

    return check
