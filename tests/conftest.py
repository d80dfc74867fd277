import datetime
import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hazeframe.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    s = local_session("8", partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture()
def split(spark):
    """Make every group of more than 50 rows count as too large for one task."""
    spark.conf.set("spark.hazeframe.groupRowLimit", "50")
    yield spark
    spark.conf.unset("spark.hazeframe.groupRowLimit")


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_cell(r[c]) for c in cols) for r in df.collect())


def rows_of_sql(con, text):
    cur = con.execute(text)
    names = [d[0] for d in cur.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted(tuple(_cell(r[i]) for i in at) for r in cur.fetchall())
