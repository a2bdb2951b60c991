import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("TZ", "UTC")

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marlstone.session import get_spark

    s = get_spark("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def rows_of(df):
    """Rows as a sorted list of text, columns by name: for comparing without regard to order."""
    names = sorted(df.columns)
    return sorted(repr([r[c] for c in names]) for r in df.collect())
