import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def same_rows(df, relation) -> None:
    """Rows of a DataFrame and of an executed DuckDB query are the same, whatever their order."""
    names = [c[0] for c in relation.description]
    assert sorted(df.columns) == sorted(names)
    show = lambda v: repr(v + 0.0) if isinstance(v, float) else str(v)
    ours = sorted([show(r[c]) for c in sorted(names)] for r in df.collect())
    theirs = sorted([show(r[names.index(c)]) for c in sorted(names)] for r in relation.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs
