import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    # workers import from the repository and from the folder of tests, whatever the caller has set
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (sys.path[0], os.path.dirname(os.path.abspath(__file__)), os.environ.get("PYTHONPATH"))))
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def same_rows(got, wanted) -> None:
    """Equal columns and equal rows in any order, numbers as numbers."""

    def plain(v):
        if v is None or v != v:
            return None
        if isinstance(v, bool) or type(v).__name__ in ("bool", "bool_"):
            return bool(v)
        return round(float(v), 6) if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)

    def rows(df):
        df = df[sorted(df.columns)].astype(object)
        df = df.where(df.notna(), None)
        return sorted((tuple(map(plain, r)) for r in df.values.tolist()), key=repr)

    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows(got) == rows(wanted)
