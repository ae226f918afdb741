import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    place = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{place}/warehouse")
        .config("spark.checkpoint.dir", f"{place}/checkpoints")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    """A value as text, alike from both engines."""
    if v is None or v != v:
        return "NULL"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return v.isoformat() if hasattr(v, "isoformat") else repr(v) if isinstance(v, float) else str(v)


@pytest.fixture(scope="session")
def same_as_sql(duck):
    """Asserts that a DataFrame has the rows of a SQL text."""

    def check(df, sql):
        cur = duck.execute(sql)
        names = [d[0] for d in cur.description]
        columns = sorted(df.columns)
        assert columns == sorted(names)
        at = [names.index(c) for c in columns]
        want = sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
        assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want

    return check
