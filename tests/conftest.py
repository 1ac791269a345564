import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    local = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.local.dir", str(local)).config("spark.checkpoint.dir", str(local / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    """A DuckDB connection with the small tables as views."""
    import duckdb

    con = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def rows(df):
    """Rows in an order of their own, floats to nine digits."""
    def plain(v):
        return "null" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)

    columns = sorted(df.columns)
    return sorted(tuple(plain(v) for v in r) for r in df.toPandas()[columns].astype(object).itertuples(index=False))
