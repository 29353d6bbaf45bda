import os
import sys
import tempfile

import duckdb
import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = SparkSession.builder.master("local[4]").config("spark.driver.memory", "4g").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-")).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def oracle():
    """SQL over the smallest tables -> sorted rows of rounded strings, columns by name."""
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return lambda sql: canonical(con.execute(sql).fetchdf())


def canonical(frame):
    """Sorted rows of strings, and the columns. A date and its midnight are alike: DuckDB's frames hold dates as timestamps."""
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple("None" if v is None or v is pd.NA or v != v else f"{v:.6g}" if isinstance(v, float) else str(v).removesuffix(" 00:00:00") for v in r) for r in frame.itertuples(index=False)), sorted(frame.columns)
