import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])   # for the workers

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from decisionops.session import BASE_CONF
    b = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "4g"))
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    if not s.conf.get("spark.checkpoint.dir", None):      # tests only: no cluster folder
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="decisionops-test-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from decisionops.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
