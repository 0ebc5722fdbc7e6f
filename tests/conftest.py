import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from aerolake.session import get_session
    s = get_session("local[4]", shuffle_partitions=4,
                    conf={"spark.driver.memory": "6g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aerolake-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="aerolake-test-")


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from aerolake.sources.tables import DRIVER_TABLES

    def make(sf):
        con = duckdb.connect()
        for t in DRIVER_TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        return con
    return make
