import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clickpipe.session import local_session

    s = local_session("4", shuffle_partitions=8, driver_memory="8g", app="clickpipe-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()

    def run(sql, sf_dir=SF_SMALL):
        c = duckdb.connect()
        for t in ("orders", "lineitem", "part"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return c.sql(sql).df()

    yield run
    con.close()


@pytest.fixture(scope="session")
def tables(spark):
    from clickpipe.sources.fixtures import fixture_tables

    return fixture_tables(spark, SF_SMALL)
