"""Every registered query runs on the smallest fixture and returns rows."""

import pytest

from clickpipe.plans import more_queries, registry

QUERIES = registry.QUERIES | more_queries.QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs(spark, name):
    df = QUERIES[name](spark, SMALL)
    rows = df.collect()
    assert len(rows) > 0, name
    assert len(df.columns) == len(set(df.columns)), name
