import uuid

import pytest
from pyspark.sql import functions as F

from clickpipe.operators.assemble import join_ads_by_document, join_impressions_clicks, labelled_data
from clickpipe.operators.hot_keys import SALT, hot_keys, join_hot, key_sketch, merge_sketches, salts_for
from clickpipe.sources.tables import save_bucketed

PARTS = 16


@pytest.fixture(scope="module")
def hot(spark):
    """Clicks of which a third belongs to display 7, many of them equal rows; one impression a display."""
    clicks = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_011).cast("long").alias("display_id"),
                                        (F.col("id") % 5).alias("ad_id"), (F.col("id") % 2).cast("int").alias("clicked"))
    event = spark.range(20_011).select(F.col("id").alias("display_id"), (F.col("id") % 977).alias("document_id"), F.lit(1).alias("platform"))
    return event, clicks


@pytest.fixture()
def still(spark):
    """Sizes of join tasks as planned: no adaptive splitting or merging, no broadcasts."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": str(PARTS)}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def task_rows(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sketch_finds_hot_keys_and_merges(spark, hot):
    _, clicks = hot
    found = dict(hot_keys(key_sketch(clicks, "display_id")))
    assert list(found) == [7] and found[7] >= 30_000
    halves = [key_sketch(clicks.filter(F.col("ad_id") % 2 == r), "display_id") for r in (0, 1)]
    merged = dict(hot_keys(merge_sketches(halves[0].unionByName(halves[1]))))
    assert list(merged) == [7] and merged[7] >= 30_000
    assert hot_keys(key_sketch(clicks.filter("display_id <> 7"), "display_id")) == []
    assert hot_keys(key_sketch(clicks.filter("false"), "display_id")) == []
    assert salts_for([(7, 10)]) == 16 and salts_for([(7, 100 << 20)]) == 100


def test_hot_display_spreads_over_tasks(spark, hot, still):
    event, clicks = hot
    plain, spread = join_impressions_clicks(event, clicks), join_impressions_clicks(event, clicks, hot_share=0.01)
    assert plain.columns == spread.columns
    assert plain.exceptAll(spread).count() == 0 and spread.exceptAll(plain).count() == 0
    n = plain.count()
    assert max(task_rows(plain)) > n / 3  # one task holds the display
    assert max(task_rows(spread)) < n / 8
    assert SALT in plan(spread)


def test_bucketed_tables_shuffle_only_the_hot_rows(spark, hot, still):
    event, clicks = hot
    names = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    for name, df in zip(names, (event, clicks)):
        save_bucketed(df, name, buckets=8)
    event, clicks = map(spark.table, names)
    spread = join_impressions_clicks(event, clicks, hot_share=0.01)
    exchanges = [line for line in plan(spread).splitlines() if "Exchange hashpartitioning" in line]
    # The hot rows' copies are counted first; both sides are then cut by (key, salt).  No cold row moves.
    assert sum(SALT in line for line in exchanges) == 2 and len(exchanges) <= 3
    plain = join_impressions_clicks(event, clicks)
    assert spread.exceptAll(plain).count() == 0 and plain.exceptAll(spread).count() == 0
    assert max(task_rows(spread)) < plain.count() / 8


def test_nulls_both_sides_hot_and_documents(spark, hot):
    event, clicks = hot
    ads = spark.range(4000).select(F.col("id").alias("ad_id"), F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 977).alias("document_id"),
                                   F.lit(1).alias("campaign_id"), F.lit(2).alias("advertiser_id"))
    data = join_impressions_clicks(event, clicks.limit(20_000)).withColumn("document_id", F.when(F.col("platform") == 1, F.col("document_id") % 3))
    data = data.unionByName(data.limit(50).withColumn("document_id", F.lit(None).cast("long")))
    a, b = join_ads_by_document(data, ads), join_ads_by_document(data, ads, hot_share=0.2)
    assert a.columns == b.columns and a.count() == b.count() > 0
    assert a.groupBy(*a.columns).count().exceptAll(b.groupBy(*b.columns).count()).count() == 0
    assert join_hot(data, ads, "document_id", []).count() == a.count()


def test_labelled_data_is_the_same(tables):
    a, b = labelled_data(**tables), labelled_data(**tables, hot_share=0.001)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
