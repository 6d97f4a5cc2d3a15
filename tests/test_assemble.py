from clickpipe.operators.assemble import (FEATURES, as_test, join_ads_by_ad,
                                          join_ads_by_document, join_impressions_clicks,
                                          labelled_data)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_counts_and_fanout(tables):
    j1 = join_impressions_clicks(tables["event"], tables["train"])
    assert j1.count() == tables["train"].count()  # every click has its impression
    assert "ad_id" not in j1.columns  # the original drops the shown ad
    j2 = join_ads_by_document(j1, tables["promoted_content"])
    assert j2.count() == 4 * j1.count()  # 4 ads per landing document in the fixture
    j3 = join_ads_by_ad(join_impressions_clicks(tables["event"], tables["train"], keep_ad=True),
                        tables["promoted_content"])
    assert j3.count() == j1.count()


def test_feature_projection_types(tables):
    d = labelled_data(**tables)
    assert d.columns == FEATURES + ["label"]
    assert all(t == "double" for c, t in d.dtypes if c != "label")
    raw = labelled_data(**tables, cast=False)
    assert dict(raw.dtypes)["platform"] == "int"
    assert as_test(d).columns[-1] == "trueLabel"


def test_join_strategy_is_the_planners(spark, tables):
    pc = tables["promoted_content"]
    j1 = join_impressions_clicks(tables["event"], tables["train"])
    before = spark.sparkContext.statusTracker().getActiveJobsIds()
    small = join_ads_by_document(j1, pc)
    assert spark.sparkContext.statusTracker().getActiveJobsIds() == before
    assert "Broadcast" in _plan(small)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = join_ads_by_document(j1, pc)
        assert "SortMergeJoin" in _plan(big) and "SinglePartition" not in _plan(big)
        assert big.count() == small.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_split_filter_reaches_scan(tables):
    from clickpipe.operators.sampling import hash_split

    train, _ = hash_split(labelled_data(**tables))
    plan = train._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan
    # column pruning: uuid / geo_location are never read
    exec_plan = _plan(train)
    assert "geo_location" not in exec_plan and "uuid" not in exec_plan


def test_bucketed_tables_join_without_shuffle(spark, tables):
    from clickpipe.sources.tables import load_table, save_bucketed

    save_bucketed(tables["event"], "event_bucketed", "display_id", 8)
    save_bucketed(tables["train"], "train_bucketed", "display_id", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ev = load_table(spark, "event", source="catalog", table="event_bucketed")
        tr = load_table(spark, "train", source="catalog", table="train_bucketed")
        j = join_impressions_clicks(ev, tr)
        plan = _plan(j)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == join_impressions_clicks(tables["event"], tables["train"]).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
