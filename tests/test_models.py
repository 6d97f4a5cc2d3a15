import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickpipe.plans.evaluate import classification_metrics, metrics_table
from clickpipe.plans.features import build_pipeline
from clickpipe.plans.models import DT_PARAMS, RF_PARAMS, make_learner
from clickpipe.plans.workflow import fit_and_score, fit_pipeline, prepare, rule_predictions

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def split(tables):
    return prepare(tables)


@pytest.fixture(scope="module")
def split_mid(spark):
    from clickpipe.sources.fixtures import fixture_tables

    return prepare(fixture_tables(spark, MID))


def _counts(df):
    return {r.metric: r.value for r in metrics_table(df).collect()}


@pytest.mark.parametrize("learner,params", [("lr", {}), ("lr", {"regParam": 0.01}),
                                            ("dt", {"maxDepth": 1})])
def test_simple_learners_learn_the_rule(split_mid, learner, params):
    # The fixture label's only signal is platform <= 2; at sf0.01 these
    # learners find exactly that rule.
    _, pred = fit_and_score(learner, split_mid, **params)
    assert _counts(pred) == _counts(rule_predictions(split_mid.test))


@pytest.mark.parametrize("learner,params", [("dt", {}), ("gbt", {}), ("rf", {"numTrees": 3})])
def test_learner_invariants(split, learner, params):
    _, pred = fit_and_score(learner, split, **params)
    n_test = split.test.count()
    assert pred.count() == n_test
    assert {r.prediction for r in pred.select("prediction").distinct().collect()} <= {0.0, 1.0}
    p = vector_to_array("probability")
    bad = pred.filter(F.abs(p[0] + p[1] - 1.0) > 1e-9).count()
    assert bad == 0
    acc = classification_metrics(pred).first().accuracy
    majority = split.test.agg(F.avg("trueLabel")).first()[0]
    assert acc > max(majority, 1 - majority)  # beats always predicting the majority class
    # same seed -> same model
    _, again = fit_and_score(learner, split, **params)
    assert classification_metrics(again).first().accuracy == acc


def test_gbt_close_to_the_rule(split_mid):
    # Boosting approximates the same rule; bound the difference instead of equality.
    _, pred = fit_and_score("gbt", split_mid)
    got, rule = _counts(pred), _counts(rule_predictions(split_mid.test))
    n = split_mid.test.count()
    for k in ("TP", "FP", "TN", "FN"):
        assert abs(got[k] - rule[k]) <= 0.01 * n, (k, got[k], rule[k])


def test_reference_parameters():
    dt = make_learner("dt")
    assert (dt.getMaxDepth(), dt.getMaxBins(), dt.getImpurity(), dt.getSeed()) == (30, 128, "gini", 1234)
    rf = make_learner("rf")
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getFeatureSubsetStrategy()) == (10, 30, "auto")
    assert make_learner("lr").getRegParam() == 0.3 and make_learner("gbt").getMaxIter() == 10
    assert DT_PARAMS["maxBins"] == RF_PARAMS["maxBins"] == 128
    with pytest.raises(ValueError):
        make_learner("svm")


def test_scaler_constant_column_and_unclipped(spark):
    train = spark.createDataFrame([(1.0, 5.0, 0), (3.0, 5.0, 1)], "a double, b double, label int")
    test = spark.createDataFrame([(4.0, 5.0, 1)], "a double, b double, label int")
    model = build_pipeline(None, features=["a", "b"]).fit(train)
    out = model.transform(test).select(vector_to_array("features").alias("f")).first().f
    assert out == [1.5, 0.5]  # outside [0, 1] is kept; constant column -> 0.5


def test_null_feature_policy(spark):
    df = spark.createDataFrame([(1.0, 0), (None, 1), (2.0, 1)], "a double, label int")
    with pytest.raises(Exception):
        build_pipeline(None, features=["a"]).fit(df).transform(df).collect()
    kept = build_pipeline(None, features=["a"], handle_invalid="skip").fit(df).transform(df)
    assert kept.count() == 2


def test_tree_memory_is_a_constant():
    from clickpipe.plans.models import TREE_MEMORY_MB

    assert make_learner("rf").getMaxMemoryInMB() == make_learner("dt").getMaxMemoryInMB() == TREE_MEMORY_MB
    assert make_learner("rf", maxMemoryInMB=256).getMaxMemoryInMB() == 256


def test_models_do_not_depend_on_the_session(spark):
    """The same model whatever the session's shuffle partitions or the rows' order, over several
    partitions of training rows (sf0.01, the reference's settings; fewer trees in the forest)."""
    from clickpipe.sources.fixtures import fixture_tables

    split = prepare(fixture_tables(spark, "/root/testdata/sf0.01"))
    rows, old = {}, spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            train = split.train.repartition(int(parts))
            for name, params in (("dt", {}), ("rf", {"numTrees": 2, "maxDepth": 12}), ("gbt", {"maxIter": 3})):
                model = fit_pipeline(name, train, partitions=5, **params).stages[-1]
                found = model.toDebugString.split("\n", 1)[1]  # all but its uid
                assert rows.setdefault(name, found) == found
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)


def test_training_partitions_follow_the_rows():
    from clickpipe.plans.workflow import training_partitions

    assert [training_partitions(n) for n in (0, 1, 65_536, 65_537, 2_000_000, 10_000_000)] == [1, 1, 1, 2, 8, 39]
    assert training_partitions(10 ** 10) == 1193  # 512 MB each


def test_fit_row_bound_and_invalid_rows(spark, split):
    from clickpipe.plans.workflow import training_input

    with training_input(split.train, max_fit_rows=500) as data:
        assert data.count() == 500
    with training_input(split.train) as data:
        assert data.count() == split.train.count()
    broken = split.train.withColumn("platform", F.when(F.col("ad_id") % 5 != 0, F.col("platform")))
    with pytest.raises(Exception):
        fit_pipeline("lr", broken)
    assert fit_pipeline("lr", broken, handle_invalid="skip").transform(split.test).count() == split.test.count()
    unlabelled = split.train.withColumn("label", F.when(F.col("ad_id") % 5 != 0, F.col("label")))
    with pytest.raises(Exception):
        fit_pipeline("lr", unlabelled)
    fit_pipeline("lr", unlabelled, handle_invalid="skip")
