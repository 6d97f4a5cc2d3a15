"""Distinct rows with their number give the models of the rows one by one, in smaller passes."""

import pytest
from pyspark.ml.base import Estimator

from clickpipe.plans import counts
from clickpipe.plans.counts import takes_counts
from clickpipe.plans.features import build_pipeline
from clickpipe.plans.models import make_learner
from clickpipe.plans.tuning import cross_validate
from clickpipe.plans.workflow import _fit_shared, compare_models, fit_pipeline, prepare, training_input, tune


@pytest.fixture(scope="module")
def rows(spark):
    """600 rows of 90 kinds: up to 24 equal ones."""
    kinds = [(float(i), float(i // 3), float(i % 5), float(i % 7), float(i % 4), float(i % 11), int(i % 5 < 2)) for i in range(45)]
    data = [(*k[:6], k[6] if j % 4 else 1 - k[6]) for i, k in enumerate(kinds) for j in range(2 + i % 23)]
    names = ["display_id", "document_id", "platform", "ad_id", "campaign_id", "advertiser_id"]
    return spark.createDataFrame(data, ", ".join(f"{c} double" for c in names) + ", label int")


@pytest.mark.parametrize("name,params", [("dt", {}), ("gbt", {"maxIter": 3}), ("lr", {"maxIter": 100, "tol": 1e-10}),
                                         ("lr", {"maxIter": 100, "tol": 1e-10, "standardization": False})])
def test_counted_fit_is_the_fit_of_the_copies(rows, monkeypatch, name, params):
    monkeypatch.setattr(counts, "DEVIATION_GAP", 1.0)
    fitted = fit_pipeline(name, rows, **params).stages[-1]
    with training_input(rows) as data:
        plain = build_pipeline(make_learner(name, **params)).fit(data).stages[-1]
    if name == "lr":
        assert fitted.coefficients.toArray() == pytest.approx(plain.coefficients.toArray(), rel=1e-5, abs=1e-7)
        assert fitted.intercept == pytest.approx(plain.intercept, rel=1e-5, abs=1e-7)
        assert fitted.getRegParam() == plain.getRegParam() == 0.3
    else:
        if name == "dt":  # whole counts: the same to the bit
            assert fitted.toDebugString.split("\n", 1)[1] == plain.toDebugString.split("\n", 1)[1]
        pairs = [m.transform(build_pipeline(None).fit(rows).transform(rows)).orderBy("display_id", "label").collect() for m in (fitted, plain)]
        assert [r.prediction for r in pairs[0]] == [r.prediction for r in pairs[1]]
        assert [r.probability[1] for r in pairs[0]] == pytest.approx([r.probability[1] for r in pairs[1]], rel=1e-9)


@pytest.mark.parametrize("name,one_by_one", [("lr", False), ("dt", False), ("gbt", False), ("rf", True)])
def test_learners_pass_over_distinct_rows(rows, monkeypatch, name, one_by_one):
    monkeypatch.setattr(counts, "DEVIATION_GAP", 1.0)
    seen, fit = [], Estimator.fit

    def spied(self, dataset, params=None):
        if type(self).__name__ == type(make_learner(name)).__name__:
            seen.append(dataset.count())
        return fit(self, dataset, params)

    monkeypatch.setattr(Estimator, "fit", spied)
    fit_pipeline(name, rows, **({"numTrees": 1} if name == "rf" else {}))
    assert seen == [rows.count() if one_by_one else rows.distinct().count()]
    assert rows.count() > 4 * rows.distinct().count()


def test_few_rows_are_fitted_as_copies(rows):
    """A regression that stops early is that of the copies to the bit."""
    fitted = fit_pipeline("lr", rows, maxIter=3, regParam=0.01).stages[-1]
    with training_input(rows) as data:
        plain = build_pipeline(make_learner("lr", maxIter=3, regParam=0.01)).fit(data).stages[-1]
    assert list(fitted.coefficients) == list(plain.coefficients) and fitted.intercept == plain.intercept


def test_counted_input_holds_every_row_once(rows):
    with training_input(rows, counted_copies=True) as data:
        found = {tuple(r)[:-1]: r["_copies"] for r in data.collect()}
    want = {tuple(r)[:-1]: r["count"] for r in rows.groupBy(*rows.columns).count().collect()}
    assert found == want
    with training_input(rows, max_fit_rows=100, counted_copies=True) as data:
        assert sum(r["_copies"] for r in data.collect()) == 100


@pytest.mark.parametrize("metric", ["rmse", "areaUnderROC", "areaUnderPR"])
def test_counted_folds_have_the_metrics_of_the_copies(rows, monkeypatch, metric):
    monkeypatch.setattr(counts, "DEVIATION_GAP", 1.0)
    lr = make_learner("lr", tol=1e-10)
    grid = [{lr.regParam: 0.3, lr.maxIter: 100}, {lr.regParam: 0.01, lr.maxIter: 100}]
    got = tune(build_pipeline(lr), grid, rows, num_folds=3, metric=metric)
    want = cross_validate(build_pipeline(lr), grid, rows.coalesce(1), num_folds=3, metric=metric)
    assert got.avgMetrics == pytest.approx(want.avgMetrics, rel=1e-9)
    assert got.bestModel.stages[-1].getRegParam() == want.bestModel.stages[-1].getRegParam()
    assert got.bestModel.stages[-1].coefficients.toArray() == pytest.approx(want.bestModel.stages[-1].coefficients.toArray(), rel=1e-4)


def test_which_learners_take_counts():
    takes = {"lr": True, "dt": True, "gbt": True, "rf": False, "mlp": False, "nb": False, "linear": False}
    assert {name: takes_counts(make_learner(name)) for name in takes} == takes
    assert not takes_counts(make_learner("lr", elasticNetParam=0.5))
    assert not takes_counts(make_learner("dt", minInstancesPerNode=2))
    assert not takes_counts(make_learner("gbt", subsamplingRate=0.5))
    assert not takes_counts(make_learner("dt", weightCol="w"))


def test_comparison_over_both_kinds_of_input(tables):
    found = compare_models(prepare(tables), {"lr": {}, "rf": {"numTrees": 2, "maxDepth": 3}}).collect()
    assert [r.model for r in found] == ["lr", "rf"] and all(r.accuracy > 0.5 for r in found)


@pytest.mark.parametrize("shared", [False, True])
def test_forest_reads_features_made_once(rows, monkeypatch, shared):
    """The learner's passes read cached features, not the stages before it; the model is that of the copies."""
    params = {"numTrees": 3, "maxDepth": 4}
    with training_input(rows) as data:
        plain = build_pipeline(make_learner("rf", **params)).fit(data)
    seen, fit = [], Estimator.fit

    def spied(self, dataset, params=None):
        if type(self).__name__ == "RandomForestClassifier":
            seen.append((dataset.columns, dataset.storageLevel.useMemory, dataset.count()))
        return fit(self, dataset, params)

    monkeypatch.setattr(Estimator, "fit", spied)
    if shared:
        with training_input(rows, counted_copies=True) as data:
            fitted = _fit_shared(build_pipeline(make_learner("rf", **params)), data)
    else:
        fitted = fit_pipeline("rf", rows, **params)
    assert seen == [(["features", "label"], True, rows.count())]
    assert fitted.stages[1].originalMin == plain.stages[1].originalMin and fitted.stages[1].originalMax == plain.stages[1].originalMax
    assert fitted.stages[-1].toDebugString.split("\n", 1)[1] == plain.stages[-1].toDebugString.split("\n", 1)[1]


def test_forest_of_bounded_rows_is_that_of_the_sample(rows):
    with training_input(rows, max_fit_rows=200) as data:
        plain = build_pipeline(make_learner("rf", numTrees=2, maxDepth=3)).fit(data).stages[-1]
    fitted = fit_pipeline("rf", rows, max_fit_rows=200, numTrees=2, maxDepth=3).stages[-1]
    assert fitted.toDebugString.split("\n", 1)[1] == plain.toDebugString.split("\n", 1)[1]
