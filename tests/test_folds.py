"""Cross-validation caches the rows with their fold and passes over distinct rows where the learner allows it."""

import numpy as np
import pytest

from clickpipe.plans import closed_form, tuning
from clickpipe.plans.features import build_pipeline
from clickpipe.plans.models import make_learner
from clickpipe.plans.tuning import bayes_param_grid
from clickpipe.plans.workflow import training_input, tune


@pytest.mark.parametrize("name", ["nb", "lr"])
def test_folds_are_hashed_once_and_equal_rows_counted(spark, monkeypatch, name):
    """A fold's passes read cached rows with their fold; naive Bayes passes over distinct rows, with the metrics of the copies."""
    names = ["display_id", "document_id", "platform", "ad_id", "campaign_id", "advertiser_id"]
    rows = spark.createDataFrame([(*[float((i * k) % 29) for k in (1, 3, 5, 7, 11, 13)], int((i * i) % 5 < 2)) for i in range(120) for _ in range(1 + i % 6)],
                                 ", ".join(f"{c} double" for c in names) + ", label int")
    learner = make_learner(name)
    grid = bayes_param_grid(learner) if name == "nb" else [{learner.maxIter: 3}, {learner.maxIter: 5}]
    with training_input(rows) as data:
        want = tuning.cross_validate(build_pipeline(learner), grid, data, num_folds=3)
        assert data.storageLevel.useMemory
    levels, sizes, fitted, sums = [], [], tuning._fitted_features, closed_form.GroupedNaiveBayes._sums

    def spied(before, learner, fitting, rest, *more):
        plan = fitting._jdf.queryExecution().optimizedPlan().toString()
        levels.append("InMemoryRelation" in plan and "md5" not in plan.split("InMemoryRelation")[0])
        return fitted(before, learner, fitting, rest, *more)

    monkeypatch.setattr(tuning, "_fitted_features", spied)
    monkeypatch.setattr(closed_form.GroupedNaiveBayes, "_sums", lambda self, df: sizes.append(df.count()) or sums(self, df))
    got = tune(build_pipeline(learner), grid, rows, num_folds=3)
    assert levels == [True] * 3
    assert got.avgMetrics == pytest.approx(want.avgMetrics, rel=1e-9) and got.stdMetrics == pytest.approx(want.stdMetrics, rel=1e-7, abs=1e-12)
    if name == "nb":
        assert sizes[-1] == rows.distinct().count() and sum(sizes[:3]) == 2 * sizes[-1]
        assert np.allclose(got.bestModel.stages[-1].second, want.bestModel.stages[-1].second, rtol=1e-9)
