from pyspark.sql import functions as F

from clickpipe.plans.features import build_pipeline
from clickpipe.plans.models import logistic_regression
from clickpipe.plans.tuning import FOLD_COL, cross_validate, cv_summary, lr_param_grid, with_folds
from clickpipe.plans.workflow import prepare


def test_grid_has_four_maps(spark):
    lr = logistic_regression()
    grid = lr_param_grid(lr)
    assert len(grid) == 4
    assert {(m[lr.regParam], m[lr.maxIter]) for m in grid} == {(0.3, 10), (0.3, 5), (0.01, 10), (0.01, 5)}


def test_folds_are_by_display(tables):
    s = prepare(tables)
    f = with_folds(s.train, 10)
    per_display = f.groupBy("display_id").agg(F.countDistinct(FOLD_COL).alias("k"))
    assert per_display.filter("k > 1").count() == 0
    folds = {r[0] for r in f.select(FOLD_COL).distinct().collect()}
    assert folds <= set(range(10)) and len(folds) == 10


def test_cross_validation_rows_and_rmse_tie(spark, tables):
    s = prepare(tables)
    lr = logistic_regression()
    grid = lr_param_grid(lr)
    model = cross_validate(build_pipeline(lr), grid, s.train, num_folds=3, metric="areaUnderROC")
    summary = cv_summary(spark, model, "areaUnderROC").collect()
    assert len(summary) == 4 and sum(r.best == "yes" for r in summary) == 1
    assert all(0.5 < r.avg_metric <= 1.0 for r in summary), summary


def test_rmse_selection_ties_pick_first_map(spark):
    # RMSE on 0/1 predictions: at sf0.01 every map predicts the same rule, so
    # all tie and the first map wins (the original selection behaviour).
    from clickpipe.sources.fixtures import fixture_tables

    s = prepare(fixture_tables(spark, "/root/testdata/sf0.01"))
    lr = logistic_regression()
    grid = lr_param_grid(lr)
    m2 = cross_validate(build_pipeline(lr), grid, s.train, num_folds=3, metric="rmse")
    metrics = list(m2.avgMetrics)
    first_best = metrics.index(min(metrics))  # lowest RMSE; ties -> first map
    best = m2.bestModel.stages[-1]
    want = grid[first_best]
    assert (best.getRegParam(), best.getMaxIter()) == (want[lr.regParam], want[lr.maxIter])
    assert max(metrics) - min(metrics) < 1e-3  # the maps barely differ on this label


def test_grid_choice_where_it_matters(spark):
    """Data on which the penalty changes the outcome: the weak one must win, and the fold
    means must be those of Spark's own cross-validator on the same folds."""
    from pyspark.ml.tuning import CrossValidator
    from clickpipe.plans.tuning import selection_evaluator

    rows = [(i, float(i % 50), float((i * 7) % 11), int(i % 50 > 32)) for i in range(1500)]
    df = spark.createDataFrame(rows, "display_id long, a double, b double, label int").coalesce(2)
    lr = logistic_regression()
    grid = lr_param_grid(lr)
    pipe = build_pipeline(lr, features=["a", "b"])
    mine = cross_validate(pipe, grid, df, num_folds=3, metric="rmse")
    theirs = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=selection_evaluator("rmse"),
                            numFolds=3, foldCol=FOLD_COL).fit(with_folds(df, 3))
    assert len(set(mine.avgMetrics)) > 1
    assert all(abs(x - y) < 1e-9 for x, y in zip(mine.avgMetrics, theirs.avgMetrics))
    assert mine.avgMetrics.index(min(mine.avgMetrics)) == theirs.avgMetrics.index(min(theirs.avgMetrics)) > 1
    best = mine.bestModel.stages[-1]
    assert best.getRegParam() == 0.01
