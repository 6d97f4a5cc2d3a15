import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from clickpipe.plans.closed_form import GroupedNaiveBayes, NormalEquations, residual_moments
from clickpipe.plans.evaluate import auc_by_group, auc_roc, classification_metrics, metrics_by_group, rmse
from clickpipe.plans.features import build_pipeline
from clickpipe.plans.models import make_learner
from clickpipe.plans.tuning import bayes_param_grid, cross_validate, train_validation_split
from clickpipe.plans.workflow import fit_pipeline, prepare


@pytest.fixture(scope="module")
def split(tables):
    return prepare(tables)


@pytest.mark.parametrize("kind, smoothing", [("gaussian", 1e-9), ("multinomial", 1.0), ("multinomial", 7.5)])
def test_naive_bayes_equals_sparks(split, kind, smoothing):
    features = build_pipeline(None).fit(split.train)
    train, test = features.transform(split.train), features.transform(split.test)
    theirs = NaiveBayes(modelType=kind, smoothing=smoothing if kind == "multinomial" else 1.0).fit(train).transform(test)
    mine = GroupedNaiveBayes(modelType=kind, smoothing=smoothing).fit(train).transform(theirs.withColumnsRenamed(
        {"prediction": "p", "probability": "q", "rawPrediction": "r"}))
    # The variances of Spark's own differ by its fixed share of the largest one; probabilities agree.
    gap = F.abs(vector_to_array("probability")[1] - vector_to_array("q")[1])
    row = mine.agg(F.max(gap).alias("gap"), F.count_if(F.col("p") != F.col("prediction")).alias("other"), F.count(F.lit(1)).alias("n")).first()
    assert row.n > 1000 and row.gap < 1e-7 and row.other == 0


def test_naive_bayes_cases(spark):
    rows = [([1.0, 0.0], 0.0), ([2.0, 1.0], 0.0), ([5.0, 0.5], 1.0), ([6.0, 0.0], 1.0), ([9.0, 9.0], None)]
    df = build_vectors(spark, rows)
    model = GroupedNaiveBayes().fit(df)
    assert model.classes == [0.0, 1.0] and [r.prediction for r in model.transform(df).collect()][:4] == [0.0, 0.0, 1.0, 1.0]
    with pytest.raises(ValueError):
        GroupedNaiveBayes(modelType="other").fit(df)
    with pytest.raises(ValueError):
        GroupedNaiveBayes(modelType="multinomial").fit(build_vectors(spark, [([-1.0], 0.0)]))
    with pytest.raises(ValueError):
        GroupedNaiveBayes(smoothing=0.0).fit(build_vectors(spark, [([1.0], 0.0), ([1.0], 1.0)]))
    one = GroupedNaiveBayes(modelType="multinomial", smoothing=1.0).fit(build_vectors(spark, [([1.0], 3.0)]))
    assert one.transform(build_vectors(spark, [([2.0], None)])).first().prediction == 3.0


def build_vectors(spark, rows):
    from pyspark.ml.functions import array_to_vector

    return spark.createDataFrame(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label")


def test_linear_regression_equals_numpy_and_sparks(split):
    features = build_pipeline(None).fit(split.train)
    train = features.transform(split.train)
    model = NormalEquations().fit(train)
    rows = train.select(vector_to_array("features").alias("x"), "label").collect()
    x, y = np.array([[1.0, *r.x] for r in rows]), np.array([r.label for r in rows], float)
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.allclose([model.intercept, *model.coefficients], want, atol=1e-9)
    theirs = LinearRegression(solver="normal", regParam=0.0).fit(train)
    assert np.allclose(model.coefficients, theirs.coefficients.toArray(), atol=1e-7)
    moments = {r.feature: r.moment for r in residual_moments(
        model.transform(train).select("label", "prediction", vector_to_array("features")[2].alias("platform")), ["platform"]).collect()}
    assert all(abs(v) < 1e-12 for v in moments.values())


def test_linear_regression_large_means_and_dependence(spark):
    rows = [([1e9 + i, 1e9 - 2 * (i % 7), 4.0], 3.0 * i + (i % 7)) for i in range(500)]
    model = NormalEquations().fit(build_vectors(spark, rows))
    assert np.allclose(model.coefficients, [3.0, -0.5, 0.0], atol=1e-6)  # the constant slot gets 0
    twice = build_vectors(spark, [([float(i), 2.0 * i, float(i % 3)], float(i)) for i in range(50)])
    with pytest.raises(ValueError, match=r"features \[0, 1\] are nearly dependent"):
        NormalEquations().fit(twice)
    ridge = NormalEquations(regParam=0.1).fit(twice)
    assert ridge.condition < 100 and ridge.coefficients[0] == pytest.approx(2 * ridge.coefficients[1])
    with pytest.raises(ValueError):
        NormalEquations().fit(build_vectors(spark, [([1.0], None)]))


def test_grouped_auc_and_metrics_equal_one_by_one(spark):
    rows = [(i % 3, float((i * 37) % 101 // (1 + i % 3)), int((i * 13) % 7 > 3), float((i * 5) % 3 > 0)) for i in range(3000)]
    rows += [(3, 0.5, 1, 1.0), (3, 0.5, 1, 0.0), (4, None, 1, None)]
    df = spark.createDataFrame(rows, "g int, score double, trueLabel int, prediction double")
    for target in (1 << 18, 7):
        found = {r.g: r.auc for r in auc_by_group(df, ["g"], target_bucket_rows=target).collect()}
        for g in range(3):
            assert found[g] == pytest.approx(auc_roc(df.filter(F.col("g") == g)).first().auc, abs=1e-12)
        assert found[3] is None and 4 not in found
    many = {r.g: r for r in metrics_by_group(df, ["g"]).collect()}
    for g in range(4):
        one = classification_metrics(df.filter(F.col("g") == g)).first()
        assert all(many[g][c] == pytest.approx(one[c]) if one[c] is not None else many[g][c] is None for c in ("accuracy", "f1", "precision", "recall", "test_error"))
        assert many[g].rmse == pytest.approx(rmse(df.filter(F.col("g") == g), "trueLabel").first().rmse)


def test_cross_validation_by_exact_auc(spark, split):
    """Fold means equal to fitting and ranking each fold by itself."""
    from clickpipe.plans.tuning import FOLD_COL, with_folds

    nb = make_learner("nb")
    pipe, grid = build_pipeline(nb), bayes_param_grid(nb)
    model = cross_validate(pipe, grid, split.train, num_folds=3, parallelism=2)
    folds = with_folds(split.train, 3)
    for i, pmap in enumerate(grid):
        values = []
        for f in range(3):
            pred = pipe.fit(folds.filter(F.col(FOLD_COL) != f), pmap).transform(folds.filter(F.col(FOLD_COL) == f))
            values.append(auc_roc(pred.withColumn("s", vector_to_array("probability")[1]), "s", "label").first().auc)
        assert model.avgMetrics[i] == pytest.approx(np.mean(values), abs=1e-12)
        assert model.stdMetrics[i] == pytest.approx(np.std(values), abs=1e-9)


def test_validation_split_choice(split):
    nb = make_learner("nb")
    pipe, grid = build_pipeline(nb), bayes_param_grid(nb)
    found = train_validation_split(pipe, grid, split.train, metric="f1")
    rows = found.metrics.collect()
    assert [r.map for r in rows] == list(range(len(grid))) and found.best == max(range(len(grid)), key=lambda i: (rows[i].f1, -i))
    assert found.model.stages[-1].kind == grid[found.best][nb.modelType]
    assert len({r.n for r in rows}) == 1 and 0.2 < rows[0].n / split.train.count() < 0.3
    with pytest.raises(ValueError):
        train_validation_split(pipe, grid, split.train, metric="unknown")


def test_layered_learner_one_seed_one_model(spark):
    from clickpipe.plans.more_queries import xor_split
    from clickpipe.plans.workflow import training_input

    s = xor_split(spark, "/root/testdata/sf0.001")
    weights, old = [], spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            with training_input(s.train.repartition(int(parts)), partitions=4) as data:
                model = build_pipeline(make_learner("mlp", layers=[2, 8, 2]), features=["a", "b"]).fit(data)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
        weights.append(model.stages[-1].weights.toArray().tolist())
    assert weights[0] == weights[1]
    accuracy = lambda pred: classification_metrics(pred).first().accuracy
    stump = build_pipeline(make_learner("dt", maxDepth=1), features=["a", "b"]).fit(s.train)
    assert accuracy(model.transform(s.test)) == 1.0 > accuracy(stump.transform(s.test)) + 0.2


def test_new_learners_by_name(split):
    assert fit_pipeline("nb", split.train).transform(split.test).filter("prediction NOT IN (0, 1)").count() == 0
    assert "prediction" in fit_pipeline("linear", split.train).transform(split.test).columns


def test_naive_bayes_equals_sql(spark, duck):
    """Every probability to 1e-9 (the registered query rounds, so that no last digit turns)."""
    from clickpipe.plans.more_queries import ORACLE_SQL
    from clickpipe.plans.workflow import fit_and_score
    from clickpipe.sources.fixtures import fixture_tables

    sql = ORACLE_SQL["nb_predict"].replace("round(score, 6)", "score")
    want = sorted(map(tuple, duck(sql)[["display_id", "ad_id", "trueLabel", "prediction", "score"]].itertuples(index=False)))
    pred = fit_and_score("nb", prepare(fixture_tables(spark, "/root/testdata/sf0.001")))[1]
    got = sorted(map(tuple, pred.select("display_id", "ad_id", "trueLabel", "prediction", "score").collect()))
    assert len(got) == len(want) and all(a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-9 for a, b in zip(got, want))


def test_linear_regression_of_nearly_equal_features(spark):
    """Two ids, one four times the other and a remainder, over a range where the correlations'
    condition number is beyond 1e10: the residual is still free of every feature."""
    i = F.col("id")
    rows = spark.range(0, 400000, 1, 4).select((i * 977 % 1000003).alias("d"), (i * 31 % 4).alias("r"))
    rows = rows.select(F.array(F.col("d") / 1e6, (4 * F.col("d") + F.col("r")) / 4e6, (F.col("d") % 7) / 6).alias("x"),
                       (F.col("r") + F.col("d") % 7 > 4).cast("double").alias("label"))
    from pyspark.ml.functions import array_to_vector

    train = rows.select(array_to_vector("x").alias("features"), "label")
    model = NormalEquations().fit(train)
    x = vector_to_array("features")
    moments = residual_moments(model.transform(train).select("label", "prediction", *[x[j].alias(f"s{j}") for j in range(3)]), ["s0", "s1", "s2"])
    assert all(abs(r.moment) < 1e-10 for r in moments.collect())
    picked = rows.collect()
    z = np.array([[1.0, (r.x[1] - r.x[0]) * 4e6, r.x[0], r.x[2]] for r in picked])
    want = np.linalg.lstsq(z, np.array([r.label for r in picked]), rcond=None)[0]  # by the remainder itself
    assert model.coefficients[1] / 4e6 == pytest.approx(want[1], rel=1e-4) and model.condition < 10


def test_naive_bayes_maps_from_one_aggregate(spark, monkeypatch):
    df = build_vectors(spark, [([float(i % 5), float(i % 3)], float(i % 2)) for i in range(60)])
    nb, calls, sums = GroupedNaiveBayes(), [], GroupedNaiveBayes._sums
    monkeypatch.setattr(GroupedNaiveBayes, "_sums", lambda self, data: calls.append(1) or sums(self, data))
    grid = bayes_param_grid(nb)
    models = nb.fit(df, grid)
    assert len(calls) == 1
    for pmap, model in zip(grid, models, strict=True):
        one = nb.fit(df, pmap)
        assert (one.kind, one.prior, one.first, one.second) == (model.kind, model.prior, model.first, model.second)


def test_auc_scores_each_row_once(spark):
    """Neither the ranking nor the counts evaluate the score or prediction of a row twice."""
    done = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def scored(i):
        done.add(1)
        return None if i == 7 else float(i % 50) / 50

    base = spark.range(0, 400, 1, 2).select(scored("id").alias("score"), (F.col("id") % 3 == 0).cast("int").alias("trueLabel"))
    ranked = auc_roc(base).first().auc
    assert done.value == 400
    grouped = auc_by_group(base.withColumn("g", F.lit(1)), ["g"]).first().auc
    assert grouped == pytest.approx(ranked, abs=1e-12) and done.value == 800
    counted = base.withColumn("prediction", F.col("score"))
    assert classification_metrics(counted).first().n == 399 and done.value == 1200
    assert metrics_by_group(counted, ["trueLabel"]).agg(F.sum("n")).first()[0] == 399 and done.value == 1600
