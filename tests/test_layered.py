"""The layered learner on distinct rows with their number."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml.base import Estimator
from pyspark.ml.feature import VectorAssembler

from clickpipe.plans.counts import COPIES, fit_counted
from clickpipe.plans.layered import loss_of, packer
from clickpipe.plans.models import make_learner


@pytest.fixture(scope="module")
def counted(spark):
    """Exclusive or with some wrong labels, 120 copies of eight kinds of rows."""
    kinds = [(a, b, int(a != b) if right else int(a == b), (27 + a) if right else 2 + b) for a in (0, 1) for b in (0, 1) for right in (True, False)]
    rows = spark.createDataFrame([(float(a), float(b), y, n) for a, b, y, n in kinds], f"a double, b double, label int, {COPIES} long").coalesce(1)
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)


def _copies(counted):
    return counted.selectExpr("features", "label", f"explode(sequence(1L, {COPIES})) AS _copy", f"1L AS {COPIES}").coalesce(1)


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(3)
    layers = [3, 4, 2, 3]
    loss = loss_of(layers)
    block = (rng.normal(size=(9, 3)), rng.integers(0, 3, 9), rng.integers(1, 5, 9).astype(float))
    w = rng.normal(size=sum(i * o + o for i, o in zip(layers, layers[1:])))
    found = loss(block, w)
    for i in range(len(w)):
        step = np.zeros_like(w)
        step[i] = 1e-6
        slope = (loss(block, w + step)[0] - loss(block, w - step)[0]) / 2e-6
        assert found[1 + i] == pytest.approx(slope, rel=1e-5, abs=1e-6)
    assert found[-1] == block[2].sum()


def test_tasks_need_not_import_the_package():
    sent = [cloudpickle.dumps(f) for f in (packer(), loss_of([2, 2]))]
    code = "import pickle, sys; f, g = map(pickle.loads, eval(sys.stdin.read())); print(sum(b[2].sum() for b in f([([0.0, 1.0], 1, 2), ([1.0, 1.0], 0, 3)])))"
    out = subprocess.run([sys.executable, "-c", code], input=repr(sent), capture_output=True, text=True, cwd="/", env={**os.environ, "PYTHONPATH": ""})
    assert out.stdout.strip() == "5.0", out.stderr


def test_counted_fit_is_that_of_the_copies(counted):
    learner = make_learner("mlp", layers=[2, 8, 2])
    rows = _copies(counted)
    assert 100 < rows.count() <= learner.getBlockSize()  # one block: Spark's mean is the mean of the rows
    few, many, spark_own = fit_counted(learner, counted), fit_counted(learner, rows), learner.fit(rows)
    p = [[r.probability[1] for r in m.transform(counted).collect()] for m in (few, many, spark_own)]
    assert p[0] == pytest.approx(p[1], abs=1e-3) and p[0] == pytest.approx(p[2], abs=2e-2)
    assert few.getMaxIter() == 200 and not few.isSet(few.initialWeights)
    assert type(few) is type(spark_own) and few.transform(counted).filter("prediction <> (CASE WHEN label = 1 THEN 1 ELSE 0 END)").count() == 4


def test_first_weights_are_those_of_the_seed(counted):
    learner = make_learner("mlp", layers=[2, 8, 2], maxIter=0)
    assert fit_counted(learner, counted).weights == learner.fit(_copies(counted)).weights
    with pytest.raises(ValueError):
        fit_counted(make_learner("mlp", layers=[2, 8, 2], solver="gd"), counted)


def test_xor_passes_over_distinct_rows(spark, monkeypatch):
    from clickpipe.plans.more_queries import q_mlp_xor

    seen, fit = [], Estimator.fit

    def spied(self, dataset, params=None):
        if type(self).__name__ == "MultilayerPerceptronClassifier":
            seen.append(dataset.count())
        return fit(self, dataset, params)

    monkeypatch.setattr(Estimator, "fit", spied)
    found = {r.metric: r.value for r in q_mlp_xor(spark, "/root/testdata/sf0.001").collect()}
    assert seen and max(seen) <= 8
    assert found["Precision"] == found["Recall"] == 1.0 and found["FP"] == found["FN"] == 0.0
