"""Trees grown where their rows lie: the trees and scores of Spark's learner, without its histograms and copies."""

import random

import numpy as np
import pytest
from pyspark.ml.base import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from clickpipe.plans import counts, grown_trees
from clickpipe.plans.features import build_pipeline
from clickpipe.plans.grown_trees import GrownModel, cut_points, fit_grown, grows
from clickpipe.plans.models import make_learner
from clickpipe.plans.workflow import _fit_shared, fit_pipeline, training_input

NAMES = ["display_id", "document_id", "platform", "ad_id", "campaign_id", "advertiser_id"]


@pytest.fixture(scope="module")
def ready(spark):
    """4,000 rows with their number; values that repeat, many values, a constant and a noisy label."""
    r = random.Random(5)
    rows = []
    for _ in range(4000):
        a, b, c, d = r.randrange(300), r.randrange(7), r.random(), r.randrange(900)
        rows.append((float(a), float(b), c, float(d), 1.0, float((a < 90) != (b > 4)) if r.random() < 0.8 else float(r.random() < 0.5), r.randrange(1, 5)))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, label double, _copies long")
    return VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(df).repartition(3).persist()


def lines(model):
    return model.toDebugString.split("\n", 1)[1]


@pytest.mark.parametrize("local, params", [(1 << 16, {}), (300, {}), (300, {"maxDepth": 0}), (300, {"maxDepth": 5, "maxBins": 16})])
def test_tree_is_that_of_spark(ready, monkeypatch, local, params):
    monkeypatch.setattr(grown_trees, "LOCAL", local)
    learner = make_learner("dt", **params)
    own, grown = learner.fit(ready, {learner.weightCol: "_copies"}), fit_grown(learner, ready, "_copies")
    assert isinstance(grown, GrownModel) and lines(grown) == lines(own)
    assert grown.featureImportances == own.featureImportances and grown.numNodes == own.numNodes


@pytest.mark.parametrize("name, params", [("dt", {}), ("rf", {"numTrees": 4, "maxDepth": 9})])
def test_scores_are_those_of_the_native_model(ready, monkeypatch, name, params):
    monkeypatch.setattr(grown_trees, "LOCAL", 500)
    model = fit_grown(make_learner(name, **params), ready, "_copies")
    columns = ["rawPrediction", "probability", "prediction"]
    own = [tuple(r) for r in model.native().transform(ready).orderBy("c").select(columns).collect()]
    assert [tuple(r) for r in model.transform(ready).orderBy("c").select(columns).collect()] == own
    assert model.transform(ready).columns == [*ready.columns, *columns]
    model._arrays = None  # as beyond ARRAY_NODES: by joins with the table of nodes
    assert [tuple(r) for r in model.transform(ready).orderBy("c").select(columns).collect()] == own


def test_forest_depends_neither_on_partitions_nor_on_where_it_is_grown(ready, monkeypatch):
    learner = make_learner("rf", numTrees=3, maxDepth=8)
    texts = set()
    for parts, local, group in ((1, 1 << 16, 2048), (5, 400, 2048), (3, 100, 2)):
        monkeypatch.setattr(grown_trees, "LOCAL", local)
        monkeypatch.setattr(grown_trees, "GROUP", group)
        texts.add(lines(fit_grown(learner, ready.repartition(parts), "_copies")))
    assert len(texts) == 1
    assert texts != {lines(fit_grown(learner.copy({learner.seed: 7}), ready, "_copies"))}


def test_draws_are_those_of_a_forest(ready):
    """Each tree sees a row about as often as it stands for, with the spread of a Poisson draw; a node has its share of features."""
    packed, *_ = grown_trees.task_functions([np.array([0.5])], 2, 400, 1, 11, 5, True, 1 << 16, 1 << 16)
    import pyarrow as pa

    copies = [1, 3, 20, 100, 1000]
    batch = pa.RecordBatch.from_pydict({"x": pa.array([[float(i)] for i in range(5)]), "y": pa.array([0.0] * 5), "c": pa.array(copies)})
    out = next(iter(packed([batch]))).to_pylist()[0]
    w = np.frombuffer(out["w"], np.uint16 if out["wide"] == 2 else np.int64).reshape(400, 5)
    for i, mean in enumerate(copies):
        assert abs(w[:, i].mean() - mean) < 5 * (mean / 400) ** 0.5 and 0.7 < w[:, i].var() / mean < 1.35
    assert [grown_trees.features_each(make_learner("rf", featureSubsetStrategy=s), 6) for s in ("auto", "all", "sqrt", "log2", "onethird")] == [3, 6, 3, 3, 2]


def test_forest_learns_as_spark_does(ready):
    learner = make_learner("rf", numTrees=10, maxDepth=10)
    copies = ready.withColumn("_one", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).drop("_one")
    right = [m.transform(copies).filter("label = prediction").count() / copies.count() for m in (learner.fit(copies), fit_grown(learner, ready, "_copies"))]
    assert right[0] == pytest.approx(right[1], abs=0.03) and right[1] > 0.8


def test_cuts_are_few_or_nearest_to_equal_shares():
    assert list(cut_points(np.array([1.0, 1.0, 2.0, 4.0, np.nan]), np.ones(5), 7)) == [1.5, 3.0]
    found = cut_points(np.arange(1000.0), np.ones(1000), 3)
    assert len(found) == 3 and np.abs(found - np.array([249.5, 499.5, 749.5])).max() <= 1
    assert len(cut_points(np.array([5.0]), np.ones(1), 7)) == 0


def test_which_learners_are_grown(spark):
    assert grows(make_learner("dt")) and grows(make_learner("rf"))
    assert not any(grows(make_learner(n)) for n in ("gbt", "lr", "nb", "mlp"))
    assert not grows(make_learner("dt", minInstancesPerNode=2)) and not grows(make_learner("rf", subsamplingRate=0.5))
    assert not grows(make_learner("rf", featureSubsetStrategy="0.4")) and not grows(make_learner("dt", impurity="entropy"))


def test_labels_that_spark_refuses_are_left_to_it(ready):
    assert fit_grown(make_learner("dt"), ready.withColumn("label", F.col("label") + 0.5), "_copies") is None
    assert fit_grown(make_learner("dt"), ready.filter("label = 0"), "_copies") is None


@pytest.mark.parametrize("shared", [False, True])
def test_many_rows_are_fitted_without_copies(spark, monkeypatch, shared):
    """Above ``GROWN_ROWS`` no learner of Spark's passes over the rows or their copies."""
    kinds = [(*[float((i * k) % 23) for k in (1, 3, 5, 7, 11, 13)], i % 5 < 2) for i in range(90)]
    rows = spark.createDataFrame([(*k[:6], int(k[6])) for k in kinds for _ in range(6)], ", ".join(f"{c} double" for c in NAMES) + ", label int")
    monkeypatch.setattr(counts, "GROWN_ROWS", 100)
    seen, fit = [], Estimator.fit

    def spied(self, dataset, params=None):
        if type(self).__name__ in ("RandomForestClassifier", "DecisionTreeClassifier"):
            seen.append(dataset)
        return fit(self, dataset, params)

    monkeypatch.setattr(Estimator, "fit", spied)
    for name, params in (("rf", {"numTrees": 2, "maxDepth": 4}), ("dt", {})):
        if shared:
            with training_input(rows, counted_copies=True) as data:
                model = _fit_shared(build_pipeline(make_learner(name, **params)), data)
        else:
            model = fit_pipeline(name, rows, **params)
        assert isinstance(model.stages[-1], GrownModel) and not seen
        assert model.transform(rows).filter("prediction IN (0, 1)").count() == rows.count()
    fit_pipeline("dt", rows, maxDepth=1)  # few levels: Spark's own
    assert len(seen) == 1


def test_forest_of_stumps_deals_no_copies(spark, monkeypatch):
    """What a forest writes to disk grows with the distinct rows, not with their copies."""
    from clickpipe.plans import workflow

    rows = spark.createDataFrame([(*[float((i * k) % 23) for k in (1, 3, 5, 7, 11, 13)], int((i * 5) % 23 < 9)) for i in range(60) for _ in range(9)],
                                 ", ".join(f"{c} double" for c in NAMES) + ", label int")
    monkeypatch.setattr(counts, "GROWN_ROWS", 100)

    def dealt(*args, **named):
        raise AssertionError("copies were dealt")

    monkeypatch.setattr(workflow, "placed", dealt)
    model = fit_pipeline("rf", rows, maxDepth=1, featureSubsetStrategy="all")
    assert {t.depth for t in model.stages[-1].trees} == {1}
    assert model.transform(rows).filter("prediction = label").count() > 0.9 * rows.count()
