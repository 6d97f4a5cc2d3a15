"""Learners (M1-M4) with the original parameters as defaults.

``cacheNodeIds`` + ``checkpointInterval`` keep deep trees from re-walking every
tree per iteration and cut the node-id lineage into the checkpoint folder.

``maxMemoryInMB`` bounds the histograms of one group of tree nodes.  A random
forest draws its feature subsets group by group, so the value is part of the
model: it is a constant here (``TREE_MEMORY_MB``) or an explicit argument, and
never read from the session.  Each task holds up to this much at a time, so size
executors for ``task slots * maxMemoryInMB``; 32 MB fits a 1 GB session, larger
values need fewer passes over the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)

from clickpipe.operators.assemble import LABEL
from clickpipe.plans.closed_form import GroupedNaiveBayes, NormalEquations
from clickpipe.plans.features import FEATURE_VECTOR

# The original learner parameters.
DT_PARAMS = {"impurity": "gini", "maxDepth": 30, "maxBins": 128, "seed": 1234}
GBT_PARAMS = {"maxIter": 10}
LR_PARAMS = {"maxIter": 10, "regParam": 0.3}
RF_PARAMS = {"impurity": "gini", "featureSubsetStrategy": "auto", "numTrees": 10,
             "maxDepth": 30, "maxBins": 128, "seed": 1234}

# Six features, one hidden layer, two classes.
MLP_LAYERS = (6, 8, 2)
MLP_PARAMS = {"maxIter": 200, "blockSize": 128, "tol": 1e-6}

TREE_MEMORY_MB = 32
TREE_SCALE = {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": TREE_MEMORY_MB}


def _common(label_col: str, features_col: str) -> dict:
    return {"labelCol": label_col, "featuresCol": features_col}


def decision_tree(label_col: str = LABEL, features_col: str = FEATURE_VECTOR, **overrides):
    """M1: Gini decision tree, depth 30, 128 bins, seed 1234."""
    params = {**DT_PARAMS, **TREE_SCALE, **overrides}
    return DecisionTreeClassifier(**_common(label_col, features_col), **params)


def gradient_boosted_trees(label_col: str = LABEL, features_col: str = FEATURE_VECTOR,
                           seed: int = 1234, **overrides):
    """M2: 10 boosting rounds, other parameters Spark's defaults (depth 5, 32 bins)."""
    params = {**GBT_PARAMS, **TREE_SCALE, "seed": seed, **overrides}
    return GBTClassifier(**_common(label_col, features_col), **params)


def logistic_regression(label_col: str = LABEL, features_col: str = FEATURE_VECTOR, **overrides):
    """M3: 10 iterations, regParam 0.3, elastic net 0 (L2)."""
    return LogisticRegression(**_common(label_col, features_col), **{**LR_PARAMS, **overrides})


def random_forest(label_col: str = LABEL, features_col: str = FEATURE_VECTOR, **overrides):
    """M4: 10 Gini trees of depth 30, 128 bins, feature subset auto, seed 1234."""
    params = {**RF_PARAMS, **TREE_SCALE, **overrides}
    return RandomForestClassifier(**_common(label_col, features_col), **params)


def naive_bayes(label_col: str = LABEL, features_col: str = FEATURE_VECTOR, **overrides):
    """Gaussian or multinomial naive Bayes from one grouped aggregate."""
    return GroupedNaiveBayes(**_common(label_col, features_col), **overrides)


def linear_regression(label_col: str = LABEL, features_col: str = FEATURE_VECTOR, **overrides):
    """Least squares from one Gramian aggregate."""
    return NormalEquations(**_common(label_col, features_col), **overrides)


def multilayer_perceptron(label_col: str = LABEL, features_col: str = FEATURE_VECTOR,
                          layers: Sequence[int] = MLP_LAYERS, seed: int = 1234, **overrides):
    """Layered learner: ``layers`` from the features to the classes.

    Its gradient is a sum over blocks of ``blockSize`` rows of a partition, and its
    first weights are drawn from ``seed``; on the prepared training input (dealt and
    sorted by content) one seed is one model."""
    return MultilayerPerceptronClassifier(**_common(label_col, features_col), layers=list(layers),
                                          seed=seed, **{**MLP_PARAMS, **overrides})


LEARNERS = {
    "dt": decision_tree,
    "gbt": gradient_boosted_trees,
    "lr": logistic_regression,
    "rf": random_forest,
    "nb": naive_bayes,
    "linear": linear_regression,
    "mlp": multilayer_perceptron,
}


def make_learner(name: str, **overrides):
    try:
        return LEARNERS[name](**overrides)
    except KeyError:
        raise ValueError(f"unknown learner {name!r}; choose from {sorted(LEARNERS)}") from None
