"""Feature stages (F1-F4): assemble -> min-max scale -> re-wrap -> learner.

All three stages are Spark ML transformers evaluated per row inside the
executors; the scaler's fit is one distributed min/max aggregate over the
training half only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import MinMaxScaler, VectorAssembler

from clickpipe.operators.assemble import FEATURES

RAW_VECTOR = "normfeatures"
SCALED_VECTOR = "nfeatures"
FEATURE_VECTOR = "features"


def feature_stages(features: Sequence[str] = FEATURES, handle_invalid: str = "error") -> list:
    """F1 assemble, F2 scale to [0, 1] (fitted on the training half), F3 re-wrap.

    ``handle_invalid``: ``error`` (the original behaviour: a null feature
    fails the job), ``skip`` (drop such rows) or ``keep`` (NaN).
    A constant column scales to 0.5; unseen values are not clipped.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol=RAW_VECTOR,
                                handleInvalid=handle_invalid)
    scaler = MinMaxScaler(inputCol=RAW_VECTOR, outputCol=SCALED_VECTOR)
    rewrap_stage = VectorAssembler(inputCols=[SCALED_VECTOR], outputCol=FEATURE_VECTOR)
    return [assembler, scaler, rewrap_stage]


def build_pipeline(learner: Estimator | None, features: Sequence[str] = FEATURES,
                   handle_invalid: str = "error") -> Pipeline:
    """``Pipeline(stages=[assembler, minMax, featVect, learner])``."""
    stages = feature_stages(features, handle_invalid)
    if learner is not None:
        stages.append(learner)
    return Pipeline(stages=stages)
