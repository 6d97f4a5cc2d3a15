"""Fits on distinct rows with their number in place of the rows one by one.

The joins copy a display's clicks onto every ad of its document, so the training half holds
equal rows.  A learner whose sums are weighted fits the distinct rows, weighted by their
number, as it fits the copies, with fewer rows in every pass.  Learners that draw rows
(forests) keep the copies up to ``GROWN_ROWS`` of them; beyond, forests and deep trees are
grown from counted rows (``grown_trees``).  The layered learner, which takes no weight, keeps
the copies unless its fit on counted rows (``layered``) is asked for.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpipe.plans.closed_form import GroupedNaiveBayes
from clickpipe.plans.grown_trees import fit_grown, grows
from clickpipe.plans.layered import fit_layered

COPIES = "_copies"
#: The gap between weighted and plain deviations up to which logistic regression takes counts: it
#: shrinks with the rows (by about one a row), and shows in models that stop before they converge.
DEVIATION_GAP = 1e-6
#: Copies up to which Spark's own learner fits forests and deep trees in a few passes of small histograms.
GROWN_ROWS = 1 << 18
#: The depth up to which a single tree is Spark's own whatever the rows: a pass a level.
SHALLOW = 8


def takes_counts(learner) -> bool:
    """Whether the learner's model of counted rows is that of the copies: no draws of rows or
    features, no bound on a node's number of rows, no weight of its own, no L1 part."""
    if not learner.hasParam("weightCol") or learner.isSet(learner.weightCol):
        return False
    if isinstance(learner, LogisticRegression):
        return learner.getElasticNetParam() == 0 or learner.getRegParam() == 0
    if not isinstance(learner, (DecisionTreeClassifier, GBTClassifier)) or learner.getMinInstancesPerNode() != 1:
        return False
    return (isinstance(learner, DecisionTreeClassifier)
            or (learner.getSubsamplingRate() == 1.0 and learner.getFeatureSubsetStrategy() == "all"
                and not learner.isDefined(learner.validationIndicatorCol)))


def reads_features_only(learner) -> bool:
    """Whether the learner passes several times over its features and label, and no other column."""
    kinds = (DecisionTreeClassifier, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier)
    return isinstance(learner, kinds) and not any(learner.hasParam(p) and learner.isDefined(learner.getParam(p)) for p in ("weightCol", "validationIndicatorCol"))


def penalty_share(data: DataFrame) -> float:
    """The factor on an L2 penalty under which counted rows have the penalty of their copies.

    The learner divides by the standard deviation, whose denominator is ``n - 1`` for n rows and
    ``n - sum(w * w) / n`` for weights w of sum n: all features change by one factor."""
    n, squares = data.agg(F.sum(COPIES), F.sum(F.col(COPIES).cast("double") * F.col(COPIES))).first()
    return (n - squares / n) / (n - 1) if n and n > 1 and squares < n * n else 1.0


def use_counts(learner, data: DataFrame) -> bool:
    """Whether to fit the learner on these counted rows (else on their copies)."""
    if not takes_counts(learner):
        return False
    return not isinstance(learner, LogisticRegression) or abs(penalty_share(data) - 1.0) <= DEVIATION_GAP


def fit_counted(learner, data: DataFrame, share: float | None = None):
    """The learner's model of rows with their number ``_copies``; its parameters are the learner's."""
    if isinstance(learner, MultilayerPerceptronClassifier):
        return fit_layered(learner, data, COPIES)
    if isinstance(learner, GroupedNaiveBayes):
        return learner.fit(data, {learner.copiesCol: COPIES})
    weighted = {learner.weightCol: COPIES}
    if not isinstance(learner, LogisticRegression) or not learner.getStandardization() or not learner.getRegParam():
        return learner.fit(data, weighted)
    share = penalty_share(data) if share is None else share
    model = learner.fit(data, weighted | {learner.regParam: learner.getRegParam() * share})
    return model._set(regParam=learner.getRegParam())


def use_growth(learner, rows: int) -> bool:
    """Whether to grow the learner's trees from their counted rows (else Spark's own learner fits)."""
    return rows > GROWN_ROWS and grows(learner) and (isinstance(learner, RandomForestClassifier) or learner.getMaxDepth() > SHALLOW)


def fit_pipeline_counted(pipeline: Pipeline, data: DataFrame) -> PipelineModel:
    """``pipeline.fit`` on rows with their number ``_copies``: the stages before the learner are
    fitted and applied once, and what the learner reads is cached for its passes."""
    return _fit_ready(pipeline, data, fit_counted)


def fit_pipeline_grown(pipeline: Pipeline, data: DataFrame, partitions: int | None = None) -> PipelineModel | None:
    """As ``fit_pipeline_counted``, with trees grown where their rows lie; None for input that Spark's learner has to judge."""
    return _fit_ready(pipeline, data, lambda learner, ready: fit_grown(learner, ready, COPIES), partitions)


def _fit_ready(pipeline: Pipeline, data: DataFrame, fit, partitions: int | None = None) -> PipelineModel | None:
    *before, learner = pipeline.getStages()
    features = Pipeline(stages=before).fit(data)
    if partitions:
        data = data.repartition(partitions, *[c for c in data.columns if c != COPIES])
    ready = features.transform(data).select(learner.getFeaturesCol(), learner.getLabelCol(), COPIES)
    if not isinstance(learner, GroupedNaiveBayes):  # which reads them once
        ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = fit(learner, ready)
    finally:
        ready.unpersist()
    return None if model is None else PipelineModel([*features.stages, model])
