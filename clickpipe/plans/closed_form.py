"""Learners whose sufficient statistics are one grouped aggregate.

``GroupedNaiveBayes``: counts, sums and sums of squares by class.
``NormalEquations``: the Gramian of features and label.

Both are ML estimators, so they go into pipelines, grids and cross-validation like
Spark's own.  A fit is one pass with partial aggregation; what reaches the driver
is one row a class, or one row.  A model is a few numbers and scores by column
expressions; no Python worker is used.  Rows without a label aren't fitted.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasPredictionCol,
                                     HasProbabilityCol, HasRawPredictionCol)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_CLASSES = 100


def _width(df: DataFrame, column: str) -> int:
    """Length of a vector column, from its metadata or its first row."""
    known = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    if known is not None:
        return known
    row = df.select(F.size(vector_to_array(column)).alias("n")).first()
    if row is None:
        raise ValueError("no rows to fit")
    return row["n"]


def _total(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


class GroupedNaiveBayes(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol,
                        HasProbabilityCol, HasRawPredictionCol):
    """Naive Bayes, ``gaussian`` or ``multinomial``.

    ``smoothing``: multinomial, added to every count; gaussian, this share of the
    largest variance is added to every variance.  Ties go to the smaller class.
    ``copiesCol``, if set, says for how many equal rows a row stands."""

    modelType = Param(Params._dummy(), "modelType", "gaussian or multinomial", TypeConverters.toString)
    smoothing = Param(Params._dummy(), "smoothing", "smoothing of the statistics", TypeConverters.toFloat)
    copiesCol = Param(Params._dummy(), "copiesCol", "column with the number of equal rows that a row stands for", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability",
                 rawPredictionCol="rawPrediction", modelType="gaussian", smoothing=1e-9):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability",
                         rawPredictionCol="rawPrediction", modelType="gaussian", smoothing=1e-9)

    def _fit(self, dataset: DataFrame) -> GroupedNaiveBayesModel:
        self._check()
        return self._model(self._sums(dataset))

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        """The models of all maps from one aggregate: its sums depend on neither kind nor smoothing."""
        learners = [self.copy(m) for m in paramMaps]
        if len({(one.getFeaturesCol(), one.getLabelCol(), one._copies_column()) for one in learners}) != 1:
            return super().fitMultiple(dataset, paramMaps)
        for one in learners:
            one._check()
        rows = learners[0]._sums(dataset)
        return iter([(i, one._model(rows)) for i, one in enumerate(learners)])

    def _check(self) -> None:
        kind = self.getOrDefault(self.modelType)
        if kind not in ("gaussian", "multinomial"):
            raise ValueError(f"modelType must be gaussian or multinomial, not {kind!r}")

    def _copies_column(self) -> str | None:
        return self.getOrDefault(self.copiesCol) if self.isDefined(self.copiesCol) else None

    def _sums(self, dataset: DataFrame) -> list:
        """One row a class: its number, each feature's sum and sum of squares, the least value."""
        copies = self._copies_column()
        c = F.lit(1).cast("long") if copies is None else F.col(copies)
        w = lambda v: v if copies is None else v * F.col("c")
        k = _width(dataset, self.getFeaturesCol())
        x = vector_to_array(self.getFeaturesCol())
        rows = (dataset.select(F.col(self.getLabelCol()).cast("double").alias("y"), x.alias("x"), c.alias("c")).filter("y IS NOT NULL")
                .groupBy("y").agg(F.sum("c").alias("n"), *[F.sum(w(F.col("x")[i])).alias(f"s{i}") for i in range(k)],
                                  *[F.sum(w(F.col("x")[i] * F.col("x")[i])).alias(f"q{i}") for i in range(k)],
                                  F.min(F.array_min("x")).alias("least"))
                .orderBy("y").limit(MAX_CLASSES + 1).collect())
        if not rows or len(rows) > MAX_CLASSES:
            raise ValueError(f"{len(rows) or 'no'} classes to fit (at most {MAX_CLASSES})")
        return rows

    def _model(self, rows: list) -> GroupedNaiveBayesModel:
        kind, smooth = self.getOrDefault(self.modelType), self.getOrDefault(self.smoothing)
        k = sum(c.startswith("s") for c in rows[0].asDict())
        n = np.array([r["n"] for r in rows], float)
        s, q = (np.array([[r[f"{c}{i}"] for i in range(k)] for r in rows], float) for c in "sq")
        if kind == "multinomial":
            if min(r["least"] for r in rows) < 0:
                raise ValueError("multinomial naive Bayes needs features of at least 0")
            prior = np.log(n + smooth) - math.log(n.sum() + smooth * len(n))
            first = np.log(s + smooth) - np.log(s.sum(1) + smooth * k)[:, None]
            second = np.zeros_like(first)
        else:
            prior = np.log(n) - math.log(n.sum())
            first = s / n[:, None]
            spread = q.sum(0) / n.sum() - (s.sum(0) / n.sum()) ** 2
            second = np.maximum(q / n[:, None] - first ** 2, 0) + smooth * max(spread.max(), 0)
            if (second <= 0).any():
                raise ValueError("a class has no variance; raise smoothing")
        model = GroupedNaiveBayesModel(kind, [r["y"] for r in rows], prior.tolist(), first.tolist(), second.tolist())
        return self._copyValues(model)


class GroupedNaiveBayesModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol,
                             HasProbabilityCol, HasRawPredictionCol):
    """Classes in ascending order with log priors and each feature's log weights
    (multinomial) or means and variances (gaussian)."""

    modelType = GroupedNaiveBayes.modelType
    smoothing = GroupedNaiveBayes.smoothing

    def __init__(self, kind=None, classes=(), prior=(), first=(), second=()):
        super().__init__()
        self.kind, self.classes, self.prior, self.first, self.second = kind, list(classes), prior, first, second

    def _likelihood(self, c: int, x: Column) -> Column:
        if self.kind == "multinomial":
            return F.lit(self.prior[c]) + _total([x[i] * F.lit(w) for i, w in enumerate(self.first[c])])
        fixed = self.prior[c] - 0.5 * sum(math.log(2 * math.pi * v) for v in self.second[c])
        gaps = [(x[i] - F.lit(m)) * (x[i] - F.lit(m)) / F.lit(2 * v) for i, (m, v) in enumerate(zip(self.first[c], self.second[c], strict=True))]
        return F.lit(fixed) - _total(gaps)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # Plain columns, one select a step: each vector is taken apart and each likelihood computed once a row.
        every = range(len(self.classes))
        out = dataset.withColumn("_x", vector_to_array(self.getFeaturesCol()))
        out = out.select("*", *[self._likelihood(c, F.col("_x")).alias(f"_r{c}") for c in every])
        out = out.withColumn("_top", F.greatest(*[F.col(f"_r{c}") for c in every]) if len(self.classes) > 1 else F.col("_r0"))
        out = out.select("*", *[F.exp(F.col(f"_r{c}") - F.col("_top")).alias(f"_p{c}") for c in every])
        out = out.withColumn("_whole", _total([F.col(f"_p{c}") for c in every]))
        raw = F.array(*[F.col(f"_r{c}") for c in every])
        classes = F.array(*map(F.lit, map(float, self.classes)))
        return out.select(*dataset.columns, array_to_vector(raw).alias(self.getRawPredictionCol()),
                          array_to_vector(F.array(*[F.col(f"_p{c}") / F.col("_whole") for c in every])).alias(self.getProbabilityCol()),
                          F.get(classes, F.array_position(raw, F.col("_top")).cast("int") - 1).alias(self.getPredictionCol()))


def _condition(values: np.ndarray, ridge: float) -> float:
    """Condition number from ascending eigenvalues and a penalty."""
    low = values[0] + ridge
    return float("inf") if low <= 0 else float((values[-1] + ridge) / low)


def _comoments(rows: DataFrame, columns: list[Column], target: Column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean products of the columns' gaps from their means with each other and with the target, and the means."""
    k = len(columns)
    named = rows.select(*[c.alias(f"u{i}") for i, c in enumerate(columns)], target.alias("u"))
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    found = named.agg(*[F.covar_pop(f"u{i}", f"u{j}").alias(f"g{i}_{j}") for i, j in cells],
                      *[F.covar_pop(f"u{i}", "u").alias(f"t{i}") for i in range(k)],
                      *[F.avg(f"u{i}").alias(f"m{i}") for i in range(k)]).first()
    gram = np.zeros((k, k))
    for i, j in cells:
        gram[i, j] = gram[j, i] = found[f"g{i}_{j}"]
    target, means = (np.array([found[f"{c}{i}"] for i in range(k)], float) for c in "tm")
    return gram, target, means


class NormalEquations(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Least squares with an intercept, from one Gramian aggregate.

    ``regParam`` is the ridge penalty on standardised features, per row.  Constant
    features get the coefficient 0.  Where the condition number of the remaining
    features' correlations is above ``maxCondition`` (it grows with the square of
    the range of two features that differ by a bounded amount), a second aggregate
    takes the Gramian of an orthogonal basis of them.  Features that are dependent
    to the last digits stay so in that basis: its condition number is checked in
    turn, and the fit fails and names the features of the smallest eigenvector."""

    regParam = Param(Params._dummy(), "regParam", "ridge penalty", TypeConverters.toFloat)
    maxCondition = Param(Params._dummy(), "maxCondition", "largest condition number accepted", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", regParam=0.0, maxCondition=1e10):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", regParam=0.0, maxCondition=1e10)

    def _fit(self, dataset: DataFrame) -> NormalEquationsModel:
        k = _width(dataset, self.getFeaturesCol())
        x, y = vector_to_array(self.getFeaturesCol()), F.col(self.getLabelCol()).cast("double")
        rows = dataset.select(x.alias("x"), y.alias("y")).filter("y IS NOT NULL")
        z = [F.col("x")[i] for i in range(k)] + [F.col("y")]
        cells = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
        # Co-moments about running means, merged across tasks: large, close values don't cancel.
        sums = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(z)],
                        *[F.covar_pop(z[i], z[j]).alias(f"g{i}_{j}") for i, j in cells]).first()
        if not sums["n"]:
            raise ValueError("no rows to fit")
        mean = np.array([sums[f"m{i}"] for i in range(k)], float)
        gram = np.zeros((k + 1, k + 1))
        for i, j in cells:
            gram[i, j] = gram[j, i] = sums[f"g{i}_{j}"]
        scale = np.sqrt(np.maximum(np.diag(gram)[:k], 0))
        live = np.flatnonzero(scale > 1e-12 * np.maximum(1, np.abs(mean)))
        weights, shift, condition, ridge = np.zeros(k), 0.0, 1.0, self.getOrDefault(self.regParam)
        if len(live):
            shared = gram[np.ix_(live, live)] / np.outer(scale[live], scale[live])
            target, basis, offsets = gram[live, k] / scale[live], np.eye(len(live)), np.zeros(len(live))
            values, vectors = np.linalg.eigh(shared)
            condition = _condition(values, ridge)
            if condition > self.getOrDefault(self.maxCondition):
                # The sums' last digits hide what sets these features apart: a second pass sums
                # the products of an orthogonal basis of them, where they are of one size.
                basis = vectors / np.sqrt(np.maximum(values, 1e-15 * values[-1]))
                turned = [_total([(z[i] - F.lit(float(mean[i]))) * F.lit(float(basis[a, j] / scale[i])) for a, i in enumerate(live)]) for j in range(len(live))]
                shared, target, offsets = _comoments(rows, turned, z[k])
                shared = shared + ridge * basis.T @ basis
                values, vectors = np.linalg.eigh(shared)
                condition, ridge = _condition(values, 0.0), 0.0
            if condition > self.getOrDefault(self.maxCondition):
                weak = basis @ vectors[:, 0]
                guilty = [int(live[i]) for i in np.flatnonzero(np.abs(weak) > 0.1 * np.linalg.norm(weak))]
                raise ValueError(f"features {guilty} are nearly dependent (condition number {condition:.3g})")
            inner = shared + ridge * np.eye(len(live))
            solved = np.linalg.solve(inner, target)
            weights[live], shift = basis @ solved / scale[live], float(offsets @ solved)
        model = NormalEquationsModel(weights.tolist(), float(sums[f"m{k}"] - shift - weights @ mean), condition)
        return self._copyValues(model)


class NormalEquationsModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """``coefficients``, ``intercept`` and the ``condition`` number of the equations solved."""

    regParam = NormalEquations.regParam
    maxCondition = NormalEquations.maxCondition

    def __init__(self, coefficients=(), intercept=0.0, condition=1.0):
        super().__init__()
        self.coefficients, self.intercept, self.condition = list(coefficients), intercept, condition

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(self.getFeaturesCol())
        value = _total([F.lit(self.intercept)] + [x[i] * F.lit(w) for i, w in enumerate(self.coefficients)])
        return dataset.withColumn(self.getPredictionCol(), value)


def residual_moments(scored: DataFrame, features: list[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``feature`` and the mean of feature times residual (``(intercept)``: of the residual):
    all 0 for least squares, and for no other coefficients."""
    gap = F.col(label).cast("double") - F.col(prediction)
    means = scored.agg(F.avg(gap).alias("m0"), *[F.avg(F.col(c) * gap).alias(f"m{i}") for i, c in enumerate(features, 1)])
    names = ["(intercept)", *features]
    pairs = ", ".join(f"'{c}', m{i}" for i, c in enumerate(names))
    return means.select(F.expr(f"stack({len(names)}, {pairs}) AS (feature, moment)"))
