"""The layered learner on distinct rows with their number.

Spark's learner takes no weights, so two hundred passes go over every copy of a row.  Its
loss is a mean over rows (over blocks of ``blockSize`` rows, of which the last of a partition
may be shorter; here every row weighs the same), so equal rows can be one term of their
number.  ``fit_layered`` minimises that mean by L-BFGS: the rows are packed into arrays once
and cached, a pass sums loss and gradient in tasks, and the driver sees one vector of the
weights' length a partition.  First weights (by seed) and the model are Spark's own.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of an array at most.
SLICE = 1 << 14
#: Steps that the estimate of the curvature remembers, as in Spark's learner.
MEMORY = 10
#: Tries for the length of a step.
TRIES = 30


def packer(size: int = SLICE):
    """A function from rows to arrays of features, class and number, of up to ``size`` rows each.

    Made here, like the one of ``loss_of``, so that it reaches tasks by value: they needn't import this package."""

    def arrays(rows):
        x, y, n = zip(*rows)
        return np.array(x, float), np.array(y, int), np.array(n, float)

    def packed(rows):
        held = []
        for row in rows:
            held.append(row)
            if len(held) == size:
                yield arrays(held)
                held = []
        if held:
            yield arrays(held)

    return packed


def loss_of(layers: list[int]) -> Callable[..., np.ndarray]:
    """A function of arrays and weights: summed cross entropy, the gradient's sum and the number of rows, as one vector.

    Sigmoid layers under a softmax; a layer's weights lie as Spark keeps them (by input, then the offsets)."""

    def loss_and_gradient(block, weights):
        x, y, n = block
        shaped, at = [], 0
        for i, o in zip(layers, layers[1:]):
            shaped.append((weights[at:at + i * o].reshape(i, o), weights[at + i * o:at + i * o + o]))
            at += i * o + o
        outs = [x]
        for w, b in shaped[:-1]:
            outs.append(0.5 * (1.0 + np.tanh(0.5 * (outs[-1] @ w + b))))
        z = outs[-1] @ shaped[-1][0] + shaped[-1][1]
        z -= z.max(1, keepdims=True)
        e = np.exp(z)
        whole = e.sum(1, keepdims=True)
        rows = np.arange(len(y))
        loss = n @ (np.log(whole[:, 0]) - z[rows, y])
        delta = e / whole
        delta[rows, y] -= 1.0
        delta *= n[:, None]
        parts = []
        for (w, _), out in zip(reversed(shaped), reversed(outs)):
            parts.append(np.concatenate([(out.T @ delta).ravel(), delta.sum(0)]))
            delta = (delta @ w.T) * out * (1.0 - out)
        return np.concatenate([[loss], *reversed(parts), [n.sum()]])

    return loss_and_gradient


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """L-BFGS with steps that meet the weak Wolfe conditions (by bisection)."""
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.linalg.norm(grad) <= max(tol * abs(value), 1e-8):
            break
        way, kept = -grad, []
        for s, y in reversed(past):
            kept.append((s @ way) / (s @ y))
            way = way - kept[-1] * y
        if past:
            s, y = past[-1]
            way = way * ((s @ y) / (y @ y))
        for (s, y), a in zip(past, reversed(kept)):
            way = way + (a - (y @ way) / (s @ y)) * s
        slope = grad @ way
        low, high, t = 0.0, np.inf, 1.0 if past else 1.0 / np.linalg.norm(grad)
        for _ in range(TRIES):
            found, there = f(x + t * way)
            if not found <= value + 1e-4 * t * slope:
                high = t
            elif there @ way < 0.9 * slope:
                low = t
            else:
                break
            t = (low + high) / 2 if np.isfinite(high) else 2 * low
        if not found < value:  # no better point along the way
            break
        moved, turned = t * way, there - grad
        gain = value - found
        x, value, grad = x + moved, found, there
        if moved @ turned > 0:
            past = [*past, (moved, turned)][-MEMORY:]
        if gain <= 1e-3 * tol * abs(value):
            break
    return x


def fit_layered(learner: MultilayerPerceptronClassifier, data: DataFrame, copies: str) -> MultilayerPerceptronClassificationModel:
    """The learner's model of rows that stand for ``copies`` equal ones each."""
    if learner.getSolver() != "l-bfgs":
        raise ValueError(f"rows with their number are fitted by l-bfgs, not {learner.getSolver()}")
    layers = learner.getLayers()
    start = learner.copy({learner.maxIter: 0}).fit(data).weights.toArray()
    rows = data.select(vector_to_array(learner.getFeaturesCol()), F.col(learner.getLabelCol()).cast("double"), F.col(copies).cast("double"))
    loss = loss_of(layers)
    blocks = rows.rdd.mapPartitions(packer()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        def mean(weights: np.ndarray) -> tuple[float, np.ndarray]:
            total = blocks.map(lambda b: loss(b, weights)).reduce(lambda a, b: a + b)  # by partition, in order
            return total[0] / total[-1], total[1:-1] / total[-1]

        found = minimise(mean, start, learner.getMaxIter(), learner.getTol())
    finally:
        blocks.unpersist()
    model = learner.copy({learner.initialWeights: Vectors.dense(found), learner.maxIter: 0}).fit(data)
    if learner.isSet(learner.initialWeights):
        model._set(initialWeights=learner.getInitialWeights())
    else:
        model.clear(model.initialWeights)
    return model._set(maxIter=learner.getMaxIter())
