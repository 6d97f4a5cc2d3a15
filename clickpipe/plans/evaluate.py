"""Evaluation (A1-A3, E1-E6) as DataFrame aggregates.

The original job runs two evaluators and four ``filter(...).count()`` jobs,
each recomputing the joins and the scoring.  Here every count-based metric
comes out of one aggregate pass (partial aggregation on each task, one
row shuffled per task), and area under ROC is an exact, distributed
rank-sum computation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpipe.operators.assemble import TRUE_LABEL
from clickpipe.session import ensure_checkpoint_dir

PREDICTION = "prediction"

# The metric names of the original metrics table, in order.
METRIC_NAMES = ["TP", "FP", "TN", "FN", "Precision", "Recall"]


def _safe_div(num: Column, den: Column) -> Column:
    """``num / den`` as double, null when ``den`` is 0 (no error under ANSI)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(F.lit(2.0) * p * r / (p + r))


WEIGHT = "_rows"


def grouped_scores(pred: DataFrame, label_col: str = TRUE_LABEL, prediction_col: str = PREDICTION,
                   score_col: str | None = "score", count_col: str | None = None) -> DataFrame:
    """Predictions by (score, prediction, label) with their number ``_rows``: all
    that the metrics and the AUC need, from one scoring pass.  A row stands for
    ``count_col`` rows, if that is given."""
    number = F.count(F.lit(1)) if count_col is None else F.sum(count_col)
    score = F.lit(None).cast("double") if score_col is None else F.col(score_col).cast("double")
    return (pred.groupBy(score.alias("score"), F.col(prediction_col).alias(PREDICTION),
                         F.col(label_col).alias(TRUE_LABEL))
            .agg(number.alias(WEIGHT)))


def confusion_counts(pred: DataFrame, label_col: str = TRUE_LABEL,
                     prediction_col: str = PREDICTION) -> DataFrame:
    """A1: TP, FP, TN, FN and n in one pass (one row).

    Rows without a label or prediction count nowhere.  ``pred`` may be grouped
    (``grouped_scores``)."""
    p, y = F.col(prediction_col), F.col(label_col)
    w = F.col(WEIGHT) if WEIGHT in pred.columns else F.lit(1).cast("long")
    count = lambda c: F.coalesce(F.sum(F.when(c, w)), F.lit(0).cast("long"))
    # No filter: one on computed columns is pushed below them and computes them a second time.
    return pred.agg(
        count((p == 1.0) & (y == 1)).alias("tp"),
        count((p == 1.0) & (y == 0)).alias("fp"),
        count((p == 0.0) & (y == 0)).alias("tn"),
        count((p == 0.0) & (y == 1)).alias("fn"),
        count(p == y).alias("correct"),
        count(p.isNotNull() & y.isNotNull()).alias("n"),
    )


def classification_metrics(pred: DataFrame, label_col: str = TRUE_LABEL,
                           prediction_col: str = PREDICTION) -> DataFrame:
    """A1, A2, E1, E2, E3 in one pass.

    * precision = tp / (tp + fp), recall = tp / (tp + fn), null for 0/0;
    * accuracy = share of rows with prediction = label; test_error = 1 - accuracy;
    * f1 = F1 per class weighted by the class's share of true labels (what
      the original job printed as "AUC": the multiclass evaluator's default).
    """
    c = confusion_counts(pred, label_col, prediction_col)
    tp, fp, tn, fn, n = (F.col(x) for x in ("tp", "fp", "tn", "fn", "n"))
    p1 = F.coalesce(_safe_div(tp, tp + fp), F.lit(0.0))
    r1 = F.coalesce(_safe_div(tp, tp + fn), F.lit(0.0))
    p0 = F.coalesce(_safe_div(tn, tn + fn), F.lit(0.0))
    r0 = F.coalesce(_safe_div(tn, tn + fp), F.lit(0.0))
    f1 = (_safe_div(_f1(p1, r1) * (tp + fn).cast("double"), n)
          + _safe_div(_f1(p0, r0) * (tn + fp).cast("double"), n))
    accuracy = _safe_div(F.col("correct"), n)
    return c.select(
        "tp", "fp", "tn", "fn", "n",
        accuracy.alias("accuracy"),
        (F.lit(1.0) - accuracy).alias("test_error"),
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(tp, tp + fn).alias("recall"),
        f1.alias("f1"),
    )


def metrics_table(pred: DataFrame, label_col: str = TRUE_LABEL,
                  prediction_col: str = PREDICTION) -> DataFrame:
    """S9 + A1 + A2: ``(metric, value)`` rows TP, FP, TN, FN, Precision, Recall.

    Built with ``stack`` over the one aggregate row, so no value makes a
    round trip through the driver.  (One original variant printed TP as
    "Precision"; this is the real precision.)
    """
    m = classification_metrics(pred, label_col, prediction_col)
    pairs = ", ".join(f"'{name}', CAST({col} AS DOUBLE)" for name, col in
                      zip(METRIC_NAMES, ["tp", "fp", "tn", "fn", "precision", "recall"]))
    return m.select(F.expr(f"stack({len(METRIC_NAMES)}, {pairs}) AS (metric, value)"))


def probability_score(pred: DataFrame, probability_col: str = "probability",
                      name: str = "score") -> DataFrame:
    """Positive-class probability as a plain double column."""
    return pred.withColumn(name, vector_to_array(probability_col)[1])


def _scores_by(pred: DataFrame, keys: list[str], score_col: str, y: Column, count) -> DataFrame:
    """``(*keys, s, pos, neg)`` of the rows with a score and a label, written once.

    Rows without a score are dropped behind the write: a filter on the score before it
    would be pushed below the model and score every row a second time."""
    ensure_checkpoint_dir(pred.sparkSession)
    grouped = (pred.groupBy(*keys, F.col(score_col).cast("double").alias("s"))
               .agg(count(y == 1).alias("pos"), count(y == 0).alias("neg"), F.count(y).alias("_known")))
    return grouped.checkpoint(eager=True).filter("s IS NOT NULL AND _known > 0").drop("_known")


def auc_roc(pred: DataFrame, score_col: str = "score", label_col: str = TRUE_LABEL,
            target_bucket_rows: int = 1 << 18) -> DataFrame:
    """Exact area under the ROC curve, one row ``(auc)``.

    AUC = sum over positives of (#negatives scored lower + half the
    negatives tied) / (P * N).  Computed without a global sort:

    1. group by score -> (pos, neg) per distinct score (a hot score collapses
       to one row here);
    2. the distinct scores are cut into quantile buckets (boundaries from
       ``approxQuantile``: one number per ``target_bucket_rows`` distinct scores
       reaches the driver, 4,000 for a thousand million);
    3. negatives below each score = negatives in earlier buckets (a running
       sum over the bucket totals, joined back) + negatives earlier in the same
       bucket (a window over one bucket).

    ``pred`` may be grouped (``grouped_scores``).  Null when the labels are all of one class.
    """
    y = F.col(label_col)
    w = F.col(WEIGHT) if WEIGHT in pred.columns else F.lit(1).cast("long")
    count = lambda c: F.coalesce(F.sum(F.when(c, w)), F.lit(0).cast("long"))
    scores = _scores_by(pred, [], score_col, y, count)  # read for the count, the quantiles and the ranking
    distinct = scores.count()
    n_buckets = max(1, math.ceil(distinct / target_bucket_rows))
    if n_buckets == 1:
        # At most ``target_bucket_rows`` distinct scores: one ordered window.
        below = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
        ranked = scores.withColumn("neg_below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    else:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        cuts = sorted(set(scores.approxQuantile("s", probs, 1.0 / (4 * n_buckets))))
        splits = [-math.inf] + [c for c in cuts if math.isfinite(c)] + [math.inf]
        bucketed = Bucketizer(splits=splits, inputCol="s", outputCol="b",
                              handleInvalid="keep").transform(scores)
        totals = bucketed.groupBy("b").agg(F.sum("neg").alias("bneg"))
        before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select("b", F.coalesce(F.sum("bneg").over(before), F.lit(0)).alias("off"))
        within = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
        ranked = (bucketed.join(offsets, "b")
                  .withColumn("neg_below",
                              F.col("off") + F.coalesce(F.sum("neg").over(within), F.lit(0))))
    num = F.sum(F.col("pos") * (F.col("neg_below") + F.lit(0.5) * F.col("neg")))
    den = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(num, den).alias("auc"))


def auc_by_group(pred: DataFrame, keys: Sequence[str], score_col: str = "score",
                 label_col: str = TRUE_LABEL, target_bucket_rows: int = 1 << 18) -> DataFrame:
    """E4 for many groups at once: ``(*keys, auc)``, exact, from one rank-sum.

    As ``auc_roc``, with the running totals kept apart by group.  Each group's distinct
    scores are cut at its own quantiles (a mergeable sketch per group), so that no window
    holds more than about ``target_bucket_rows`` of them; the driver sees one number,
    the size of the largest group.  The grouped scores are written once and read three times.
    """
    keys = list(keys)
    y = F.col(label_col)
    w = F.col(WEIGHT) if WEIGHT in pred.columns else F.lit(1).cast("long")
    count = lambda c: F.coalesce(F.sum(F.when(c, w)), F.lit(0).cast("long"))
    scores = _scores_by(pred, keys, score_col, y, count)
    sizes = scores.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    n_buckets = max(1, math.ceil(largest / target_bucket_rows))
    bucketed = scores.withColumn("b", F.lit(0))
    if n_buckets > 1:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        cuts = scores.groupBy(*keys).agg(F.percentile_approx("s", probs, 4 * n_buckets).alias("_cuts"))
        bucketed = (scores.join(cuts, keys)
                    .withColumn("b", F.size(F.filter("_cuts", lambda c: c < F.col("s")))).drop("_cuts"))
    totals = bucketed.groupBy(*keys, "b").agg(F.sum("neg").alias("bneg"))
    before = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "b", F.coalesce(F.sum("bneg").over(before), F.lit(0)).alias("off"))
    within = Window.partitionBy(*keys, "b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (bucketed.join(offsets, [*keys, "b"])
              .withColumn("neg_below", F.col("off") + F.coalesce(F.sum("neg").over(within), F.lit(0))))
    num = F.sum(F.col("pos") * (F.col("neg_below") + F.lit(0.5) * F.col("neg")))
    den = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.groupBy(*keys).agg(F.try_divide(num, den).alias("auc"))


def metrics_by_group(pred: DataFrame, keys: Sequence[str], label_col: str = TRUE_LABEL,
                     prediction_col: str = PREDICTION) -> DataFrame:
    """A1, A2, E1-E3 and E5 for many groups of predictions at once, from one aggregate:
    ``(*keys, n, accuracy, test_error, precision, recall, f1, rmse)``."""
    p, y = F.col(prediction_col), F.col(label_col)
    w = F.col(WEIGHT) if WEIGHT in pred.columns else F.lit(1).cast("long")
    count = lambda c: F.coalesce(F.sum(F.when(c, w)), F.lit(0).cast("long"))
    gap = p.cast("double") - y.cast("double")
    c = pred.groupBy(*keys).agg(
        count((p == 1.0) & (y == 1)).alias("tp"), count((p == 1.0) & (y == 0)).alias("fp"),
        count((p == 0.0) & (y == 0)).alias("tn"), count((p == 0.0) & (y == 1)).alias("fn"),
        count(p == y).alias("correct"), count(p.isNotNull() & y.isNotNull()).alias("n"), F.sum(gap * gap * w).alias("squares"))
    return c.filter("n > 0").select(*keys, "n", *_rates())


def _rates() -> list[Column]:
    """The rates of confusion counts, as in ``classification_metrics``, and the RMSE."""
    tp, fp, tn, fn, n = (F.col(x) for x in ("tp", "fp", "tn", "fn", "n"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    positive = _f1(zero(_safe_div(tp, tp + fp)), zero(_safe_div(tp, tp + fn)))
    negative = _f1(zero(_safe_div(tn, tn + fn)), zero(_safe_div(tn, tn + fp)))
    accuracy = _safe_div(F.col("correct"), n)
    f1 = _safe_div(positive * (tp + fn).cast("double"), n) + _safe_div(negative * (tn + fp).cast("double"), n)
    return [accuracy.alias("accuracy"), (F.lit(1.0) - accuracy).alias("test_error"), _safe_div(tp, tp + fp).alias("precision"),
            _safe_div(tp, tp + fn).alias("recall"), f1.alias("f1"), F.sqrt(F.col("squares") / n).alias("rmse")]


def rmse(pred: DataFrame, label_col: str = "label", prediction_col: str = PREDICTION) -> DataFrame:
    """E5: root mean squared error of the prediction, one row ``(rmse)``."""
    d = F.col(prediction_col).cast("double") - F.col(label_col).cast("double")
    return pred.agg(F.sqrt(F.avg(d * d)).alias("rmse"))


SUMMARY_METRICS = ["accuracy", "test_error", "f1", "precision", "recall", "auc"]


def evaluation_row(pred: DataFrame, model_name: str, score_col: str | None = "score",
                   label_col: str = TRUE_LABEL) -> DataFrame:
    """E6 building block: one row ``(model, accuracy, test_error, f1, precision, recall, auc)``.

    The rows are scored and grouped once (``grouped_scores``, written to the shared
    folder); the metrics and the AUC are read from there, stacked into
    ``(metric, value)`` rows and pivoted back per model: no join.
    """
    ensure_checkpoint_dir(pred.sparkSession)
    pred = grouped_scores(pred, label_col, score_col=score_col).checkpoint(eager=True)
    score_col, label_col = score_col and "score", TRUE_LABEL
    m = classification_metrics(pred, label_col)
    pairs = ", ".join(f"'{c}', {c}" for c in SUMMARY_METRICS[:-1])
    long = m.select(F.expr(f"stack({len(SUMMARY_METRICS) - 1}, {pairs}) AS (metric, value)"))
    if score_col is None:
        auc = m.select(F.lit("auc").alias("metric"), F.lit(None).cast("double").alias("value"))
    else:
        auc = auc_roc(pred, score_col, label_col).select(F.lit("auc").alias("metric"),
                                                         F.col("auc").alias("value"))
    return (long.unionByName(auc).withColumn("model", F.lit(model_name))
            .groupBy("model").pivot("metric", SUMMARY_METRICS).agg(F.first("value")))
