import itertools
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from clickpipe.plans.evaluate import (auc_roc, classification_metrics, metrics_table, rmse)


def _pred(spark, rows):
    return spark.createDataFrame(rows, "prediction double, trueLabel int, score double")


def _brute_auc(rows):
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    if not pos or not neg:
        return None
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def test_auc_matches_brute_force_with_ties(spark):
    rnd = random.Random(5)
    rows = [(0.0, rnd.randint(0, 1), float(rnd.randint(0, 40)) / 4) for _ in range(600)]
    df = _pred(spark, rows)
    want = _brute_auc(rows)
    for target in (1 << 18, 8):  # single bucket; many quantile buckets
        got = auc_roc(df, target_bucket_rows=target).first().auc
        assert got == pytest.approx(want, abs=1e-12)


def test_auc_matches_spark_evaluator(spark):
    rnd = random.Random(9)
    rows = [(0.0, int(rnd.random() < 0.4 + 0.2 * x), x) for x in (rnd.random() for _ in range(3000))]
    df = _pred(spark, rows)
    from pyspark.ml.functions import array_to_vector

    ev = BinaryClassificationEvaluator(labelCol="trueLabel", rawPredictionCol="raw", numBins=0)
    raw = df.withColumn("raw", array_to_vector(F.array(-F.col("score"), F.col("score"))))
    assert auc_roc(df, target_bucket_rows=100).first().auc == pytest.approx(ev.evaluate(raw), abs=1e-12)


def test_auc_single_class_is_null(spark):
    assert auc_roc(_pred(spark, [(1.0, 1, 0.3), (0.0, 1, 0.1)])).first().auc is None


def test_confusion_counts_and_rates(spark):
    rows = [(1.0, 1, 0.0)] * 3 + [(1.0, 0, 0.0)] * 2 + [(0.0, 0, 0.0)] * 4 + [(0.0, 1, 0.0)] * 1
    df = _pred(spark, rows)
    m = {r.metric: r.value for r in metrics_table(df).collect()}
    assert m == {"TP": 3.0, "FP": 2.0, "TN": 4.0, "FN": 1.0, "Precision": 3 / 5, "Recall": 3 / 4}
    s = classification_metrics(df).first()
    assert s.accuracy == pytest.approx(0.7) and s.test_error == pytest.approx(0.3)
    f1 = MulticlassClassificationEvaluator(labelCol="trueLabel", metricName="f1").evaluate(df)
    assert s.f1 == pytest.approx(f1, abs=1e-15)
    acc = MulticlassClassificationEvaluator(labelCol="trueLabel", metricName="accuracy").evaluate(df)
    assert s.accuracy == pytest.approx(acc, abs=1e-15)


def test_no_positive_predictions_gives_null_precision(spark):
    df = _pred(spark, [(0.0, 1, 0.0), (0.0, 0, 0.0)])
    m = {r.metric: r.value for r in metrics_table(df).collect()}
    assert m["Precision"] is None and m["Recall"] == 0.0 and m["TP"] == 0.0


def test_empty_predictions(spark):
    df = _pred(spark, [(1.0, 1, 0.5)]).limit(0)
    s = classification_metrics(df).first()
    assert s.n == 0 and s.accuracy is None
    assert auc_roc(df).first().auc is None


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 1), (0.0, 1), (1.0, 0), (0.0, 0)], "prediction double, label int")
    assert rmse(df).first().rmse == pytest.approx(0.5 ** 0.5)


def test_null_labels_count_nowhere(spark):
    from clickpipe.plans.evaluate import classification_metrics, evaluation_row

    df = spark.createDataFrame([(1.0, 1, 0.9), (0.0, 0, 0.2), (1.0, None, 0.8)], "prediction double, trueLabel int, score double")
    m = classification_metrics(df).first()
    assert (m.n, m.accuracy, m.test_error, m.recall) == (2, 1.0, 0.0, 1.0)
    row = evaluation_row(df, "x").first()
    assert (row.accuracy, row.auc) == (1.0, 1.0)


def test_grouped_scores_give_the_same_metrics(spark):
    from clickpipe.plans.evaluate import auc_roc, classification_metrics, grouped_scores

    rows = [(float(i % 2), (i // 3) % 2, (i % 7) / 7) for i in range(500)]
    df = spark.createDataFrame(rows, "prediction double, trueLabel int, score double")
    g = grouped_scores(df)
    assert g.count() < 40
    assert classification_metrics(g).first() == classification_metrics(df).first()
    assert auc_roc(g).first().auc == pytest.approx(auc_roc(df).first().auc, abs=1e-12)
