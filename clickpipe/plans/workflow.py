"""End-to-end jobs: prepare -> fit -> score -> evaluate, and the sampling job.

``prepare`` builds the labelled table and splits it; ``fit_and_score`` fits
one pipeline on the training half (persisted for the learner's passes) and
returns the lazy scored test half.  Nothing is collected to the driver except model
parameters and a few scalars.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpipe.functions.hashing import seed_salt
from clickpipe.operators.assemble import LABEL, as_test, labelled_data
from clickpipe.operators.sampling import exact_n_sample, hash_split, random_split, sample_tables
from clickpipe.plans.closed_form import GroupedNaiveBayes
from clickpipe.plans.counts import (COPIES, fit_pipeline_counted, fit_pipeline_grown, reads_features_only, takes_counts,
                                    use_counts, use_growth)
from clickpipe.plans.evaluate import evaluation_row, metrics_table, probability_score
from clickpipe.plans.features import build_pipeline
from clickpipe.plans.grown_trees import grows
from clickpipe.plans.models import make_learner
from clickpipe.session import ensure_checkpoint_dir
from clickpipe.sources.invalid import apply_policy
from clickpipe.sources.tables import load_table, write_csv


@dataclass
class Split:
    train: DataFrame
    test: DataFrame


DEFAULT_SEED = 1234


def prepare(tables: Mapping[str, DataFrame], join_on: str = "document", cast: bool = True,
            split: str = "hash", seed: int = DEFAULT_SEED, train_fraction: float = 0.7,
            invalid: str = "keep") -> Split:
    """Labelled table -> 70/30 split; the test half's label is ``trueLabel``.

    ``seed`` salts the hash split (the default seed has no salt) and seeds the
    random one; ``invalid`` is the policy for null features and labels."""
    data = labelled_data(tables["event"], tables["train"], tables["promoted_content"],
                         join_on=join_on, cast=cast, invalid=invalid)
    if split == "hash":
        # 10 buckets for fractions in tenths (the default 7/3), else 1000.
        buckets = 10 if abs(train_fraction * 10 - round(train_fraction * 10)) < 1e-9 else 1000
        train, test = hash_split(data, train_buckets=int(round(train_fraction * buckets)),
                                 buckets=buckets, salt=seed_salt(seed, DEFAULT_SEED))
    elif split == "random":
        train, test = random_split(data, [train_fraction, 1 - train_fraction], seed=seed)
    else:
        raise ValueError(f"split must be 'hash' or 'random', not {split!r}")
    return Split(train, as_test(test))


# Bytes per training row as cached: six double features and the label.
TRAIN_ROW_BYTES = 64
# A small input is cut finely, so that several cores share it; each further partition sends a
# whole histogram for every group of nodes, so larger ones hold more rows.
FEW_PARTITIONS = 8
FEW_ROWS = 1 << 16
ROWS_PER_PARTITION = 1 << 18
SMALL_PARTITIONS = 256
TARGET_PARTITION_BYTES = 512 << 20


def training_partitions(rows: int) -> int:
    """Partitions of a training input: one per ``FEW_ROWS`` rows up to ``FEW_PARTITIONS``, one per
    ``ROWS_PER_PARTITION`` up to ``SMALL_PARTITIONS``, and beyond as many as hold 512 MB each.
    A function of the data alone: the learners' sums and draws go by partition."""
    few = min(FEW_PARTITIONS, math.ceil(rows / FEW_ROWS))
    by_rows = min(SMALL_PARTITIONS, math.ceil(rows / ROWS_PER_PARTITION))
    return max(1, few, by_rows, math.ceil(rows * TRAIN_ROW_BYTES / TARGET_PARTITION_BYTES))


def counted_rows(train: DataFrame) -> DataFrame:
    """Distinct rows with their number ``_copies``, combined on the map side."""
    return train.groupBy(*train.columns).agg(F.count(F.lit(1)).alias(COPIES))


def placed(counted: DataFrame, partitions: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """The counted rows dealt by their content and sorted, the same on any cluster.

    Equal rows are numbered, so that a row that makes up a large part of the input
    is spread like any other.  Columns ``carried`` are made of the others and deal nothing."""
    columns = [c for c in counted.columns if c != COPIES and c not in carried]
    numbered = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), COPIES)))
    return (numbered.repartition(partitions, *columns, "_copy")
            .sortWithinPartitions(*columns, "_copy").select(*columns, *carried))


def placed_counted(counted: DataFrame, partitions: int) -> DataFrame:
    """The counted rows dealt and sorted as in ``placed``, each once with its number."""
    columns = [c for c in counted.columns if c != COPIES]
    return counted.repartition(partitions, *columns).sortWithinPartitions(*columns)


@contextmanager
def _grouped(train: DataFrame, max_fit_rows: int | None = None, seed: int = DEFAULT_SEED):
    """The distinct rows of a fit with their number, cached; how many rows and distinct ones."""
    counted = counted_rows(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows, distinct = counted.agg(F.coalesce(F.sum(COPIES), F.lit(0)), F.count(F.lit(1))).first()
        if max_fit_rows is not None and rows > max_fit_rows:
            train = exact_n_sample(train, max_fit_rows / rows, seed=seed)
            yield counted_rows(train), max_fit_rows, min(distinct, max_fit_rows)
        else:
            yield counted, rows, distinct
    finally:
        counted.unpersist()


@contextmanager
def training_input(train: DataFrame, partitions: int | None = None, max_fit_rows: int | None = None,
                   seed: int = DEFAULT_SEED, counted_copies: bool = False):
    """The training half as the learners should see it: even, sized, in a fixed order, cached.

    Learners pass over their input once per tree level or optimizer iteration.
    ``partitions`` (by default from the number of rows) and the placement don't
    depend on the session, so one seed means one model.  ``max_fit_rows``
    bounds the rows of the fit (an exact sample by content; default: all rows):
    tree models live on the driver and grow with their input.  ``counted_copies``
    gives equal rows once, with their number ``_copies`` (see ``counts``).

    The joins behind ``train`` run once: their grouped rows are cached, counted, and
    let go when the placed rows are cached in turn.
    """
    with _grouped(train, max_fit_rows, seed) as (source, rows, distinct):
        deal, size = (placed_counted, distinct) if counted_copies else (placed, rows)
        data = deal(source, partitions or training_partitions(size)).persist(StorageLevel.MEMORY_AND_DISK)
        data.count()
    try:
        yield data
    finally:
        data.unpersist()


@contextmanager
def dealt_copies(data: DataFrame, partitions: int | None = None):
    """The copies of a training input of counted rows, as ``training_input`` deals them."""
    rows = data.agg(F.sum(COPIES)).first()[0] or 0
    copies = placed(data, partitions or training_partitions(rows)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield copies
    finally:
        copies.unpersist()


def fit_pipeline(learner: Estimator | str, train: DataFrame, handle_invalid: str = "error",
                 partitions: int | None = None, max_fit_rows: int | None = None,
                 **learner_params) -> PipelineModel:
    """F4 + F5: fit assembler, scaler and learner on the training half.

    ``handle_invalid`` goes to the assembler: ``error``, ``skip`` or ``keep``.
    A row without a label fails the fit under ``error`` and isn't fitted otherwise."""
    est = make_learner(learner, **learner_params) if isinstance(learner, str) else learner
    train = apply_policy(train, [LABEL], "error" if handle_invalid == "error" else "skip")
    counts = takes_counts(est)
    pipeline = build_pipeline(est, handle_invalid=handle_invalid)
    if not counts and reads_features_only(est):
        return _fit_copies(pipeline, train, partitions, max_fit_rows)
    with training_input(train, partitions, max_fit_rows, counted_copies=counts) as data:
        return _fit_shared(pipeline, data, partitions) if counts else pipeline.fit(data)


def _fit_copies(pipeline: Pipeline, train: DataFrame, partitions: int | None = None,
                max_fit_rows: int | None = None) -> PipelineModel:
    """``pipeline.fit`` on ``training_input``: the stages before the learner are fitted on the
    distinct rows and applied once; only what the learner's passes read is cached.  A forest of
    many rows is grown from the distinct ones, without copies (``use_growth``)."""
    with _grouped(train, max_fit_rows) as (source, rows, distinct):
        if use_growth(pipeline.getStages()[-1], rows):
            grown = fit_pipeline_grown(pipeline, source, partitions or training_partitions(distinct))
            if grown is not None:
                return grown
        features, ready = _copied_features(pipeline, source, partitions or training_partitions(rows))
        ready.count()
    try:
        return PipelineModel([*features.stages, pipeline.getStages()[-1].fit(ready)])
    finally:
        ready.unpersist()


def _copied_features(pipeline: Pipeline, counted: DataFrame, partitions: int) -> tuple[PipelineModel, DataFrame]:
    """The fitted stages before the learner, and the cached features and labels of the copies."""
    *before, learner = pipeline.getStages()
    features = Pipeline(stages=before).fit(counted)
    scaled = features.transform(counted).select(*counted.columns, learner.getFeaturesCol())
    ready = placed(scaled, partitions, (learner.getFeaturesCol(),)).select(learner.getFeaturesCol(), learner.getLabelCol())
    return features, ready.persist(StorageLevel.MEMORY_AND_DISK)


def tune(pipeline, grid: list, train: DataFrame, **cv_params):
    """M6 on the prepared training input (see ``training_input``)."""
    from clickpipe.plans.tuning import GROUPED_METRICS, cross_validate

    learners = [pipeline.copy(m).getStages()[-1] for m in grid]
    sums = isinstance(learners[0], GroupedNaiveBayes)  # its sums by number are those of the copies
    counts = cv_params.get("metric", "areaUnderROC") in GROUPED_METRICS and (sums or all(map(takes_counts, learners)))
    with training_input(train, counted_copies=counts) as data:
        if not counts:
            return cross_validate(pipeline, grid, data, owned=True, **cv_params)
        if sums or use_counts(learners[0], data):
            return cross_validate(pipeline, grid, data, counted=True, owned=True, **cv_params)
        with dealt_copies(data) as copies:
            return cross_validate(pipeline, grid, copies, owned=True, **cv_params)


def score(model: PipelineModel, test: DataFrame) -> DataFrame:
    """scored test rows (lazy), with the positive-class probability as ``score``."""
    return probability_score(model.transform(test))


def fit_and_score(learner: Estimator | str, split: Split, **learner_params):
    model = fit_pipeline(learner, split.train, **learner_params)
    return model, score(model, split.test)


def compare_models(split: Split, learners: Mapping[str, Mapping] | None = None) -> DataFrame:
    """One metrics row per learner, unioned by name.

    All learners share one training input and one test half, each made once."""
    learners = learners or {"dt": {}, "gbt": {}, "lr": {}, "rf": {}}
    rows = None
    ensure_checkpoint_dir(split.test.sparkSession)
    test = split.test.checkpoint(eager=True)
    with training_input(split.train, counted_copies=True) as data:
        for name, params in learners.items():
            row = evaluation_row(score(_fit_shared(build_pipeline(make_learner(name, **params)), data), test), name)
            rows = row if rows is None else rows.unionByName(row)
    return rows


def _fit_shared(pipeline: Pipeline, data: DataFrame, partitions: int | None = None) -> PipelineModel:
    """The pipeline's model of counted rows: grown from them, fitted on them, or on copies dealt out for a learner that needs them."""
    learner = pipeline.getStages()[-1]
    if grows(learner) and use_growth(learner, data.agg(F.sum(COPIES)).first()[0] or 0):
        grown = fit_pipeline_grown(pipeline, data)
        if grown is not None:
            return grown
    if use_counts(learner, data):
        return fit_pipeline_counted(pipeline, data)
    if reads_features_only(learner):
        rows = data.agg(F.sum(COPIES)).first()[0] or 0
        features, ready = _copied_features(pipeline, data, partitions or training_partitions(rows))
        try:
            return PipelineModel([*features.stages, learner.fit(ready)])
        finally:
            ready.unpersist()
    with dealt_copies(data, partitions) as copies:
        return pipeline.fit(copies)


def run_sampling_job(spark: SparkSession, inputs: Mapping[str, str], output_dir: str,
                     plan: Mapping[str, float | None], key: str | None = "display_id",
                     seed: int = 123) -> dict[str, str]:
    """Entry 3 (re-aimed from a pandas script): read CSVs, sample, write CSVs.

    ``inputs`` maps table name -> CSV path.  Returns table name -> output dir.
    """
    tables = {name: load_table(spark, name, source="csv", path=path)
              for name, path in inputs.items()}
    sampled = sample_tables(tables, plan, key=key, seed=seed)
    out = {}
    for name, df in sampled.items():
        path = f"{output_dir.rstrip('/')}/{name}"
        write_csv(df, path)
        out[name] = path
    return out


def train_and_evaluate(tables: Mapping[str, DataFrame], learner: str = "lr",
                       join_on: str = "document", split: str = "hash", seed: int = 1234,
                       **learner_params) -> DataFrame:
    """Entry 1 (DT, GBT, RF, LR without tuning): the metrics table of one learner."""
    s = prepare(tables, join_on=join_on, split=split, seed=seed)
    _, pred = fit_and_score(learner, s, **learner_params)
    return metrics_table(pred)


def tune_and_evaluate(tables: Mapping[str, DataFrame], metric: str = "areaUnderROC",
                      num_folds: int = 10, join_on: str = "document", split: str = "hash",
                      seed: int = 1234, parallelism: int = 4) -> DataFrame:
    """Entry 2 (LR): grid x k-fold CV on the training half, best model scored
    on the test half, metrics table returned."""
    from clickpipe.plans.models import logistic_regression
    from clickpipe.plans.tuning import lr_param_grid

    s = prepare(tables, join_on=join_on, split=split, seed=seed)
    lr = logistic_regression()
    model = tune(build_pipeline(lr), lr_param_grid(lr), s.train, num_folds=num_folds,
                 metric=metric, seed=seed, parallelism=parallelism)
    return metrics_table(model.transform(s.test))


def rule_predictions(test: DataFrame, threshold: int = 2) -> DataFrame:
    """A fixed rule in place of a model: predict a click when ``platform <= threshold``.

    Used to check the evaluation code against SQL independently of any learner.
    Score for AUC: ``(5 - platform) + campaign_id / 1000`` (has ties).
    """
    return test.select(
        "*",
        F.when(F.col("platform") <= threshold, 1.0).otherwise(0.0).alias("prediction"),
        ((F.lit(5.0) - F.col("platform")) + F.col("campaign_id") / F.lit(1000.0)).alias("score"),
    )
