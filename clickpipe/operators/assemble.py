"""Joins and projections that turn the three inputs into the labelled table.

J1  impressions (event) join clicks (train) on ``display_id`` (1:N).
J2  ... join the ad dimension on ``document_id`` (M:N, the original job).
J3  ... join the ad dimension on ``ad_id`` (the ad actually shown).
R1  the duplicate join keys are resolved by projection, not by dropping.
R2/R3  six features (cast to double or as read) plus ``clicked AS label``.
R4  ``label`` renamed to ``trueLabel`` in the test half.
R5  the prediction projection.

Physical plan at scale: J1 joins two fact-sized tables, so it is a
sort-merge join shuffled on ``display_id`` (AQE splits skewed partitions).
Whether the ad dimension is broadcast is left to the planner's size estimate
and to AQE's measured sizes; beyond their threshold it is shuffled on the join
key too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpipe.operators.hot_keys import hot_keys, join_hot, key_sketch
from clickpipe.sources.invalid import apply_policy

# The feature columns, in order, and the label's name.
FEATURES = ["display_id", "document_id", "platform", "ad_id", "campaign_id", "advertiser_id"]
LABEL = "label"
TRUE_LABEL = "trueLabel"


def _join(big: DataFrame, small: DataFrame, key: str, hot_share: float | None) -> DataFrame:
    if hot_share is None:
        return big.join(small, key, "inner")
    return join_hot(big, small, key, hot_keys(key_sketch(big, key), hot_share))


def join_impressions_clicks(event: DataFrame, train: DataFrame,
                            keep_ad: bool = False, hot_share: float | None = None) -> DataFrame:
    """``event`` join ``train`` on display_id.

    The original job drops ``train.ad_id`` here (``keep_ad=False``); the
    corrected variant keeps it so the shown ad can be joined (J3).  With
    ``hot_share`` the displays that hold such a share of the clicks are salted
    (``operators.hot_keys``; one job finds them).
    """
    clicks = train.select("display_id", "clicked", *(["ad_id"] if keep_ad else []))
    columns = [*event.columns, *[c for c in clicks.columns if c != "display_id"]]
    if hot_share is None:
        return event.join(clicks, "display_id", "inner")
    return _join(clicks, event, "display_id", hot_share).select(columns)


def join_ads_by_document(data1: DataFrame, promoted_content: DataFrame,
                         hot_share: float | None = None) -> DataFrame:
    """Attach every ad whose landing document is the page's document.

    This reproduces the original job: each click label is copied onto all
    ads of the page's document (fan-out = ads per document).  ``hot_share`` as in J1.
    """
    ads = promoted_content.select("ad_id", "document_id", "campaign_id", "advertiser_id")
    return _join(data1, ads, "document_id", hot_share)


def join_ads_by_ad(data1: DataFrame, promoted_content: DataFrame,
                   hot_share: float | None = None) -> DataFrame:
    """Attach the attributes of the ad that was shown (no fan-out).

    ``data1`` must come from ``join_impressions_clicks(..., keep_ad=True)``.
    ``document_id`` stays the page's document.
    """
    ads = promoted_content.select("ad_id", "campaign_id", "advertiser_id")
    return _join(data1, ads, "ad_id", hot_share)


def feature_table(joined: DataFrame, cast: bool = True,
                  features: Sequence[str] = FEATURES) -> DataFrame:
    """R2 (``cast=True``) / R3 (``cast=False``): features plus ``clicked AS label``."""
    cols = [F.col(c).try_cast("double").alias(c) if cast else F.col(c) for c in features]
    return joined.select(*cols, F.col("clicked").alias(LABEL))


def labelled_data(event: DataFrame, train: DataFrame, promoted_content: DataFrame,
                  join_on: str = "document", cast: bool = True,
                  invalid: str = "keep", hot_share: float | None = None) -> DataFrame:
    """J1 + J2/J3 + R2/R3: the labelled feature table ``data``.

    ``invalid`` says what becomes of rows with a null feature or label
    (``error``, ``skip`` or ``keep``, see ``sources.invalid``); ``hot_share`` salts
    the join keys that hold such a share of the rows."""
    if join_on == "document":
        clicks = join_impressions_clicks(event, train, hot_share=hot_share)
        joined = join_ads_by_document(clicks, promoted_content, hot_share)
    elif join_on == "ad":
        clicks = join_impressions_clicks(event, train, keep_ad=True, hot_share=hot_share)
        joined = join_ads_by_ad(clicks, promoted_content, hot_share)
    else:
        raise ValueError(f"join_on must be 'document' or 'ad', not {join_on!r}")
    return apply_policy(feature_table(joined, cast=cast), [*FEATURES, LABEL], invalid)


def as_test(df: DataFrame) -> DataFrame:
    """The test half carries its label as ``trueLabel``."""
    return df.withColumnRenamed(LABEL, TRUE_LABEL)


def prediction_rows(predictions: DataFrame, keys: Sequence[str] = ("display_id", "ad_id"),
                    features: Sequence[str] = FEATURES, as_columns: bool = True) -> DataFrame:
    """``features, prediction, trueLabel`` plus the row keys.

    The feature vector is returned as one ``s_<feature>`` double column per
    input feature (``as_columns=True``) or as one ``array<double>``, so the
    rows can be compared and written by any engine.
    """
    from pyspark.ml.functions import vector_to_array

    vec = vector_to_array("features")
    if as_columns:
        cols = [vec[i].alias(f"s_{c}") for i, c in enumerate(features)]
    else:
        cols = [vec.alias("features")]
    return predictions.select(*keys, *cols, "prediction", TRUE_LABEL)
