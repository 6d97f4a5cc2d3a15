"""Sampling and splitting.

P1  ``bernoulli_sample``: Spark's seeded sample without replacement
    (row count is Binomial, not exact).
    ``exact_n_sample``: exactly ``round(fraction * n)`` rows, as a pandas
    ``df.sample(frac=...)`` gives; the rows with the smallest reproducible
    hash of their key are kept.
P2  ``key_sample``: keep the keys whose hash falls below the fraction, so two
    tables sampled on the same key keep the same keys (sampling event and
    train independently would keep only about the product of the fractions
    after the join); ``sample_tables`` applies a per-table plan.
P3  ``random_split``: ``randomSplit`` on a lineage-cut input (its draw
    depends on row order, so recomputation must not reorder rows);
    ``hash_split``: reproducible split by key (all rows of a display on the
    same side, identical after any recomputation).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpipe.functions.hashing import HASH_SPACE, hash32, hash_bucket, key_column, seed_salt

# Fixed values from the original sampling plan: fraction kept per table
# (None = keep the table whole).
SAMPLE_PLAN_LARGE = {"train": 0.12, "event": 0.09, "promoted_content": None}
SAMPLE_PLAN_SMALL = {"train": 0.06, "event": 0.04, "promoted_content": 0.2}

DEFAULT_SEED = 123
SPLIT_BUCKETS = 10
DEFAULT_TRAIN_BUCKETS = 7  # 70 / 30


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 123) -> DataFrame:
    """Seeded Bernoulli sample without replacement (no shuffle)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def key_sample(df: DataFrame, fraction: float, key: str | Sequence[str] = "display_id",
               salt: str = "") -> DataFrame:
    """Keep rows whose key hash is below ``fraction`` (a filter, no shuffle)."""
    keys = [key_column(df, k) for k in ([key] if isinstance(key, str) else key)]
    return df.filter(hash32(*keys, salt=salt) < F.lit(int(round(fraction * HASH_SPACE))))


def sample_tables(tables: Mapping[str, DataFrame], plan: Mapping[str, float | None],
                  key: str | Mapping[str, str | None] | None = "display_id",
                  seed: int = 123) -> dict[str, DataFrame]:
    """Apply a per-table fraction plan.

    ``key`` is one key column for every table, or a per-table mapping
    (e.g. displays for event/train and ``ad_id`` for the ad table).  A table
    with its key column is sampled on the key hash (the same keys survive in
    every table sampled on that key); a table without one is Bernoulli-sampled.
    ``seed`` salts the key hash, too.
    """
    out = {}
    for name, df in tables.items():
        fraction = plan.get(name)
        table_key = key.get(name) if isinstance(key, Mapping) else key
        if fraction is None or fraction >= 1.0:
            out[name] = df
        elif table_key is not None and table_key in df.columns:
            out[name] = key_sample(df, fraction, table_key, seed_salt(seed, DEFAULT_SEED))
        else:
            out[name] = bernoulli_sample(df, fraction, seed)
    return out


def exact_n_sample(df: DataFrame, fraction: float, order_cols: Sequence[str] | None = None,
                   seed: int = 123, target_bucket_rows: int = 1 << 17) -> DataFrame:
    """P1 (exact): the ``round(fraction * n)`` rows first in ``(h, order_cols)``.

    ``h = hash32(seed || order_cols)``, with nulls hashed like any value.
    Distributed selection, no global sort and no task that holds more than one
    bucket:

    1. rows are bucketed by the top bits of ``h``; a histogram of bucket
       counts (one row per ``target_bucket_rows`` rows) gives the bucket
       holding the k-th row.  Buckets before it are kept by a filter.
    2. inside that bucket, rows are grouped by order key first (a key held by
       a third of all rows is one row here) and the keys are ranked, which
       gives each key how many of its rows to keep.
    3. the one key that is cut part-way has its rows chosen in the same way by
       all columns; rows equal in all columns are made from their values.

    ``order_cols`` defaults to all columns.
    """
    n = df.count()
    return _first_rows(df, int(round(fraction * n)), n, list(order_cols or df.columns), seed,
                       target_bucket_rows)


def _first_rows(df: DataFrame, k: int, n: int, order_cols: list[str], seed: int,
                target_bucket_rows: int) -> DataFrame:
    if k <= 0:
        return df.limit(0)
    if k >= n:
        return df
    bits = min(32, max(0, math.ceil(math.log2(max(1.0, n / target_bucket_rows)))))
    keyed = (df.withColumn("_h", hash32(*order_cols, salt=f"{seed}:"))
               .withColumn("_b", F.shiftright("_h", 32 - bits)))
    hist = keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    cum = hist.withColumn("_cum", F.sum("_n").over(Window.orderBy("_b")))
    edge = cum.filter(F.col("_cum") >= k).orderBy("_b").select("_b", "_cum", "_n").first()
    b_star, need = edge["_b"], k - (edge["_cum"] - edge["_n"])
    whole = keyed.filter(F.col("_b") < b_star).drop("_h", "_b")

    # 2. per-key quotas inside the boundary bucket
    key_cols = ["_h"] + order_cols
    boundary = keyed.filter(F.col("_b") == b_star).drop("_b")
    before = Window.orderBy(*key_cols).rowsBetween(Window.unboundedPreceding, -1)
    quota = (boundary.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_m"))
             .withColumn("_q", F.least(F.col("_m"), F.greatest(
                 F.lit(0), F.lit(need) - F.coalesce(F.sum("_m").over(before), F.lit(0)))))
             .filter(F.col("_q") > 0))
    full = quota.filter(F.col("_q") == F.col("_m")).select(*[F.col(c).alias(f"_k_{c}") for c in key_cols])
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in key_cols]
    taken = whole.unionByName(boundary.join(full, _all(same), "left_semi").drop("_h"))
    cut = quota.filter(F.col("_q") < F.col("_m")).first()
    if cut is None:
        return taken
    # 3. the cut key
    rows = boundary.filter(_all([F.col(c).eqNullSafe(F.lit(cut[c])) for c in key_cols])).drop("_h")
    if set(order_cols) == set(df.columns):
        values = [F.lit(cut[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields]
        part = df.sparkSession.range(cut["_q"]).select(*values)
    else:
        part = _first_rows(rows, cut["_q"], cut["_m"], df.columns, seed, target_bucket_rows)
    return taken.unionByName(part)


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def hash_split(df: DataFrame, key: str = "display_id", train_buckets: int = DEFAULT_TRAIN_BUCKETS,
               buckets: int = SPLIT_BUCKETS, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """P3 (reproducible): bucket = ``hash32(key) mod buckets``; ``< train_buckets`` trains.

    A null key has a bucket too, so the halves sum to the input."""
    b = hash_bucket(key_column(df, key), buckets=buckets, salt=salt)
    return df.filter(b < train_buckets), df.filter(b >= train_buckets)


def random_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 1234,
                 cut_lineage: bool = True) -> list[DataFrame]:
    """``randomSplit`` with a required seed.

    ``randomSplit`` draws per row in partition order; if the input is
    recomputed in another order (a shuffle after an executor loss) the
    halves can overlap.  ``cut_lineage`` checkpoints the input first into the
    session's checkpoint folder.
    """
    if cut_lineage:
        from clickpipe.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    return df.randomSplit(list(weights), seed=seed)

