"""Equi-joins whose hot keys are spread over many tasks.

Hot keys are found by a frequent-items sketch: an aggregate of bounded size that is
merged across tasks, and across days if kept (``key_sketch``, ``merge_sketches``).
Only rows of those keys are salted: each row of the big side goes to one of
``salts`` places, the few rows of the other side to all of them.  All other rows are
joined as they are, so bucketed tables keep their join without a shuffle.

The sketch is a hint: the joined rows are the same whichever keys it names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items that a sketch tracks; keys with more than about 1/TRACKED of the rows are never missed.
TRACKED = 10_000
HOT_SHARE = 0.01
ROWS_PER_SALT = 1 << 20
SALTS = 16
MOST_SALTS = 4096
#: Equal rows that travel together.
PIECE = 1024
SALT, ROWS = "_salt", "_rows"


def key_sketch(df: DataFrame, key: str, tracked: int = TRACKED) -> DataFrame:
    """One row: the frequent-items ``sketch`` of a column's values, and ``n_rows``."""
    keys = df.filter(F.col(key).isNotNull())
    return keys.agg(F.call_function("approx_top_k_accumulate", F.col(key), F.lit(tracked)).alias("sketch"), F.count(F.lit(1)).alias("n_rows"))


def merge_sketches(sketches: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """The sketch of all rows that several sketches were made of."""
    return sketches.agg(F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(tracked)).alias("sketch"), F.sum("n_rows").alias("n_rows"))


def hot_keys(sketch: DataFrame, share: float = HOT_SHARE) -> list[tuple]:
    """Keys with at least ``share`` of the rows, with their estimated number; at most 1/share."""
    top = math.ceil(1 / share)
    found = sketch.select(F.explode(F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(top))).alias("x"), "n_rows")
    rows = found.filter(F.col("x.count") >= F.lit(share) * F.col("n_rows")).select("x.item", "x.count").collect()
    return [(r["item"], r["count"]) for r in rows]


def salts_for(hot: list[tuple], rows_per_salt: int = ROWS_PER_SALT) -> int:
    """Places for the largest hot key, so that one holds about ``rows_per_salt`` rows."""
    most = max((n for _, n in hot), default=0)
    return min(MOST_SALTS, max(SALTS, math.ceil(most / rows_per_salt)))


def join_hot(big: DataFrame, small: DataFrame, key: str, hot: list[tuple], salts: int | None = None) -> DataFrame:
    """The inner join of both sides on ``key``: hot keys salted, the rest as it is.

    ``big`` is the side whose hot rows are many; columns are the key, ``big``'s and
    ``small``'s, as in ``big.join(small, key)``."""
    if not hot:
        return big.join(small, key)
    named = F.col(key).isin([k for k, _ in hot])
    n = salts or salts_for(hot)
    cold = big.filter(~named).join(small.filter(~named), key)
    # Equal rows are counted, and the counts cut into pieces, so that they are spread like others; the
    # place follows from content alone, so a task that runs again deals its rows as before.
    counted = big.filter(named).groupBy(*big.columns).agg(F.count(F.lit(1)).alias(ROWS))
    pieces = F.expr(f"transform(sequence(0, ({ROWS} - 1) div {PIECE}), i -> struct(i, least({PIECE}, {ROWS} - i * {PIECE}) AS n))")
    left = counted.withColumn(ROWS, F.explode(pieces))
    place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns], f"{ROWS}.i"), F.lit(n)).cast("int")
    left = left.withColumn(SALT, place).withColumn(ROWS, F.col(f"{ROWS}.n"))
    right = small.filter(named).withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    spread = left.join(right.hint("merge"), [key, SALT])  # cut by (key, salt) on both sides
    spread = spread.withColumn(ROWS, F.explode(F.sequence(F.lit(1).cast("long"), ROWS)))
    return cold.unionByName(spread.select(cold.columns))
