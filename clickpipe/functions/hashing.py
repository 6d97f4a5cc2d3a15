"""Deterministic hash columns used for splits, folds and samples.

All of them are built from ``md5`` so that another SQL engine can recompute
the same value: take the first 8 hex digits of ``md5(salt || key)`` as an
unsigned 32-bit integer.  (``hash``/``xxhash64`` are Spark-specific.)
Unlike ``rand()`` the value depends only on the key, so a recomputed
partition after an executor loss gives the same rows, and every row of one
key lands on the same side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

HASH_SPACE = 1 << 32
# What a null key is hashed as, so that every row has a bucket.
NULL_TOKEN = "\x01null"


def _key_string(*cols: str | Column) -> Column:
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    parts = [F.coalesce(p.cast("string"), F.lit(NULL_TOKEN)) for p in parts]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def seed_salt(seed: int, default: int) -> str:
    """The salt of a seed; the default seed has none."""
    return "" if seed == default else f"{seed}:"


def hash32(*cols: str | Column, salt: str = "") -> Column:
    """Unsigned 32-bit value of ``md5(salt || key)`` (first 8 hex digits)."""
    key = _key_string(*cols)
    if salt:
        key = F.concat(F.lit(salt), key)
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def hash_bucket(*cols: str | Column, buckets: int, salt: str = "") -> Column:
    """``hash32(key) mod buckets``."""
    return F.pmod(hash32(*cols, salt=salt), F.lit(buckets))


def key_column(df: DataFrame, key: str) -> Column:
    """The key as hashed: fractional columns holding ids (features are cast
    to double) are hashed as ``bigint`` so that ``11426.0`` and ``11426`` agree."""
    dtype = df.schema[key].dataType
    if isinstance(dtype, (DoubleType, FloatType, DecimalType)):
        return F.col(key).cast("bigint")
    return F.col(key)
