"""One policy for invalid rows, from the scan to the fit.

A value is invalid where a needed column is null, or where a text can't be read
as the declared type.  ``error``: the job fails, naming the column; ``skip``: the
row is left out; ``keep``: the value is null.  ``count_invalid`` says how many
rows each column has lost, in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLICIES = ("error", "skip", "keep")


def check_policy(policy: str) -> str:
    if policy not in POLICIES:
        raise ValueError(f"invalid must be one of {', '.join(POLICIES)}, not {policy!r}")
    return policy


def failing(df: DataFrame, bad: Mapping[str, Column]) -> DataFrame:
    """The rows, or a failure that names the column where one of ``bad`` holds.

    The check is a filter, so that no action can do without it: a projection of
    other columns, or a count, fails as well."""
    check = F.lit(True)
    for column, wrong in bad.items():
        error = F.raise_error(F.lit(f"invalid value in column {column}")).cast("boolean")
        check = F.when(F.coalesce(wrong, F.lit(False)), error).otherwise(check)
    return df.filter(check)


def apply_policy(df: DataFrame, columns: Sequence[str], policy: str) -> DataFrame:
    """The policy for nulls in ``columns``."""
    if check_policy(policy) == "skip":
        return df.dropna(subset=list(columns))
    if policy == "keep":
        return df
    return failing(df, {c: F.col(c).isNull() for c in columns})


def count_invalid(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows in all, rows with any null in ``columns``, and nulls by column."""
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(any_null).alias("n_invalid"),
                  *[F.count_if(F.col(c).isNull()).alias(f"invalid_{c}") for c in columns])
