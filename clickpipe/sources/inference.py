"""Types of text columns, inferred from all their values at once.

The types form a chain, null < int < long < double < string: the type of two sets
of values is the larger of theirs, so what each task finds can be merged in any
order.  One aggregate over every path gives a number per column; no value and no
row reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, LongType, StringType

#: The chain above null; a column without any value is text.
LATTICE: tuple[DataType, ...] = (IntegerType(), LongType(), DoubleType(), StringType())

_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def type_rank(value: Column) -> Column:
    """0 for null, else the place of the value's type in ``LATTICE``, from 1."""
    whole = F.when(value.rlike(_WHOLE), F.trim(value))
    return (F.when(value.isNull(), 0)
            .when(whole.try_cast("int").isNotNull(), 1)
            .when(whole.try_cast("bigint").isNotNull(), 2)
            .when(value.rlike(_NUMBER), 3)
            .otherwise(4))


def infer_types(df: DataFrame) -> dict[str, DataType]:
    """The common type of each text column, from one aggregate."""
    if not df.columns:
        return {}
    ranks = [F.max(type_rank(F.col(f"`{c}`"))).alias(f"_{i}") for i, c in enumerate(df.columns)]
    row = df.agg(*ranks).first()
    return {c: LATTICE[(row[i] or len(LATTICE)) - 1] for i, c in enumerate(df.columns)}


def with_types(df: DataFrame, types: dict[str, DataType]) -> DataFrame:
    """The columns of ``types`` converted from text."""
    text = {c: F.col(f"`{c}`") for c in df.columns}
    number = {c: F.trim(x).try_cast(types[c]) for c, x in text.items() if c in types and types[c] != StringType()}
    return df.select([number.get(c, x).alias(c) for c, x in text.items()])
