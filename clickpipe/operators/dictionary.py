"""Dictionary encoding of text columns, with the dictionary as a table.

``build_dictionary`` numbers the distinct values of a column from 0 by falling
frequency (or by value), ties by value.  Values are counted on the map side, sorted
by range over tasks, and numbered within each task after the sizes of the tasks
before it: nothing but a size per task is gathered.  ``encode`` joins the table; how
is the planner's choice by its size, so a dictionary of any size will do.

Nulls and values that the dictionary lacks follow one policy: ``error`` fails,
``skip`` drops the row, ``keep`` gives them the first unused index.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpipe.session import ensure_checkpoint_dir
from clickpipe.sources.invalid import check_policy, failing

ORDERS = {
    "frequencyDesc": (F.desc, "n"),
    "frequencyAsc": (F.asc, "n"),
    "alphabetAsc": (F.asc, None),
    "alphabetDesc": (F.desc, None),
}
_TASK_BITS = 33  # of monotonically_increasing_id: the row's place within its task


def build_dictionary(df: DataFrame, column: str, order: str = "frequencyDesc") -> DataFrame:
    """``value``, ``index`` (long, from 0) and ``n`` (rows) of each distinct value."""
    if order not in ORDERS:
        raise ValueError(f"order must be one of {', '.join(ORDERS)}, not {order!r}")
    ensure_checkpoint_dir(df.sparkSession)
    counts = (df.select(F.col(f"`{column}`").cast("string").alias("value")).filter("value IS NOT NULL")
              .groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    way, by = ORDERS[order]
    # Spark's own indexer breaks ties of frequency by ascending value.
    sort = [way(by), F.asc("value")] if by else [way("value")]
    place = F.monotonically_increasing_id()
    ranged = counts.repartitionByRange(*sort).sortWithinPartitions(*sort).select("value", "n", place.alias("_place")).checkpoint(eager=True)
    task = F.shiftright("_place", _TASK_BITS)
    sizes = ranged.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    starts = sizes.select("_task", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.col("_place") - F.shiftleft(task, _TASK_BITS)
    return ranged.withColumn("_task", task).join(starts, "_task").select("value", (F.col("_start") + within).alias("index"), "n")


def encode(df: DataFrame, dictionaries: Mapping[str, DataFrame], invalid: str = "error", suffix: str = "_index") -> DataFrame:
    """The rows with ``<column><suffix>`` (long) for each column of ``dictionaries``."""
    check_policy(invalid)
    out, bad = df, {}
    for i, (column, dictionary) in enumerate(dictionaries.items()):
        index = f"{column}{suffix}"
        table = dictionary.select(F.col("value").alias(f"_v{i}"), F.col("index").alias(index))
        out = out.join(table, F.col(f"`{column}`").cast("string") == F.col(f"_v{i}"), "left").drop(f"_v{i}")
        bad[column] = F.col(f"`{index}`").isNull()
        if invalid == "keep":
            unused = dictionary.agg((F.coalesce(F.max("index"), F.lit(-1)) + 1).alias(f"_unused{i}"))
            out = out.crossJoin(F.broadcast(unused)).withColumn(index, F.coalesce(F.col(f"`{index}`"), f"_unused{i}")).drop(f"_unused{i}")
    if invalid == "skip":
        return out.dropna(subset=[f"{c}{suffix}" for c in dictionaries])
    return failing(out, bad) if invalid == "error" else out


def decode(df: DataFrame, dictionaries: Mapping[str, DataFrame], suffix: str = "_index") -> DataFrame:
    """The values of the index columns, as ``<column>_value`` (null where the index is unused)."""
    out = df
    for i, (column, dictionary) in enumerate(dictionaries.items()):
        table = dictionary.select(F.col("index").alias(f"_i{i}"), F.col("value").alias(f"{column}_value"))
        out = out.join(table, F.col(f"`{column}{suffix}`") == F.col(f"_i{i}"), "left").drop(f"_i{i}")
    return out
