"""Helpers shared by the operators."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpipe.session import ensure_checkpoint_dir

ROOT = str(Path(__file__).resolve().parents[2])

#: A row's key where ``doc_id`` is null.
NO_ID = -(1 << 63)


def workers_import(spark: SparkSession) -> None:
    """Lets Python workers import this package when it runs from a source folder
    (an installed or shipped package is found without it)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), ROOT) if x)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared checkpoint folder and reads it back: a lost
    executor then never leads further back than to these files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``saved`` wrote.  Only once all that was made of them is written
    too: nothing can be made of them again."""
    for df in tables:
        files = df.inputFiles()
        if files:
            folders = {f.rsplit("/", 1)[0] for f in files}
            sc = df.sparkSession.sparkContext
            for folder in folders:
                path = sc._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def tucked(df: DataFrame, *more: Column) -> DataFrame:
    """All columns under names that no operator uses (``_c0``, ``_c1`` ...), and ``more``."""
    return df.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(df.columns)], *more)


def untucked(names: list[str], changed: dict[str, Column] | None = None) -> list[Column]:
    """The columns of ``tucked`` under their own names, some of them changed."""
    changed = changed or {}
    return [changed.get(c, F.col(f"_c{i}")).alias(c) for i, c in enumerate(names)]


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))
