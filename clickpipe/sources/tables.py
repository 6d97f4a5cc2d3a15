"""Table sources and sinks.

* CSV scans read every field as a string by header name and convert with
  ``try_cast`` to the declared schema.  That avoids the extra full pass that
  ``inferSchema`` costs and maps columns by name (so a leading pandas index
  column ``_c0`` is simply not selected).  Each given path is read by its own
  header; files under one path must share theirs, or the scan fails.
* Values that the declared type can't hold follow one policy (``invalid``).
* Catalog scans go through ``spark.table``; Catalyst prunes columns and pushes
  filters into the underlying scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clickpipe.sources.inference import infer_types, with_types
from clickpipe.sources.invalid import apply_policy, check_policy, failing
from clickpipe.sources.schemas import SCHEMAS

PANDAS_INDEX_COLUMN = "_c0"


def conform(df: DataFrame, schema: StructType, invalid: str = "keep") -> DataFrame:
    """Select the schema's columns by name, converting each with ``try_cast``.

    ``invalid`` is the policy for malformed values and for nulls in columns that
    the schema declares as not null."""
    check_policy(invalid)
    out = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    if invalid == "error":
        bad = {}
        for f in schema.fields:
            empty = F.col(f.name).try_cast(f.dataType).isNull()
            bad[f.name] = empty if not f.nullable else empty & F.col(f.name).isNotNull()
        return failing(df, bad).select(out)
    if invalid == "skip":
        malformed = [F.col(f.name).try_cast(f.dataType).isNull() & F.col(f.name).isNotNull() for f in schema.fields]
        df = df.filter(~reduce(lambda a, b: a | b, malformed))
        return apply_policy(df.select(out), [f.name for f in schema.fields if not f.nullable], invalid)
    return df.select(out)


def _read_strings(spark: SparkSession, path: str) -> DataFrame:
    """One path with every field as text, by its own header; files with another header fail the scan."""
    names = spark.read.option("header", True).csv(path).columns
    schema = StructType([StructField(n, StringType()) for n in names])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_csv(spark: SparkSession, path: str | Sequence[str],
             schema: StructType | None = None, infer_schema: bool = False,
             invalid: str = "keep") -> DataFrame:
    """CSV scan with a header row.

    ``path`` is one path or several; several are read each by its own header and
    united by column name.  With ``schema`` the columns are matched by name and
    converted (see ``conform``); with ``infer_schema=True`` one more pass over all
    paths together finds the types (``sources.inference``), so paths that disagree
    get their common type; a column that a path lacks is null there.  A pandas
    index column is dropped.
    """
    inferred = schema is None and infer_schema

    def one(p: str) -> DataFrame:
        df = _read_strings(spark, p)
        return df.drop(PANDAS_INDEX_COLUMN) if PANDAS_INDEX_COLUMN in df.columns else df

    parts = [one(p) for p in ([path] if isinstance(path, str) else path)]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=inferred), parts)
    if inferred:
        return with_types(df, infer_types(df))
    return df if schema is None else conform(df, schema, invalid)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    """Catalog / temp-view scan."""
    return spark.table(name)


def load_table(spark: SparkSession, name: str, source: str = "catalog",
               path: str | Sequence[str] | None = None, table: str | None = None,
               schema: StructType | None = None, invalid: str = "keep",
               infer_schema: bool = False) -> DataFrame:
    """S3: load one of the three inputs from CSV, parquet or the catalog.

    ``name`` is the logical table (``event``, ``train``, ``promoted_content``)
    and selects the declared schema; ``table``/``path`` say where it lives;
    ``invalid`` is the policy for malformed or missing values.  ``infer_schema``
    (CSV only) takes the types from the files in place of the declared schema.
    """
    schema = schema or SCHEMAS.get(name)
    if source == "csv":
        if path is None:
            raise ValueError("csv source needs a path")
        if infer_schema:
            return read_csv(spark, path, infer_schema=True)
        return read_csv(spark, path, schema=schema, invalid=invalid)
    if source == "parquet":
        if path is None:
            raise ValueError("parquet source needs a path")
        df = spark.read.parquet(path)
    elif source == "catalog":
        df = read_catalog(spark, table or name)
    else:
        raise ValueError(f"unknown source {source!r}")
    return conform(df, schema, invalid) if schema is not None else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header and no index column; one file per task."""
    df.write.mode(mode).option("header", True).csv(path)


def save_bucketed(df: DataFrame, table: str, key: str = "display_id", buckets: int = 64,
                  mode: str = "overwrite") -> None:
    """Catalog sink bucketed and sorted by the join key.

    When the impression and click tables are both saved with the same
    ``key`` and ``buckets``, the display join (J1) reads matching buckets
    side by side: a sort-merge join with no shuffle of either table.
    Pick ``buckets`` so one bucket file is a few hundred MB, and don't bucket by a
    key that a large part of the rows shares: a bucket is one task, and the skew
    join that splits hot keys works on shuffled joins only.
    """
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows; deterministic when ``order_by`` is given."""
    if order_by:
        return df.orderBy(*order_by).limit(n)
    return df.limit(n)


def show_rows(df: DataFrame, n: int = 100,
              order_by: Sequence[str] = ("display_id", "ad_id")) -> DataFrame:
    """The ``n`` rows a ``show(n)`` would print, as a DataFrame.

    ``orderBy(...).limit(n)`` plans as a per-partition top-n plus a merge of
    ``n * partitions`` rows, so it stays cheap on any input size.
    """
    return df.orderBy(*order_by).limit(n)
