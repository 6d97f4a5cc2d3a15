"""The three job inputs as views over the driver's TPC-H-style tables.

The original job reads impression (``event``), click (``train``) and ad
dimension (``promoted_content``) tables.  The test data has none of those,
so they are derived, with the same shape, from ``orders``, ``lineitem`` and
``part``:

* event: one impression per order; the page document is ``o_custkey div 3``.
* train: one shown ad per line item; ``clicked`` carries signal through the
  order priority (the platform) so the learners have something to learn.
* promoted_content: one ad per part; four ads share each landing document.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, table: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet")).select(*columns)


def _platform(priority_col: str) -> F.Column:
    return F.substring(F.col(priority_col), 1, 1).cast("int")


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"])
    return orders.select(
        F.col("o_orderkey").alias("display_id"),
        F.col("o_custkey").cast("string").alias("uuid"),
        F.expr("o_custkey div 3").alias("document_id"),
        # o_orderdate is a zone-less timestamp, so this is time-zone independent.
        F.unix_timestamp("o_orderdate").alias("timestamp"),
        _platform("o_orderpriority").alias("platform"),
        F.col("o_orderstatus").alias("geo_location"),
    )


def train_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _read(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_returnflag"])
    orders = _read(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority"])
    high = F.substring("o_orderpriority", 1, 1).isin("1", "2")
    clicked = F.when(high, F.col("l_returnflag") != "A").otherwise(F.col("l_returnflag") == "R")
    return (lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
            .select(F.col("l_orderkey").alias("display_id"),
                    F.col("l_partkey").alias("ad_id"),
                    clicked.cast("int").alias("clicked")))


def promoted_content_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_size"])
    return part.select(
        F.col("p_partkey").alias("ad_id"),
        F.expr("p_partkey div 4").alias("document_id"),
        F.substring("p_brand", 7, 8).cast("int").alias("campaign_id"),
        F.col("p_size").alias("advertiser_id"),
    )


def fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "event": event_table(spark, sf_dir),
        "train": train_table(spark, sf_dir),
        "promoted_content": promoted_content_table(spark, sf_dir),
    }


def register_fixture_views(spark: SparkSession, sf_dir: str,
                           suffix: str = "") -> dict[str, str]:
    """Register the three inputs as temp views (catalog source, S2).

    Returns ``{logical name: view name}``.
    """
    names = {}
    for name, df in fixture_tables(spark, sf_dir).items():
        view = f"{name}{suffix}"
        df.createOrReplaceTempView(view)
        names[name] = view
    return names


# DuckDB form of the same three inputs, as CTEs for the oracle queries.
DUCKDB_FIXTURE_CTES = """
event AS (
  SELECT o_orderkey AS display_id, CAST(o_custkey AS VARCHAR) AS uuid,
         o_custkey // 3 AS document_id,
         CAST(floor(epoch(o_orderdate)) AS BIGINT) AS "timestamp",
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS platform,
         o_orderstatus AS geo_location
  FROM orders),
train AS (
  SELECT l_orderkey AS display_id, l_partkey AS ad_id,
         CAST(CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2')
                   THEN l_returnflag <> 'A' ELSE l_returnflag = 'R' END AS INTEGER) AS clicked
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
promoted_content AS (
  SELECT p_partkey AS ad_id, p_partkey // 4 AS document_id,
         CAST(substr(p_brand, 7) AS INTEGER) AS campaign_id, p_size AS advertiser_id
  FROM part)
"""
