"""Distributed union-find over an edge table.

Alternating star contraction: a large star points every larger neighbour of a
node at the smallest node of its neighbourhood, a small star does so for the
smaller ones; the edges end as one star per component, around its smallest
node, after about log n rounds.  Every round is an aggregation (combined on the
map side) and a join on node ids (hot ones are split by the engine's skew
join); its edges are written to the shared folder.  The driver sees two numbers
a round.  DataFrame functions only.

Defined cases: edges of a node to itself, repeated edges and edges with a null
end are left out; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpipe.llm.common import discard, saved


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node
    that isn't a root itself."""
    now = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now = saved(now, "components")
    state = _state(now)
    while state[0]:
        old, now = now, saved(_small_star(_large_star(now)), "components")
        discard(old)
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
