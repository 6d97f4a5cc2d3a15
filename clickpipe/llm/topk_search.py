"""Exact top-k inner-product search by Fagin's threshold algorithm.

Vectors and queries are dealt into blocks of about ``BLOCK_VECTORS`` and
``BLOCK_QUERIES`` rows by a hash of their id; every pair of a query block and a
vector block is one group.  In a group each dimension has its list of vectors
sorted by component.  For a query the lists are read in step, from the top
where the query's component is positive and from the bottom where it is
negative; every vector met is scored at once from its stored row.  After a
step no vector that hasn't been met can score more than the sum of query
component times the list's present component, so reading stops when that bound
is below the kth best score (at equality it goes on, as a smaller id may win a
tie).  Steps grow geometrically and are done on arrays.

The best k of each block go to one ranking per query: k rows for each vector
block.  Scores are exact integers.

Defined cases: vectors that are null or hold null, NaN or infinite components,
and rows with a null id, take no part; rows that repeat in full count once, and
rows with the query's id aren't its candidates; vectors of different length are
compared over the dimensions that both have; fewer than k candidates give fewer
rows; ties go to the smaller id; an empty table gives no rows.  Sums are
taken in doubles, in 64-bit integers or in Python integers, whichever holds them
exactly; beyond 64 bits the score is a decimal(38, 0).  Refused are components
beyond 64 bits and sums that may pass 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpipe.llm.common import read_table, workers_import

BLOCK_VECTORS = 8192
BLOCK_QUERIES = 1024
FIRST_STEP = 16


def integer_components(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component, with x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)))


def usable(vector: Column) -> Column:
    """Not null and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


class SortedLists:
    """The vectors of a block (in id order) and, per dimension, their order by component."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable")  # ascending; column d is the list of dimension d
        self.sorted = np.take_along_axis(rows, self.order, axis=0)

    def search(self, query: np.ndarray, k: int, banned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best rows outside ``banned``: score descending, position ascending."""
        n = len(self.rows)
        dims = np.flatnonzero(query)
        weight = query[dims]
        up = weight > 0
        met = np.zeros(n, bool)
        met[banned] = True
        places, scores = np.empty(0, np.int64), np.empty(0, self.rows.dtype)
        depth, step = 0, max(FIRST_STEP, k)
        while depth < n:
            to = min(n, depth + step)
            seen = met.copy()
            if len(dims):
                seen[self.order[n - to:n - depth, dims[up]]] = True
                seen[self.order[depth:to, dims[~up]]] = True
            else:  # every score is 0: the smallest ids win
                seen[:] = True
            new = np.flatnonzero(seen & ~met)
            met = seen
            if len(new):
                places = np.concatenate([places, new])
                scores = np.concatenate([scores, self.rows[new] @ query])
                if scores.dtype == object:
                    best = np.array(sorted(range(len(places)), key=lambda i: (-scores[i], places[i]))[:k])
                else:
                    best = np.lexsort((places, -scores))[:k]
                places, scores = places[best], scores[best]
            bound = (weight * np.where(up, self.sorted[n - to, dims], self.sorted[to - 1, dims])).sum() if len(dims) else -np.inf
            if len(places) == k and bound < scores[-1] or met.all():
                break
            depth, step = to, step * 2
        return places, scores


def _matrix(lists: list[np.ndarray], width: int, dtype: type = float) -> np.ndarray:
    out = np.zeros((len(lists), width), dtype)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def search(vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "_v") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k best.

    ``vectors`` has ``vec_id`` and an array of integers in ``vector``;
    ``queries`` is the condition that picks the query rows.
    """
    spark = vectors.sparkSession
    workers_import(spark)
    rows = vectors.select(F.col(vec_id).cast("long").alias("_i"), F.col(vector).alias("_v"), F.coalesce(queries, F.lit(False)).alias("_q"))
    rows = rows.filter(F.col("_i").isNotNull()).dropDuplicates(["_i", "_v"])
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_q").cast("int")).alias("q"),
                 F.max(F.size("_v")).alias("d"), F.max(F.array_max("_v")).alias("most"), F.min(F.array_min("_v")).alias("least")).first()
    big = max(n["most"] or 0, -(n["least"] or 0))
    sums = (n["d"] or 0) * big ** 2
    if big >= (1 << 63) - 1 or sums >= 10 ** 38:
        raise ValueError("components beyond 64 bits, or sums beyond 38 digits")
    dtype = float if sums <= 1 << 53 else np.int64 if sums < 1 << 63 else object
    number = "decimal(38,0)" if dtype is object else "long"
    whole = (lambda x: [Decimal(int(s)) for s in x]) if dtype is object else (lambda x: x.astype(np.int64))
    v_blocks, q_blocks = -(-max(n["n"], 1) // BLOCK_VECTORS), -(-max(n["q"] or 0, 1) // BLOCK_QUERIES)
    block = lambda m, salt: F.pmod(F.xxhash64("_i", F.lit(salt)), F.lit(m)).cast("int")
    all_of = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    stored = rows.select("_i", "_v", block(v_blocks, 1).alias("_vb"), all_of(q_blocks).alias("_qb"))
    asked = rows.filter("_q").select("_i", "_v", block(q_blocks, 2).alias("_qb")).select("*", all_of(v_blocks).alias("_vb"))

    def block_search(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(stored):
            stored = stored.sort_values("_i", kind="stable")
            ids = stored["_i"].to_numpy()
            width = max(max(map(len, stored["_v"])), max(map(len, asked["_v"])))
            lists = SortedLists(_matrix(list(stored["_v"]), width, dtype))
            for query_id, query in zip(asked["_i"], _matrix(list(asked["_v"]), width, dtype), strict=True):
                lo, hi = np.searchsorted(ids, [query_id, query_id + 1])
                places, scores = lists.search(query, k, np.arange(lo, hi))
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[places], "score": whole(scores)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    found = (asked.groupBy("_qb", "_vb").cogroup(stored.groupBy("_qb", "_vb"))
             .applyInPandas(block_search, f"query_id long, vec_id long, score {number}"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_topk_search(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest rows of ``embeddings`` by integer inner product, for every id divisible by 50."""
    rows = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    rows = rows.filter(usable(F.col("embedding"))).select("vec_id", integer_components(F.col("embedding")).alias("_v"))
    return search(rows, F.col("vec_id") % 50 == 0)


ORACLE_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
     p AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(v.e AS DOUBLE[])) AS BIGINT) AS score
           FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
     r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
