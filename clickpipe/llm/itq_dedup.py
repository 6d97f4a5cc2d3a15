"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables.

1. Fit: on a bounded sample (``SAMPLE_ROWS``, the smallest hashes of the id)
   unit vectors are centred and rotated to their principal axes; iterative
   quantisation then learns rotations that bring them near balanced binary
   codes, several of them from different starts.
2. Index: every vector is encoded by every rotation; each code is cut into
   substrings of ``bits`` bits, and each substring is a table.  The number of
   tables follows from the chance that two vectors at the threshold differ in
   a bit (angle / pi, measured after centring on pairs made from the sample), so
   that at most ``MISS`` of the pairs there share no entry; ``bits`` follows the
   number of rows, and is less where more than ``MOST_TABLES`` would be needed.
3. Retrieve and rerank: rows of one label that share a table entry are compared
   with their original vectors, in double precision.  A pair is counted in the
   first table where it meets and nowhere else, so counts are sums over entries
   and no pair is written out; links leave an entry as one parent per row (a
   union-find inside it).  Entries with more than ``ENTRY_ROWS`` rows are dealt
   into blocks, and pairs of blocks become groups of their own.
4. Components of the parents by ``components``.

Vectors of one label that are equal in every component are one row with a
count until the end, so a hot group of copies isn't compared with itself.

Defined cases: vectors that are null, zero or hold null, NaN or infinite
components, rows with a null label and rows with a null id link with nothing
(0 links, own component; a null id has a null component and isn't kept); rows
that share an id are one vector, the smallest (label, vector) if they differ,
and each of them is returned; vectors of different length are compared as if
the shorter ended in zeros; labels of any simple type are compared as they are
written; very long vectors are compared whole; extra columns aren't returned; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpipe.llm.common import read_table, saved, workers_import
from clickpipe.llm.components import components
from clickpipe.llm.topk_search import usable

THRESHOLD = 0.98
SAMPLE_ROWS = 8192
ROUNDS = 15
MISS = 1e-4
MOST_TABLES = 256
ENTRY_ROWS = 2048


def _differing(unit: np.ndarray, mean: np.ndarray, threshold: float, seed: int) -> np.ndarray:
    """The chance of a differing bit, for pairs of a unit vector and one made at the threshold: of the raw angle at least."""
    other = np.random.default_rng(seed).standard_normal(unit.shape)
    other -= (unit * other).sum(axis=1, keepdims=True) * unit
    other *= math.sqrt(1 - threshold ** 2) / np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-9)
    a, b = unit - mean, threshold * unit + other - mean
    cosine = (a * b).sum(axis=1) / np.maximum(np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1), 1e-12)
    return np.maximum(np.arccos(np.clip(cosine, -1, 1)), math.acos(threshold)) / math.pi


def _tables(differ: np.ndarray, bits: int) -> int:
    """The least number of tables in which at most ``MISS`` of the pairs share no entry, or one more than ``MOST_TABLES`` if so many don't do."""
    apart = 1 - (1 - np.minimum(differ, 0.999)) ** bits
    for n in range(1, MOST_TABLES + 1):
        if (apart ** n).mean() <= MISS:
            return n
    return MOST_TABLES + 1


class Quantiser:
    """Rotations for binary codes and the tables cut from them."""

    def __init__(self, sample: np.ndarray, rows: int, threshold: float = THRESHOLD, seed: int = 2):
        d = self.width = sample.shape[1]
        self.bits = min(max(16, math.ceil(math.log2(max(rows, 2)))), 32, d)
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.mean = unit.mean(axis=0)
        differ = _differing(unit[:1024], self.mean, threshold, seed)
        while (tables := _tables(differ, self.bits)) > MOST_TABLES and self.bits > 1:
            self.bits -= 1
        self.tables = tables
        a_code = max(1, d // self.bits)
        _, axes = np.linalg.eigh((unit - self.mean).T @ (unit - self.mean))  # columns: principal axes
        flat = (unit - self.mean) @ axes
        rng = np.random.default_rng(seed)
        turns = []
        for _ in range(-(-self.tables // a_code)):
            turn, _ = np.linalg.qr(rng.standard_normal((d, d)))
            for _ in range(ROUNDS):
                u, _, vt = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
                turn = (u @ vt).T
            turns.append((axes @ turn)[:, :a_code * self.bits])
        self.turns = np.concatenate(turns, axis=1)[:, :self.tables * self.bits]

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """Entry of every vector in every table: (rows, tables)."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        on = (unit - self.mean) @ self.turns >= 0
        return on.reshape(len(vectors), self.tables, self.bits) @ (1 << np.arange(self.bits, dtype=np.int64))


def fit(rows: DataFrame, vector: str = "_v", row_id: str = "_rep", threshold: float = THRESHOLD) -> Quantiser | None:
    """Learns the rotations from at most ``SAMPLE_ROWS`` rows."""
    at = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("d")).first()
    if not at["n"]:
        return None
    sample = rows.select(vector, row_id).orderBy(F.xxhash64(row_id), row_id).limit(SAMPLE_ROWS).collect()
    return Quantiser(_matrix([r[0] for r in sample], at["d"]), at["n"], threshold)


def _matrix(lists, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    if len(column) and (np.diff(column.offsets.to_numpy()) == width).all():
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)
    return _matrix(column.to_pylist(), width)


def _entries(rows: DataFrame, model: Quantiser) -> DataFrame:
    """``_rep``, ``_table`` and ``_entry`` (label, table and key in one number) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = model.keys(_vectors(batch.column("_v"), model.width))
                n, t = keys.shape
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(batch.column("_rep").to_numpy(), t)), batch.column("_label").take(pa.array(np.repeat(np.arange(n), t))),
                    pa.array(np.tile(np.arange(t, dtype=np.int32), n)), pa.array(keys.ravel())], names=["_rep", "_label", "_table", "_key"])

    return rows.select("_rep", "_label", "_v").mapInArrow(run, "_rep long, _label string, _table int, _key long")


def _linked(ids: np.ndarray, copies: np.ndarray, group: np.ndarray, part: np.ndarray, table: np.ndarray, split: np.ndarray,
            vectors: np.ndarray, model: Quantiser, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links and smallest linked id per row, over pairs of rows of one group that meet there first.

    Rows are sorted by group.  In a pair of two blocks (``split``) only rows of
    different ``part`` are compared.
    """
    n = len(ids)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    keys = model.keys(vectors)
    links, parent = np.zeros(n, np.int64), np.arange(n)
    left, right = [], []
    step, at = 1, np.flatnonzero(group[:-1] == group[1:]) if n > 1 else np.empty(0, np.int64)
    while len(at):
        for lo in range(0, len(at), 100_000):
            i = at[lo:lo + 100_000]
            j = i + step
            near = (np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold) & ~(split[i] & (part[i] == part[j]))
            i, j = i[near], j[near]
            first = np.argmax(keys[i] == keys[j], axis=1) == table[i]
            left.append(i[first])
            right.append(j[first])
        step += 1
        at = at[at + step < n]
        at = at[group[at] == group[at + step]]
    if left:
        i, j = np.concatenate(left), np.concatenate(right)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        while True:  # union-find inside the groups, to the smallest id
            low = np.where(ids[parent[i]] <= ids[parent[j]], parent[i], parent[j])
            before = parent.copy()
            for side in (i, j, parent[i], parent[j]):
                order = np.argsort(-ids[low], kind="stable")  # the smallest id is written last
                better = ids[low] < ids[parent[side]]
                order = order[better[order]]
                parent[side[order]] = low[order]
            if (before == parent).all():
                break
    return links, ids[parent]


def links(rows: DataFrame, model: Quantiser, threshold: float = THRESHOLD) -> DataFrame:
    """``_rep``, ``_links`` (rows linked, with their copies) and ``_parent`` per row
    and entry with a link.  ``rows``: ``_rep``, ``_label``, ``_v``, ``_copies``."""
    entries = saved(_entries(rows, model), "itq-entries")
    full = entries.groupBy("_label", "_table", "_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    blocks = F.ceil(F.col("_n") / ENTRY_ROWS).cast("int")
    own = F.pmod(F.xxhash64("_rep"), blocks).cast("int")
    met = (entries.join(full, ["_label", "_table", "_key"]).withColumn("_part", own)
           .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
           .withColumn("_lo", F.least("_part", "_other")).withColumn("_hi", F.greatest("_part", "_other"))
           .select("_rep", "_label", "_table", "_key", "_part", "_lo", "_hi")
           .join(rows.select("_rep", "_v", "_copies"), "_rep"))
    keys = ["_label", "_table", "_key", "_lo", "_hi"]
    dealt = met.repartition(*keys).sortWithinPartitions(*keys, "_rep")

    def work(batch: pa.Table) -> pa.RecordBatch:
        col = {c: batch.column(c).combine_chunks() for c in batch.column_names}
        num = {c: col[c].to_numpy(zero_copy_only=False) for c in (*keys, "_rep", "_part", "_copies")}
        new = np.zeros(batch.num_rows, bool)
        for c in keys:
            new[1:] |= num[c][1:] != num[c][:-1]
        found, parent = _linked(num["_rep"], num["_copies"], np.cumsum(new), num["_part"], num["_table"], num["_lo"] != num["_hi"],
                                _vectors(col["_v"], model.width), model, threshold)
        some = found > 0
        return pa.RecordBatch.from_arrays([pa.array(num["_rep"][some]), pa.array(found[some]), pa.array(parent[some])], names=["_rep", "_links", "_parent"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of whole groups and the start of the next
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            last = held.slice(held.num_rows - 1).to_pylist()[0]
            same = np.ones(held.num_rows, bool)
            for c in keys:
                same &= held.column(c).to_numpy() == last[c]
            start = int(np.argmax(same))  # of the last, maybe open group
            if start:
                yield work(held.slice(0, start))
                held = held.slice(start)
        if held is not None and held.num_rows:
            yield work(held)

    return dealt.mapInArrow(run, "_rep long, _links long, _parent long")


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD) -> DataFrame:
    """The ids with ``n_links``, ``component_id`` and ``kept``, one row per input row."""
    workers_import(df.sparkSession)
    rows = df.select(F.col(vec_id).cast("long").alias("_i"), F.col(label).cast("string").alias("_label"), F.col(vector).alias("_v"))
    sized = F.coalesce(F.exists("_v", lambda x: x != 0), F.lit(False))
    able = rows.filter(F.col("_i").isNotNull() & F.col("_label").isNotNull() & usable(F.col("_v")) & sized)
    able = able.groupBy("_i").agg(F.min(F.struct("_label", "_v")).alias("_x")).select("_i", "_x.*")
    able = saved(able, "itq-rows")
    groups = saved(able.groupBy("_label", "_v").agg(F.min("_i").alias("_rep"), F.count(F.lit(1)).alias("_copies")), "itq-groups")
    ids = able.join(groups, ["_label", "_v"]).select("_i", "_rep", "_copies")
    model = fit(groups, threshold=threshold)
    if model is None:
        return df.select(F.col(vec_id).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                         F.col(vec_id).cast("long").alias("component_id"), F.col(vec_id).isNotNull().alias("kept"))
    found = saved(links(groups, model, threshold), "itq-links")
    total = found.groupBy("_rep").agg(F.sum("_links").alias("_links"))
    roots = components(found.select(F.col("_rep").alias("a"), F.col("_parent").alias("b")))
    known = (ids.join(total, "_rep", "left").join(roots.withColumnRenamed("node", "_rep"), "_rep", "left")
             .select("_i", (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("_links"), F.coalesce("root", "_rep").alias("_root")))
    out = rows.select("_i").join(known, "_i", "left")
    root = F.coalesce("_root", "_i")
    return out.select(F.col("_i").alias("vec_id"), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
                      root.alias("component_id"), F.coalesce(F.col("_i") == root, F.lit(False)).alias("kept"))


def op2_itq_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of one label: links, component and the one kept of it."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
           ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
     r AS (SELECT vec_id, vec_id AS seen FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.seen = l.a),
     c AS (SELECT vec_id, min(seen) AS component_id FROM r GROUP BY vec_id),
     n AS (SELECT a AS vec_id, count(DISTINCT b) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, coalesce(e.vec_id = c.component_id, false) AS kept
FROM embeddings e LEFT JOIN c ON c.vec_id = e.vec_id LEFT JOIN n ON n.vec_id = e.vec_id
"""
