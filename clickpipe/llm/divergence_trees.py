"""Divergence of every source from the other sources and from its language.

1. Python tasks cut whole texts into terms and count them, merged per (lang, source)
   within a task before the shuffle; Spark adds them up and keeps, per lang, the
   terms in at least ``MIN_DOCS`` of its documents.
2. The kept terms of a lang get ids: segments of about ``SEGMENT`` terms of like
   frequency, so that rare terms, absent from most sources, lie side by side.  A
   segment is one subtree of the lang's segment tree over term ids.
3. A task holds a segment of a block of sources against that of another block.
   All their trees are hash-consed: a node is the pair of its children's numbers,
   equal count subtrees have one number at each level.  Two trees are walked
   together from the roots, level by level; equal pairs of nodes are merged with
   their number of places before they are opened, so each is priced once, and a
   price is computed for each distinct pair of counts.
4. Prices of segments are added up; what a term adds against its lang's share is
   plain DataFrame arithmetic.

All arithmetic is on whole numbers (decimals or Python integers where 64 bits might
not do).  A task's rows are bounded by ``SEGMENT`` terms and two blocks of ``BLOCK``
sources, whatever share of the corpus a source has.

Defined cases: null text, lang and source are read as ''; empty texts and texts without
terms make their group occur; repeated rows count like any other; a lang without kept
terms has pairs of value 0 and no terms; the only source of a lang has no pairs; an
empty table gives no rows; very long texts are counted whole, in pieces that end at
term ends; other columns aren't read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpipe.llm.common import read_table, saved, workers_import

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
SEGMENT = 2048
BLOCK = 16
PIECE = 1 << 22
HELD = 1 << 18

# Bytes of terms, upper case lowered; all others become blanks.
_TABLE = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def terms_of(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in pieces."""
    data = data.translate(_TABLE)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _counted(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, occurrences ``n`` and documents ``d``, merged within a task."""
    workers_import(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in held.items():
                keys = list(n)
                for lo in range(0, len(keys), 1 << 16):
                    part = keys[lo:lo + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()), pa.array(part, pa.binary()),
                         pa.array([n[k] for k in part], pa.int64()), pa.array([d[k] for k in part], pa.int64())],
                        names=["lang", "source", "term", "n", "d"])
            held.clear()

        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                seen: Counter = Counter()
                for piece in terms_of(text):
                    seen.update(piece)
                n.update(seen)
                d.update(seen.keys())
            if sum(len(n) for n, _ in held.values()) > HELD:
                yield from out()
        yield from out()

    found = rows.mapInArrow(run, "lang string, source string, term binary, n long, d long")
    return found.withColumn("term", F.col("term").cast("string")).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def _share(count: Column | str, total: str = "total", kinds: str = "kinds") -> Column:
    """A count's smoothed share in parts of ``SCALE``, from 1."""
    count = F.col(count) if isinstance(count, str) else count
    top = (count + 2).cast("decimal(24,0)") * F.lit(SCALE).cast("decimal(12,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, (F.col(total) + 2 * F.col(kinds)).cast("decimal(24,0)")).cast("long")


def shares(counts: np.ndarray, total: int, kinds: int) -> np.ndarray:
    """The same on an array (-1: no term, share 0); Python integers where 64 bits don't do."""
    wide = counts.max(initial=0) > (1 << 62) // SCALE
    c = counts.astype(object) if wide else counts
    p = 1 + (c + 2) * SCALE // (total + 2 * kinds)
    return np.where(counts < 0, 0, p).astype(np.int64)


def consed(leaves: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hash-consed trees over the rows of ``leaves`` (a power of two wide).

    Returns, from the level below the roots down, the children (left, right) of
    each node; the distinct leaf counts; and each row's root."""
    values, nodes = np.unique(leaves, return_inverse=True)
    nodes, levels, kinds = nodes.reshape(leaves.shape), [], len(values)
    while nodes.shape[1] > 1:
        pairs, back = np.unique(nodes[:, ::2].astype(np.int64) * kinds + nodes[:, 1::2], return_inverse=True)
        levels.append(np.stack([pairs // kinds, pairs % kinds]))
        nodes, kinds = back.reshape(len(leaves), -1), len(pairs)
    return levels[::-1], values, nodes[:, 0]


def walk(levels: list[np.ndarray], roots: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Both trees of each pair of roots, walked together: (pair, left leaf, right leaf,
    places) for each distinct pair of leaves; equal pairs of nodes are opened once."""
    u, v = roots
    pair, times = np.arange(len(u)), np.ones(len(u), np.int64)
    for children in levels:
        a, b = children[:, u].ravel(), children[:, v].ravel()
        width = int(max(a.max(initial=0), b.max(initial=0))) + 1
        keys, first, back = np.unique((np.tile(pair, 2) * width + a) * width + b, return_index=True, return_inverse=True)
        times = np.bincount(back, np.tile(times, 2), len(keys)).astype(np.int64)  # exact: far below 2**53
        u, v, pair = a[first], b[first], np.tile(pair, 2)[first]
    return pair, u, v, times


def price_segment(pos: np.ndarray, count: np.ndarray, source: np.ndarray, totals: np.ndarray, block: np.ndarray, across: bool,
                  kinds: int, size: int) -> list[tuple]:
    """Value of every pair of sources over one segment of ``size`` terms.

    ``totals`` and ``block`` go by source number; pairs lie across two blocks or
    within one."""
    wide = 1
    while wide < size:
        wide *= 2
    leaves = np.zeros((len(totals), wide), np.int64)
    leaves[:, size:] = -1
    leaves[source, pos] = count
    levels, values, root = consed(leaves)
    prices = [shares(values, int(n), kinds) for n in totals]
    out = []
    for i in range(len(totals)):
        others = np.flatnonzero(block > block[i]) if across else np.arange(i + 1, len(totals))
        same: dict[tuple, list[int]] = {}  # partners with equal trees and totals are priced once
        for j in others.tolist():
            same.setdefault((root[j], totals[j]), []).append(j)
        if not same:
            continue
        firsts = np.array([x[0] for x in same.values()])
        pair, u, v, times = walk(levels, (np.full(len(firsts), root[i]), root[firsts]))
        p, q = prices[i][u], np.stack([prices[j] for j in firsts])[pair, v]
        each = np.where(p + q > 0, (p - q) * (p - q) // np.maximum(p + q, 1), 0) * times
        value = np.zeros(len(firsts), np.int64)
        np.add.at(value, pair, each)
        out += [(i, j, int(x)) for group, x in zip(same.values(), value, strict=True) for j in group]
    return out


_UNIT = T.StructType([T.StructField(c, T.StringType()) for c in ("lang", "a", "b")] + [T.StructField("value", T.LongType())])


def _pair_values(terms: DataFrame, groups: DataFrame, segments: DataFrame) -> DataFrame:
    """``lang``, ``a``, ``b``, ``value`` of every unordered pair of sources with kept terms in its lang."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n_sources") / BLOCK)).cast("int")
    members = groups.withColumn("_block", F.pmod(F.xxhash64("source"), blocks).cast("int"))
    dealt = members.withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("lang", "source", "total", "kinds", "_block", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"))
    marks = segments.join(dealt, "lang").select("lang", "_band", "_bucket", "_i", "_j", "source", "_block", F.lit(-1).alias("pos"),
                                                F.col("total").alias("count"), "kinds", "size")
    rows = terms.join(dealt.drop("total", "kinds"), ["lang", "source"]).select("lang", "_band", "_bucket", "_i", "_j", "source", "_block", "pos",
                                                                     F.col("n").alias("count"), F.lit(0).cast("long").alias("kinds"), F.lit(0).cast("long").alias("size"))
    workers_import(terms.sparkSession)

    def run(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_numpy() for c in ("source", "_block", "pos", "count", "kinds", "size")}
        mark = col["pos"] < 0
        names, first = np.unique(col["source"][mark].astype(object), return_index=True)
        number = {s: k for k, s in enumerate(names)}
        of = np.array([number[s] for s in col["source"][~mark]], np.int64)
        found = price_segment(col["pos"][~mark], col["count"][~mark], of, col["count"][mark][first], col["_block"][mark][first],
                              table.column("_i")[0] != table.column("_j")[0], int(col["kinds"][mark][0]), int(col["size"][mark][0]))
        lang = table.column("lang")[0].as_py()
        return pa.table([pa.array([lang] * len(found), pa.string()), pa.array([names[i] for i, _, _ in found], pa.string()),
                         pa.array([names[j] for _, j, _ in found], pa.string()), pa.array([x for _, _, x in found], pa.int64())], names=_UNIT.names)

    units = marks.unionByName(rows).groupBy("lang", "_band", "_bucket", "_i", "_j").applyInArrow(run, _UNIT)
    return units.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value`` and ``rank``."""
    counts = saved(_counted(docs), "divergence-counts")
    total = counts.groupBy("lang", "term").agg(F.sum("n").alias("q_n"), F.sum("d").alias("d")).filter(F.col("d") >= min_docs)
    total = total.withColumn("_band", F.floor(F.log2("q_n")).cast("int"))
    bands = total.groupBy("lang", "_band").agg(F.count(F.lit(1)).alias("_m"))
    total = total.join(bands, ["lang", "_band"]).withColumn("_bucket", F.pmod(F.xxhash64("term"), F.ceil(F.col("_m") / SEGMENT)))
    place = Window.partitionBy("lang", "_band", "_bucket").orderBy(F.col("q_n").desc(), "term")
    kept = saved(total.select("lang", "term", "q_n", "_band", "_bucket", (F.row_number().over(place) - 1).alias("pos")), "divergence-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("q_n").alias("whole"))
    segments = kept.groupBy("lang", "_band", "_bucket").agg(F.count(F.lit(1)).alias("size"))

    terms = saved(counts.drop("d").join(kept, ["lang", "term"]), "divergence-kept")
    sizes = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    many = every.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    groups = every.join(sizes, ["lang", "source"], "left").join(many, "lang").join(langs, "lang", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    groups = saved(groups.select("lang", "source", "n_sources", zero("total"), zero("kinds"), zero("whole")), "divergence-groups")

    values = saved(_pair_values(terms, groups, segments), "divergence-pairs")
    both = values.unionByName(values.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    pairs = pairs.join(both.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value"), ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    priced = terms.join(groups, ["lang", "source"]).withColumn("p", _share("n")).withColumn("q", _share("q_n", "whole")).filter("p > q")
    value = F.expr("(p - q) * (p - q) div (p + q)")
    single = priced.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    return (single.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .unionByName(pairs.withColumn("rank", F.row_number().over(order))))


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    """Every source against the others of its lang, and the terms that set it apart."""
    return divergence(read_table(spark, sf_dir, "documents", "lang", "source", "text"))


ORACLE_SQL = r"""WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
w AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS q_n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS n FROM w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
l AS (SELECT lang, count(*) AS V, sum(q_n) AS L FROM kept GROUP BY lang),
g AS (SELECT e.lang, e.source, coalesce(l.V, 0) AS V, coalesce(l.L, 0) AS L, coalesce((SELECT sum(n) FROM c WHERE c.lang = e.lang AND c.source = e.source), 0) AS N
  FROM (SELECT DISTINCT lang, source FROM d) e LEFT JOIN l ON e.lang = l.lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 2) // CAST(g.N + 2 * g.V AS HUGEINT) AS p,
         1 + 1000000000 * (k.q_n + 2) // CAST(g.L + 2 * g.V AS HUGEINT) AS q
  FROM g JOIN kept k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 10"""
