"""MinHash near-dedup: BagMinHash signatures, banding, verified multiset overlap.

Documents are multisets of shingles of ``WORDS`` lower-case words (a shorter
text is one shingle; a text without words has none).  Similarity is the
weighted Jaccard index, sum of minima by sum of maxima of the counts.

Signature: the weight axis is cut into the intervals (0,1], (1,2], (2,4],
(4,8] ...; every (shingle, interval) has its own Poisson process over time,
whose rate is the interval's width, and whose points carry a random signature
position and a random weight within the interval.  A count w sees all points of
the intervals below it and, of the one that holds it, the points with weight at
most w.  Position j keeps the earliest point it sees: two documents keep the
same one with probability equal to their weighted Jaccard index, whatever the
counts.  Points are made from hashes in order of time, only as long as they can
still be earlier than the latest kept one.

Candidates: ``BANDS`` bands of ``ROWS`` positions; at similarity 0.8 a pair
shares a band with probability above 0.9998.  Texts that are equal are one node
first, so copies meet no one.  Every node is first held against one other, the
node of its buckets that meets most others (in a group of near copies that is
the text they come from).  Buckets that then still hold several components are
put together to clusters of nodes, and each pair of blocks of a cluster compares
its nodes on arrays: pairs of one component are skipped, pairs whose signatures
agree in ``SIGMAS`` standard deviations too few positions, too, and the others
verified.  No pair is written out but links that join two components, so no
group, however large, makes rows of all its pairs.  Verification compares the
exact multisets (64-bit shingle hashes) of both whole texts.

Defined cases: a null text is read as empty; a text without words is alike to
none, not even to its equal; repeated rows are copies; ``class_id`` is the
smallest id of the class (null only if all its ids are), ``kept`` marks that id;
extra columns pass through where rows are returned; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpipe.llm.common import read_table, saved, tucked, untucked, whole_text, workers_import
from clickpipe.llm.components import components
from clickpipe.llm.rolling import mix, prefix, ranges

WORDS = 5
THRESHOLD = 0.8
BANDS = 30
ROWS = 6
BLOCK = 512
SIGMAS = 4

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LEVELS = np.arange(1, 65, dtype=np.uint64) * _GOLD
_PLACES = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(64)], np.uint64)


def shingles(text: str | None, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and their counts."""
    data = np.frombuffer((text or "").lower().encode("utf-8"), np.uint8)
    edge = np.diff(np.concatenate([[False], _WORD_BYTE[data], [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    word = mix(ranges(prefix(data), start, end) + (end - start).astype(np.uint64))
    k = min(words, len(word))
    total = sum(word[i:len(word) - k + 1 + i] * _PLACES[i] for i in range(k))
    return np.unique(mix(total + _LEVELS[k]), return_counts=True)


def signature(hashes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Earliest time at each position, as 64-bit patterns."""
    top = np.ceil(np.log2(counts)).astype(np.int64)  # the interval that holds the count
    key, width, low, weight = [], [], [], []
    for level in range(int(top.max()) + 1):
        on = top >= level
        floor = 0 if level == 0 else 1 << (level - 1)
        key.append(mix(hashes[on] + _LEVELS[level]))
        width.append(np.full(on.sum(), max(1, floor)))
        low.append(np.full(on.sum(), floor))
        weight.append(counts[on])
    key, width, low, weight = map(np.concatenate, (key, width, low, weight))
    first = np.full(size, np.inf)
    time, number = np.zeros(len(key)), 0
    many = max(1, int(1.2 * size * np.log(size) / width.sum()))  # points of a process at a time
    while len(key):
        turn = np.arange(number + 1, number + many + 1, dtype=np.uint64) * _GOLD
        h = mix(key[:, None] + turn)
        gap = -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / (width * size)[:, None]
        times = np.add.accumulate(np.concatenate([time[:, None], gap], axis=1), axis=1)[:, 1:]  # the same sums for any ``many``
        g = mix(h ^ _GOLD)
        at = (g % np.uint64(size)).astype(np.int64)
        seen = times < first.max()
        part = low + width > weight  # counts that end inside their interval
        if part.any():
            level = low[:, None] + width[:, None] * ((mix(g) >> np.uint64(11)).astype(np.float64) / (1 << 53))
            seen &= ~part[:, None] | (level < weight[:, None])
        np.minimum.at(first, at[seen], times[seen])
        number += many
        time = times[:, -1]
        on = time < first.max()
        key, width, low, weight, time = key[on], width[on], low[on], weight[on], time[on]
    return first.view(np.uint64)


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    part = mix((sig.reshape(bands, rows) * _PLACES[:rows]).sum(axis=1) + np.arange(bands, dtype=np.uint64) * _GOLD)
    return part.view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard index of two multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0


def node(text: str = "text"):
    """Number of a text: equal texts are one node."""
    return F.xxhash64(whole_text(text))


def has_words(text: str = "text"):
    """Whether a text has a shingle at all."""
    return F.lower(whole_text(text)).rlike(r"[0-9a-z]|[^\x00-\x7F]")


def _signed(texts: DataFrame) -> DataFrame:
    """``_u``, ``_n`` (shingles) and ``_bands`` of each text; texts without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, keys = [], [], []
            for u, text in zip(batch.column("_u").to_pylist(), batch.column("_t"), strict=True):
                found, counts = shingles(text.as_py())
                if len(found):
                    ids.append(u)
                    sizes.append(int(counts.sum()))
                    keys.append(band_keys(signature(found, counts, BANDS * ROWS)))
            flat = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), flat)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), lists], names=["_u", "_n", "_bands"])

    return texts.mapInArrow(run, "_u long, _n long, _bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (``a``, ``b``) whose whole texts overlap enough."""
    both = (pairs.join(texts.select(F.col("_u").alias("a"), F.col("_t").alias("_ta")), "a")
            .join(texts.select(F.col("_u").alias("b"), F.col("_t").alias("_tb")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None  # the rows of one b come one after another
        for batch in batches:
            keep = []
            for i, b in enumerate(batch.column("b").to_pylist()):
                if b != last:
                    last, held = b, shingles(batch.column("_tb")[i].as_py())
                keep.append(overlap(shingles(batch.column("_ta")[i].as_py()), held) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``_u`` and ``_root`` of every node that is alike to another text and isn't its root."""
    workers_import(docs.sparkSession)
    texts = docs.select(node(text).alias("_u"), whole_text(text).alias("_t"))
    signed = saved(_signed(texts), "minhash-bands").dropDuplicates(["_u"])
    rows = saved(signed.select("_u", "_n", F.explode("_bands").alias("_key")), "minhash-keys")
    full = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_m")).filter("_m > 1")
    members = saved(rows.join(full, "_key"), "minhash-members")
    sizes = members.groupBy("_u").agg(F.first("_n").alias("_n"), F.sum("_m").alias("_met"))
    texts = saved(texts.join(sizes.select("_u"), "_u", "left_semi").dropDuplicates(["_u"]), "minhash-texts")

    # each node against the node of its buckets that meets most others
    ranked = members.select("_u", "_key").join(sizes, "_u")
    centre = ranked.groupBy("_key").agg(F.max(F.struct("_met", "_u", "_n")).alias("_x"))
    first = (ranked.join(centre, "_key").groupBy("_u").agg(F.max("_x").alias("_x"), F.first("_n").alias("_n"))
             .filter("_u <> _x._u").filter(F.least("_n", "_x._n") >= threshold * F.greatest("_n", "_x._n"))
             .select(F.col("_u").alias("a"), F.col("_x._u").alias("b")))
    links = saved(_verified(first, texts, threshold), "minhash-links")
    placed = members.select("_u", "_key").join(components(links).withColumnRenamed("node", "_u"), "_u", "left")
    placed = placed.select("_u", "_key", F.coalesce("root", "_u").alias("_c"))

    # what a bucket still holds apart, as clusters of nodes that share such buckets
    apart = placed.groupBy("_key").agg(F.min("_c").alias("_lo"), F.max("_c").alias("_hi"), F.min("_u").alias("_least")).filter("_lo <> _hi")
    open_ = saved(placed.join(apart.select("_key", "_least"), "_key"), "minhash-open")
    cluster = components(open_.select(F.col("_u").alias("a"), F.col("_least").alias("b"))).withColumnRenamed("node", "_u")
    nodes = open_.select("_u", "_c").distinct().join(cluster, "_u", "left").select("_u", "_c", F.coalesce("root", "_u").alias("_cluster"))
    more = saved(_cluster_links(saved(nodes, "minhash-clusters"), texts, threshold), "minhash-links")
    return components(links.unionByName(more)).select(F.col("node").alias("_u"), F.col("root").alias("_root"))


def _cluster_links(nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (``a``, ``b``) that join the components inside each cluster.

    ``nodes``: ``_u``, its component ``_c`` and ``_cluster``.  A cluster is dealt
    into blocks of about ``BLOCK`` nodes, and each pair of blocks is a group that
    compares its nodes on arrays and gives only links that join two components."""
    blocks = nodes.groupBy("_cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_k"))
    own = F.pmod(F.xxhash64("_u"), F.col("_k")).cast("int")
    dealt = (nodes.join(blocks, "_cluster").withColumn("_part", own)
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
             .select("_u", "_c", "_cluster", "_part", F.least("_part", "_other").alias("_lo"), F.greatest("_part", "_other").alias("_hi"))
             .join(texts, "_u").repartition("_cluster", "_lo", "_hi").sortWithinPartitions("_cluster", "_lo", "_hi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("_cluster", "_lo", "_hi", "_part", "_u", "_c", "_t")), strict=True))
        for (_, lo, hi), group in groupby(rows, key=lambda r: r[:3]):
            _, _, _, part, u, c, text = zip(*group, strict=True)
            found = _joining_links(list(u), np.array(c), np.array(part) if lo != hi else None, [shingles(t) for t in text], threshold)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

    return dealt.select("_cluster", "_lo", "_hi", "_part", "_u", "_c", "_t").mapInArrow(run, "a long, b long")


def _joining_links(ids: list[int], component: np.ndarray, part: np.ndarray | None, sets: list[tuple[np.ndarray, np.ndarray]],
                   threshold: float) -> list[tuple[int, int]]:
    """Verified pairs that join components; pairs whose signatures agree in far too few
    positions for the threshold (``SIGMAS`` standard deviations) aren't verified."""
    n, size = len(ids), BANDS * ROWS
    least = threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / size)
    signs = np.stack([signature(*x, size) for x in sets])
    total = np.array([x[1].sum() for x in sets])
    _, parent = np.unique(component, return_inverse=True)
    parent = parent.copy()
    found = []
    for i in range(n - 1):
        j = np.arange(i + 1, n)
        if part is not None:
            j = j[part[j] != part[i]]
        j = j[parent[j] != parent[i]]
        j = j[np.minimum(total[j], total[i]) >= threshold * np.maximum(total[j], total[i])]
        j = j[(signs[j] == signs[i]).mean(axis=1) >= least] if len(j) else j
        if not len(j):
            continue
        hashes, counts = sets[i]
        ends = np.cumsum([len(sets[k][0]) for k in j])
        other, times = np.concatenate([sets[k][0] for k in j]), np.concatenate([sets[k][1] for k in j])
        at = np.minimum(np.searchsorted(hashes, other), len(hashes) - 1)
        both = np.where(hashes[at] == other, np.minimum(counts[at], times), 0)
        shared = np.add.reduceat(both, np.concatenate([[0], ends[:-1]]))
        for k in j[shared >= threshold * (total[j] + total[i] - shared)]:
            if parent[k] != parent[i]:
                parent[parent == parent[k]] = parent[i]
                found.append((ids[i], ids[k]))
    return found


def with_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document without its text: its node ``_u``, its class as
    ``_root`` (null for a text without words) and ``class_id``, and ``kept``."""
    roots = classes(docs, text, threshold)
    rows = docs.select(F.col(doc_id).alias("doc_id"), node(text).alias("_u"), has_words(text).alias("_w"))
    # one row per node first: copies may be a third of all rows
    firsts = rows.filter("_w").groupBy("_u").agg(F.min("doc_id").alias("_id"))
    placed = saved(firsts.join(roots, "_u", "left").select("_u", "_id", F.coalesce("_root", "_u").alias("_root")), "minhash-nodes")
    least = placed.groupBy("_root").agg(F.min("_id").alias("class_id"))
    known = placed.join(least, "_root").select("_u", "_root", "class_id")
    alone = rows.filter("NOT _w").withColumn("class_id", F.col("doc_id")).withColumn("_root", F.lit(None).cast("long"))
    out = rows.filter("_w").join(known, "_u").unionByName(alone)
    return out.select("doc_id", "_u", "_root", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The documents without all but one of each class: the smallest id, then the
    smallest text hash, stays; of rows that repeat in id and text one does; every
    text without words stays."""
    rows = saved(with_classes(docs, text, doc_id, threshold).select("doc_id", "_u", "_root"), "minhash-classes")
    order = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "_u")
    stay = (rows.filter("_root IS NOT NULL").groupBy("_root").agg(F.min(order).alias("_x"))
            .select(F.col("_x.doc_id").alias("_i"), F.col("_x._u").alias("_u")))
    body = tucked(docs, node(text).alias("_u2"), F.col(doc_id).alias("_id"))
    same = (F.col("_u2") == F.col("_u")) & F.col("_id").eqNullSafe(F.col("_i"))
    out = body.join(stay, same, "left_semi")
    again = rows.filter("_root IS NOT NULL").groupBy("doc_id", "_u").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    again = saved(again.select(F.col("doc_id").alias("_i"), "_u"), "minhash-repeats")
    if not again.isEmpty():  # rows that repeat in full, or but for other columns
        out = out.join(again, same, "left_anti").unionByName(out.join(again, same, "left_semi").dropDuplicates(["_u2", "_id"]))
    return out.select(*untucked(docs.columns)).unionByName(docs.filter(~has_words(text)))


def op6_bag_minhash(spark, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document, and the one kept of each class."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return with_classes(docs).select("doc_id", "class_id", "kept")
