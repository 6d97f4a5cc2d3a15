"""Fuzzy line dedup by MinHash.

A line is lower-cased and trimmed; every line that isn't blank takes part.  Its
set holds each run of ``SHINGLE`` characters (a shorter line is its own single
shingle).

Equal lines are one node first (a 64-bit hash of the line), with its first place.
Signature: ``BANDS`` bands of ``ROWS`` least values of the shingles' hashes, each under
a mask of its own; two sets of similarity 0.8 share a band with probability 0.991.
Sets of at most ``SMALL`` shingles have runs of neighbours in their sorted hashes as
further keys; by counting the gaps, two such sets at 0.8 always share a run.

Each node is held against the node of each of its buckets that meets most others,
by the exact Jaccard index of both shingle sets; union-find (``components``) over
the verified pairs; this is done ``CENTRES`` times, each time against a centre in
another component.  Nodes of a bucket that still lie apart are compared block by
block (all but those of the bucket's largest component among themselves), so no
candidate pair is left undecided and no rows of pairs are made.  Of
each component the line at the first place stays (smallest document id, then text
hash, then line number); all its other places are dropped.

Lines are cut, normalised, joined and aggregated by DataFrame functions; signatures
and the Jaccard index are made in Arrow batches (README: why not natively).
Buckets, places and pairs are aggregated on the map side before they are
shuffled or joined on hashes, where the engine splits hot keys; tables are removed
once what was made of them is written.

Defined cases: null text is read as empty and has one blank line; blank lines are left
alone; a document that loses a line and keeps none with a letter or digit goes, however
short its lines; repeated rows (equal id and text) are numbered: the first is judged
by its places, the others lose every line that takes part; null ids come after
all others; a very long line is one line; an empty table gives no rows; extra columns
pass through ``dedup_lines``, names of its own never clash with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpipe.llm.common import discard, read_table, saved, tucked, untucked, whole_text, workers_import
from clickpipe.llm.components import components
from clickpipe.llm.rolling import mix

SHINGLE = 5
BANDS = 20
ROWS = 7
SMALL = 18
CHUNK = 1 << 17
CENTRES = 2
BLOCK = 256
THRESHOLD = 0.8
#: Rows of two numbers that are broadcast at most (16 MB); larger tables are shuffled.
BROADCAST_ROWS = 1 << 20

_rng = np.random.default_rng(0x11FE)
_FACTORS = _rng.integers(1, 1 << 62, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def normal(line: Column) -> Column:
    """The form in which lines are compared."""
    return F.trim(F.lower(line))


def shingles(line: str) -> set[str]:
    """Every run of ``SHINGLE`` characters; a shorter line is its own."""
    return {line[i:i + SHINGLE] for i in range(len(line) - SHINGLE + 1)} or {line}


def alike(a: set[str], b: set[str], threshold: float) -> bool:
    """Whether the exact Jaccard index reaches the threshold."""
    small, large = sorted((len(a), len(b)))
    if small < threshold * large:  # an upper bound
        return False
    both = len(a & b)
    return both >= threshold * (small + large - both)


def _far(line: str, other: set[str], threshold: float) -> bool:
    """Whether the first part of a line already holds more shingles that ``other`` lacks than any
    set as alike as the threshold can: at most the (1 - threshold)th part of its own."""
    windows = len(line) - SHINGLE + 1
    if windows < 40:
        return False
    missing = {line[i:i + SHINGLE] for i in range(int(windows * (1 - threshold) * 1.5))} - other
    return len(missing) > (1 - threshold) * windows + 1e-6 * windows  # the product may round down


def _runs(hashes: np.ndarray, rows: int) -> list[int]:
    parts = mix(hashes)
    out = np.full(len(hashes) - rows + 1, rows, np.uint64)
    for i in range(rows):
        out = mix(out * _SPREAD + parts[i:len(parts) - rows + 1 + i])
    return out.tolist()


def band_keys(lines: list[str]) -> list[list[int]]:
    """The bucket keys of every line, as unsigned numbers."""
    lengths = np.array([len(x) for x in lines], np.int64)
    pad = "\0" * (SHINGLE - 1)
    codes = np.frombuffer((pad.join(lines) + pad).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    places = max(0, len(codes) - SHINGLE + 1)
    at = np.zeros(places, np.uint64)
    for i, factor in enumerate(_FACTORS):
        at += mix(codes[i:i + places]) * factor
    windows = np.maximum(lengths - (SHINGLE - 1), 1)
    first = np.cumsum(windows) - windows
    starts = np.cumsum(lengths + SHINGLE - 1) - (lengths + SHINGLE - 1)
    hashes = mix(at[np.repeat(starts - first, windows) + np.arange(int(windows.sum()))])
    top = (hashes >> np.uint64(32)).astype(np.uint32)
    keys = np.empty((BANDS, len(lines)), np.uint64)
    for band in range(BANDS):
        key = np.full(len(lines), band, np.uint64)
        for mask in _MASKS[band * ROWS:(band + 1) * ROWS]:
            key = mix(key * _SPREAD + np.minimum.reduceat(top ^ mask, first))
        keys[band] = key
    out = keys.T.tolist()
    for i in np.flatnonzero(windows <= 4 * SMALL).tolist():
        own = np.unique(hashes[first[i]:first[i] + windows[i]])
        if len(own) <= SMALL:
            for rows, most in ((1, 1), (2, 5), (3, SMALL)):
                if rows <= len(own) <= most:
                    out[i] += _runs(own, rows)
    return out


def _chunks(lines: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for x in lines:
        held.append(x)
        size += len(x)
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def lines_of(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``_d``, ``_r`` (a document's key), ``_no`` (from 0), ``_line`` (normal form) and
    ``_h`` (its node) of every line that takes part."""
    body = whole_text(text)
    rows = docs.select(F.col(doc_id).alias("_d"), F.xxhash64(body).alias("_r"), F.posexplode(F.split(body, "\n")).alias("_no", "_line"))
    rows = rows.withColumn("_line", normal(F.col("_line"))).filter(F.col("_line").rlike(r"\S"))
    return rows.withColumn("_h", F.xxhash64("_line"))


def _place() -> Column:
    return F.struct(F.col("_d").isNull().alias("_null"), "_d", "_r", "_no")


def occurrences(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``_h``, ``_d``, ``_r``, ``_no`` and bucket keys of every line that takes part; no text."""
    workers_import(docs.sparkSession)
    lines = lines_of(docs, text, doc_id).select("_h", "_d", "_r", "_no", "_line")
    rest = lines.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [k for part in _chunks(batch.column("_line").to_pylist()) for k in band_keys(part)]
            ends = np.cumsum([0, *map(len, keys)], dtype=np.int32)
            flat = np.array([k for row in keys for k in row], np.uint64).astype(np.int64)
            made = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*map(batch.column, rest), made], names=[*rest, "_keys"])

    schema = T.StructType([lines.schema[c] for c in rest] + [T.StructField("_keys", T.ArrayType(T.LongType()))])
    return saved(lines.mapInArrow(run, schema), "line-occurrences")


def _few(df: DataFrame) -> DataFrame:
    """A written table, marked for a broadcast if it is small enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (``a``, ``b``) whose lines are alike."""
    workers_import(pairs.sparkSession)
    both = (pairs.join(texts.select(F.col("_h").alias("a"), F.col("_line").alias("_la")), "a")
            .join(texts.select(F.col("_h").alias("b"), F.col("_line").alias("_lb")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, set()
        for batch in batches:
            keep = []
            for b, x, y in zip(*(batch.column(c).to_pylist() for c in ("b", "_la", "_lb")), strict=True):
                if b != centre:
                    centre, own = b, shingles(y)
                # No set needed where the line can't hold enough shingles, or where its start lacks too many.
                fits = max(1, len(x) - SHINGLE + 1) >= threshold * len(own) and not _far(x, own, threshold)
                keep.append(fits and alike(shingles(x), own, threshold))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = both.select("a", "b", "_la", "_lb").sortWithinPartitions("b")
    return saved(both.mapInArrow(run, "a long, b long"), "line-links")


def _bucket_links(apart: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links between components that a bucket still holds apart.

    The nodes of a bucket's largest component need no comparing with each other: they
    are dealt into blocks of about ``BLOCK``, the others into blocks of their own, and a task
    holds a block of others against a block of either kind, in place.  So a large
    group of near copies with a few strangers is shipped about once.  ``apart``: ``_h``,
    ``_key`` and component ``_c``."""
    workers_import(apart.sparkSession)
    sizes = apart.groupBy("_key", "_c").agg(F.count(F.lit(1)).alias("_n"))
    shares = sizes.groupBy("_key").agg(F.max(F.struct("_n", "_c")).alias("_x"), F.sum("_n").alias("_m"))
    shares = shares.select("_key", F.col("_x._c").alias("_major"), F.ceil(F.col("_x._n") / BLOCK).cast("int").alias("_k"),
                           F.ceil((F.col("_m") - F.col("_x._n")) / BLOCK).cast("int").alias("_l"))
    rows = apart.join(shares, "_key").withColumn("_of", F.col("_c") == F.col("_major"))
    part = F.pmod(F.xxhash64("_h"), F.when(F.col("_of"), F.col("_k")).otherwise(F.col("_l"))).cast("int")
    rows = rows.withColumn("_part", part)
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    cell = lambda i, j, large: F.struct(i.alias("i"), j.alias("j"), F.lit(large).alias("large"))
    # Cells (i, j): others' block i against block j of the largest component, or i <= j both of others.
    against = F.transform(upto(F.col("_l")), lambda i: cell(i, F.col("_part"), True))
    own = F.concat(F.transform(upto(F.col("_k")), lambda j: cell(F.col("_part"), j, True)),
                   F.transform(upto(F.col("_l")), lambda j: cell(F.least("_part", j), F.greatest("_part", j), False)))
    dealt = rows.withColumn("_cell", F.explode(F.when(F.col("_of"), against).otherwise(own)))
    dealt = dealt.select("_h", "_c", "_key", "_of", "_part", "_cell").join(texts.select("_h", "_line"), "_h")

    def run(table: pa.Table) -> pa.Table:
        cell_ = table.column("_cell")[0].as_py()
        rows_ = [(h, c, of, p, shingles(x)) for h, c, of, p, x in zip(*(table.column(k).to_pylist() for k in ("_h", "_c", "_of", "_part", "_line")), strict=True)]
        left = [r for r in rows_ if not r[2] and r[3] == cell_["i"]]
        right = [r for r in rows_ if (r[2] if cell_["large"] else not r[2] and r[3] == cell_["j"])]
        once = not cell_["large"] and cell_["i"] == cell_["j"]
        found = [(x[0], y[0]) for x in left for y in right if x[1] != y[1] and not (once and x[0] <= y[0]) and alike(x[4], y[4], threshold)]
        return pa.table([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    return saved(dealt.groupBy("_key", "_cell").applyInArrow(run, "a long, b long").distinct(), "line-links")


def _linked(members: DataFrame, links: list[DataFrame]) -> DataFrame:
    """``_h``, ``_key``, ``_met`` and component ``_c`` of the buckets that hold several components."""
    placed = members.join(components(reduce(DataFrame.unionByName, links)).withColumnRenamed("node", "_h"), "_h", "left")
    placed = placed.select("_h", "_key", "_met", F.coalesce("root", "_h").alias("_c"))
    apart = placed.groupBy("_key").agg(F.min("_c").alias("_lo"), F.max("_c").alias("_hi")).filter("_lo <> _hi")
    return placed.join(apart.select("_key"), "_key")


def classes(docs: DataFrame, occ: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Nodes (``_h``, ``_place``: first place, ``_copies``: its places) and, of every node alike to
    another that isn't its component's root, the root (``_h``, ``_root``)."""
    nodes = saved(occ.groupBy("_h").agg(F.min(_place()).alias("_place"), F.count(F.lit(1)).alias("_copies")), "line-nodes")
    rows = occ.select("_h", F.explode("_keys").alias("_key"))
    buckets = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min("_h").alias("a"), F.max("_h").alias("b")).filter("a <> b")
    buckets = saved(buckets, "line-buckets")
    # Two lines in a bucket are a pair already; only larger buckets need their members.
    pairs = buckets.filter("_n = 2").select("a", "b").distinct()
    large = _few(saved(buckets.filter("_n > 2").select("_key", "_n"), "line-buckets"))
    members = saved(rows.join(large, "_key").distinct(), "line-members")
    met = members.groupBy("_h").agg(F.sum("_n").alias("_met"))
    whole = saved(members.join(met, "_h").select("_h", "_key", "_met"), "line-members")
    discard(members)
    wanted = pairs.select(F.col("a").alias("_h")).union(pairs.select("b")).union(whole.select("_h")).distinct()
    wanted = saved(wanted, "line-wanted")
    texts = lines_of(docs, text, doc_id).select("_h", "_line").join(_few(wanted), "_h", "left_semi").groupBy("_h").agg(F.first("_line").alias("_line"))
    texts = saved(texts, "line-texts")
    discard(wanted)
    apart, links, tried = whole, [], None
    for _ in range(CENTRES):
        # each node against the node of each of its buckets that meets most others
        at = [c for c in ("_c",) if c in apart.columns]
        centre = apart.groupBy("_key").agg(F.max(F.struct("_met", "_h", *at)).alias("_x"))
        near = apart.join(centre, "_key").filter("_h <> _x._h" + (" AND _c <> _x._c" if at else ""))
        near = near.select(F.least("_h", "_x._h").alias("a"), F.greatest("_h", "_x._h").alias("b"))
        near = near.union(pairs).distinct() if tried is None else near.distinct().join(tried, ["a", "b"], "left_anti")
        near = saved(near, "line-pairs")
        links.append(_verified(near, texts, threshold))
        tried = near if tried is None else tried.unionByName(near)
        apart = saved(_linked(whole, links), "line-apart")
    links.append(_bucket_links(apart, texts, threshold))
    found = components(reduce(DataFrame.unionByName, links)).select(F.col("node").alias("_h"), F.col("root").alias("_root"))
    discard(texts, whole, apart, tried, buckets)
    return nodes, found


def places(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD, only_classes: bool = False) -> DataFrame:
    """Every line that takes part: ``_d``, ``_r``, ``_no``, ``class_id`` (root of its
    component, a line hash) and ``kept``.  ``only_classes`` leaves out lines that are
    their class's only place."""
    occ = occurrences(docs, text, doc_id)
    nodes, found = classes(docs, occ, text, doc_id, threshold)
    named = nodes.join(found, "_h", "left").select("_h", "_place", "_copies", F.coalesce("_root", "_h").alias("_root"))
    firsts = named.groupBy("_root").agg(F.min("_place").alias("_first"), F.sum("_copies").alias("_places"))
    known = named.join(firsts if not only_classes else firsts.filter("_places > 1"), "_root").select("_h", "_root", "_first")
    known = saved(known, "line-named")
    rows = occ.select("_h", "_d", "_r", "_no").join(known, "_h")
    rows = saved(rows.select("_d", "_r", "_no", F.col("_root").alias("class_id"), (_place() == F.col("_first")).alias("kept")), "line-places")
    discard(occ, nodes, known)
    return rows


def _gone(found: DataFrame) -> DataFrame:
    """The dropped lines of each document: ``_d``, ``_r``, ``_gone`` (line number and class, in order)."""
    lines = found.filter("NOT kept").groupBy("_d", "_r").agg(F.collect_set(F.struct(F.col("_no").alias("line_no"), "class_id")).alias("_gone"))
    return lines.withColumn("_gone", F.array_sort("_gone"))


def _same(a: str, b: str) -> Column:
    return (F.col(f"{a}._r") == F.col(f"{b}._r")) & F.col(f"{a}._d").eqNullSafe(F.col(f"{b}._d"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n_chars: str | None = "n_chars",
                threshold: float = THRESHOLD) -> DataFrame:
    """The documents without their dropped lines.

    ``n_chars``, if named, is set to the new length; untouched texts stay byte for byte.
    Of repeated rows with a line that takes part, one stays."""
    gone = saved(_gone(places(docs, text, doc_id, threshold, only_classes=True)), "line-gone")
    rows = tucked(docs, F.col(doc_id).alias("_d"), F.xxhash64(whole_text(text)).alias("_r"), F.col(text).alias("_t"))
    again = rows.groupBy("_d", "_r").agg(F.count(F.lit(1)).alias("_m")).filter("_m > 1")
    again = saved(again.select("_d", "_r"), "line-repeated")
    if not again.isEmpty():
        same = _same("x", "y")
        taking = whole_text("_t").rlike(r"\S")
        one = rows.alias("x").join(again.alias("y"), same, "left_semi")
        rows = (rows.alias("x").join(again.alias("y"), same, "left_anti")
                .unionByName(one.filter(~taking)).unionByName(one.filter(taking).dropDuplicates(["_d", "_r"])))
    rows = rows.alias("x").join(gone.alias("y"), _same("x", "y"), "left").select("x.*", F.transform("y._gone", lambda g: g["line_no"]).alias("_gone"))
    left = F.filter(F.split(whole_text("_t"), "\n"), lambda x, i: ~F.array_contains("_gone", i))
    rows = rows.withColumn("_kept", F.array_join(left, "\n"))
    rows = rows.filter(F.col("_gone").isNull() | F.col("_kept").rlike(r"[\p{L}\p{N}]"))
    new = {text: F.when(F.col("_gone").isNull(), F.col("_t")).otherwise(F.col("_kept"))}
    if n_chars and n_chars in docs.columns:
        own = F.col(f"_c{docs.columns.index(n_chars)}")
        new[n_chars] = F.when(F.col("_gone").isNull(), own).otherwise(F.length("_kept")).cast(docs.schema[n_chars].dataType)
    return rows.select(*untucked(docs.columns, new))


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: how many of its lines take part and stay, and number and class of those that go."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    lines = F.filter(F.split(whole_text(), "\n"), lambda x: normal(x).rlike(r"\S"))
    rows = docs.select(F.col("doc_id").alias("_d"), F.xxhash64(whole_text()).alias("_r"), F.size(lines).cast("long").alias("_n"))
    counted = rows.groupBy("_d", "_r").agg(F.count(F.lit(1)).alias("_m"), F.first("_n").alias("_n"))
    counted = saved(counted, "line-documents")
    found = places(docs, only_classes=True)
    none = F.array().cast("array<struct<line_no:int,class_id:bigint>>")
    # Rows after the first of equal ones lose every line; all their lines are in a class of several places.
    again = counted.filter("_m > 1").select("_d", "_r")
    every = found.alias("x").join(again.alias("y"), _same("x", "y"), "left_semi").groupBy("_d", "_r").agg(
        F.collect_set(F.struct(F.col("_no").alias("line_no"), "class_id")).alias("_all"))
    out = counted.alias("x").join(_gone(found).alias("y"), _same("x", "y"), "left").select("x.*", "_gone")
    out = out.alias("x").join(every.alias("y"), _same("x", "y"), "left").select("x.*", F.array_sort("_all").alias("_all"))
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_m")))
    dropped = F.coalesce(F.when(F.col("_copy") > 1, F.col("_all")).otherwise(F.col("_gone")), none)
    return out.select(F.col("_d").alias("doc_id"), F.col("_n").alias("n_lines"), (F.col("_n") - F.size(dropped)).alias("n_kept"), dropped.alias("dropped"))
