"""Removal of repeated byte strings by hash-compared suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts at
another place, in the same text or another.

1. Anchors: of the ``GRAM``-byte strings inside a window of ``LENGTH`` bytes the
   one with the smallest hash, the leftmost of equals, is the window's anchor.
   Equal windows have equal anchors at equal offsets, so windows need comparing
   only where their anchors agree.  Neighbouring windows share an anchor: a text
   becomes a row for each run of them, about one row per 85 bytes, with hashes
   of the anchor and of the run's bytes (its context).
2. Rows are merged by anchor and context first, on the map side, so a passage that stands
   in a third of all texts is one row.  Anchors that occur once are done.  A context
   that occurs twice repeats as a whole.  Where an anchor has several contexts, and one of them occurs
   once, one copy of each context is fetched from its text.
3. Suffix sort: in a task, the suffixes at the window starts of many anchors are
   sorted, by anchor and offset, with a merge sort whose comparisons find the
   common extension of two suffixes by binary search over prefix polynomial
   hashes (eight steps for 200 bytes) where their first eight bytes agree, then look at
   one byte.  Neighbours that
   agree over the whole length are repeats; their bytes are compared to rule out
   hash collisions.  The merges run on arrays, a level at a time for all classes.
4. Anchors with more than ``CONTEXTS`` contexts would make large groups; their
   windows are counted instead by two independent 64-bit hashes in an ordinary
   aggregation, which spreads them over all tasks.
5. The repeated windows go back to their texts, which drop the bytes they cover.

All counts are aggregated on the map side; joins are on hashes and documents.
The texts are shuffled by document; both joins with them use the same exchange.

Defined cases: null text is read as empty and keeps no bytes; texts shorter than
``LENGTH`` lose nothing; rows that repeat in full are places of their own; a null
id is one more id; extra columns pass through ``without_repeats``; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpipe.llm.common import NO_ID, discard, read_table, saved, whole_text, workers_import
from clickpipe.llm.rolling import mix, prefix, ranges

LENGTH = 200
GRAM = 32
#: Contexts of an anchor that one task sorts together, 5 MB at most.
CONTEXTS = 16_384
#: Bytes of a text that are looked at at a time, and of contexts that are sorted at a time.
PIECE = 1 << 20
BATCH = 1 << 21

_GOLD = 0x9E3779B97F4A7C15
_OCCURRENCE = "_a long, _c long, _d long, _r long, _at int, _n int, _off int"


def _times(x: np.ndarray, k: int) -> np.ndarray:
    return x.astype(np.uint64) * np.uint64(_GOLD * k % (1 << 64))


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> list[tuple[np.ndarray, ...]]:
    """Runs of windows with one anchor: its hash, the context's hash, the first
    window's start, the number of windows and the anchor's offset in the context."""
    out = []
    for start in range(0, len(data) - length + 1, PIECE - length):
        piece = data[start:start + PIECE - 1]
        sums = prefix(piece)
        n = len(piece) - gram + 1
        hashes = mix(ranges(sums, np.arange(n), np.arange(gram, n + gram)))
        least = (hashes & ~np.uint64(PIECE - 1)) | np.arange(n, dtype=np.uint64)  # equal hashes: the leftmost
        width, span = length - gram + 1, 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
        at = (least & np.uint64(PIECE - 1)).astype(np.int64)  # the anchor of each window
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        count = np.diff(np.concatenate([first, [len(at)]]))
        off = at[first] - first
        context = mix(ranges(sums, first, first + count + length - 1) + _times(off, 3) + _times(count, 5))
        out.append((hashes[at[first]].view(np.int64), context.view(np.int64), first + start, count, off))
    return out


def _occurrences(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for d, r, text in zip(batch.column("_d").to_pylist(), batch.column("_r").to_pylist(), batch.column("_t"), strict=True):
                for a, c, at, n, off in anchors(np.frombuffer(text.as_buffer() or b"", np.uint8), length):
                    made.append((a, c, np.full(len(a), d), np.full(len(a), r), at.astype(np.int32), n.astype(np.int32), off.astype(np.int32)))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*made, strict=True)],
                                                 names=["_a", "_c", "_d", "_r", "_at", "_n", "_off"])

    return docs.mapInArrow(run, _OCCURRENCE)


class Suffixes:
    """Suffixes of a buffer, compared over at most ``length`` bytes by prefix hashes."""

    def __init__(self, data: np.ndarray, length: int):
        self.length = length
        self.sums = prefix(data)
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        self.words = np.lib.stride_tricks.as_strided(self.data.view(np.uint8)[:8].view(np.uint64), (len(data) + 1,), (1,))

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes x and y, by binary search."""
        same = np.zeros(len(x), np.int64)
        whole = ranges(self.sums, x, x + self.length) == ranges(self.sums, y, y + self.length)
        same[whole] = self.length
        rest = np.flatnonzero(~whole)
        x, y, found = x[rest], y[rest], np.zeros(len(rest), np.int64)
        step = 1 << (self.length.bit_length() - 1)
        while step:
            to = found + step
            fits = to <= self.length
            to = np.where(fits, to, found)
            fits &= ranges(self.sums, x, x + to) == ranges(self.sums, y, y + to)
            found = np.where(fits, to, found)
            step >>= 1
        same[rest] = found
        return same

    def before(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix x sorts before y (or is equal over the length, where that counts)."""
        a, b = self.words[x].byteswap(), self.words[y].byteswap()  # the first eight bytes decide most cases
        less = a < b
        tie = np.flatnonzero(a == b)
        x, y = x[tie], y[tie]
        same = self.extension(x, y)
        whole = same == self.length
        at = np.where(whole, 0, same)
        less[tie] = np.where(whole, or_equal[tie], self.data[x + at] < self.data[y + at])
        return less

    def equal_bytes(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Byte for byte equality over the length."""
        same = np.ones(len(x), bool)
        for k in [*range(0, self.length - 7, 8), self.length - 8]:
            same &= self.words[x + k] == self.words[y + k]
        return same

    def sort(self, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes by group and content: bottom-up merge sort, all groups at a level together."""
        order = np.argsort(group, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0]))
        size = np.diff(np.concatenate([first, [len(group)]]))
        base, size = np.repeat(first, size), np.repeat(size, size)
        inside = np.arange(len(order)) - base
        width = 1
        while width < (size.max() if len(size) else 0):
            run = inside // width
            other = (run ^ 1) * width
            low, high = np.zeros(len(order), np.int64), np.clip(size - other, 0, width)
            right = run % 2 == 1
            going = np.flatnonzero(low < high)
            while len(going):  # rank of each suffix in the run that its own is merged with
                mid = (low[going] + high[going]) // 2
                there = order[base[going] + other[going] + mid]
                # of equals the left run's come first
                less = self.before(start[there], start[order[going]], right[going])
                low[going] = np.where(less, mid + 1, low[going])
                high[going] = np.where(less, high[going], mid)
                going = going[low[going] < high[going]]
            to = base + (run // 2) * 2 * width + inside % width + low
            merged = np.empty_like(order)
            merged[to] = order
            order = merged
            width *= 2
        return order


def repeated_windows(contexts: list[bytes], anchor: np.ndarray, offset: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each context, which of its windows occur in another one of its anchor."""
    data = np.frombuffer(b"".join(contexts), np.uint8)
    windows = np.array([len(x) for x in contexts]) - length + 1
    owner = np.repeat(np.arange(len(contexts)), windows)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    begin = np.cumsum([0, *(len(x) for x in contexts[:-1])])
    start = begin[owner] + inside
    _, number = np.unique(anchor, return_inverse=True)
    group = number[owner] * length + offset[owner] - inside  # the anchor's offset in a window is below its length
    _, kind, many = np.unique(group, return_inverse=True, return_counts=True)
    some = np.flatnonzero(many[kind] > 1)
    found = np.zeros(len(owner), bool)
    if len(some):
        suffixes = Suffixes(data, length)
        order = some[suffixes.sort(start[some], kind[some])]
        x, y = order[:-1], order[1:]
        near = np.flatnonzero(kind[x] == kind[y])
        x, y = x[near], y[near]
        equal = suffixes.extension(start[x], start[y]) == length
        x, y = x[equal], y[equal]
        equal = suffixes.equal_bytes(start[x], start[y])
        found[x[equal]] = found[y[equal]] = True
    return np.split(found, np.cumsum(windows)[:-1])


def _runs(flags: np.ndarray) -> list[int]:
    """Starts and ends of the runs of true flags, one after another."""
    return np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))).tolist()


def _sorted_contexts(contexts: DataFrame, length: int) -> DataFrame:
    """``_a``, ``_c`` and ``_w`` (starts and ends of runs of repeated windows)."""
    dealt = contexts.repartition("_a").sortWithinPartitions("_a")

    def work(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        a, c, off, data = zip(*rows, strict=True)
        flags = repeated_windows(list(data), np.array(a), np.array(off), length)
        some = [i for i, x in enumerate(flags) if x.any()]
        return pa.RecordBatch.from_arrays([pa.array([a[i] for i in some], pa.int64()), pa.array([c[i] for i in some], pa.int64()),
                                           pa.array([_runs(flags[i]) for i in some], pa.list_(pa.int32()))], names=["_a", "_c", "_w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0  # whole anchors, and the last one, which may go on
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("_a", "_c", "_off", "_b")), strict=True):
                if held and size >= BATCH and row[0] != held[-1][0]:
                    yield work(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield work(held)

    return dealt.select("_a", "_c", "_off", "_b").mapInArrow(run, "_a long, _c long, _w array<int>")


def _counted_contexts(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with many contexts, by an aggregation over windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, c, off, data in zip(*(batch.column(x).to_pylist() for x in ("_a", "_c", "_off", "_b")), strict=True):
                data = np.frombuffer(data, np.uint8)
                at = np.arange(len(data) - length + 1)
                one = ranges(prefix(data), at, at + length)
                two = ranges(prefix(data ^ np.uint8(0xA5)), at, at + length)
                n = len(at)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, a)), pa.array(np.full(n, c)), pa.array(at.astype(np.int32)),
                                                  pa.array(mix(one + _times(off - at, 7)).view(np.int64)), pa.array(mix(two).view(np.int64))],
                                                 names=["_a", "_c", "_j", "_x", "_y"])

    rows = saved(contexts.select("_a", "_c", "_off", "_b").mapInArrow(run, "_a long, _c long, _j int, _x long, _y long"), "suffix-windows")
    twice = rows.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").drop("_k")
    return (rows.join(twice, ["_x", "_y"]).groupBy("_a", "_c").agg(F.collect_set("_j").alias("_s"))
            .select("_a", "_c", F.flatten(F.transform("_s", lambda j: F.array(j, j + 1))).alias("_w")))


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("_d"), F.xxhash64(whole_text(text)).alias("_r"),
                       whole_text(text).alias("_t"))


def repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """``_d``, ``_r`` (a document's key) and ``_spans`` (runs of starts of repeated
    windows: first, end) of every document that has some."""
    workers_import(docs.sparkSession)
    keyed = _keyed(docs, text, doc_id)
    all_ = saved(_occurrences(keyed, length), "suffix-anchors")
    # A hot anchor's occurrences are merged by context on the map side; joins are on contexts, not on them.
    contexts = all_.groupBy("_a", "_c").agg(F.count(F.lit(1)).alias("_k"), F.min(F.struct("_d", "_r", "_at", "_n", "_off")).alias("_x"))
    contexts = saved(contexts, "suffix-contexts")
    mixed = contexts.groupBy("_a").agg(F.count(F.lit(1)).alias("_m"), F.min("_k").alias("_least")).filter("_m > 1 AND _least = 1").drop("_least")
    wanted = (contexts.join(mixed, "_a").groupBy("_x._d", "_x._r")
              .agg(F.collect_list(F.struct("_a", "_c", "_m", "_x._at", "_x._n", "_x._off")).alias("_list")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text_, wanted_ in zip(batch.column("_t"), batch.column("_list"), strict=True):
                data = (text_.as_buffer() or pa.py_buffer(b"")).to_pybytes()
                items = wanted_.as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[c] for x in items], t) for c, t in (("_a", pa.int64()), ("_c", pa.int64()), ("_m", pa.int64()), ("_off", pa.int32()))]
                    + [pa.array([data[x["_at"]:x["_at"] + x["_n"] + length - 1] for x in items], pa.binary())], names=["_a", "_c", "_m", "_off", "_b"])

    fetched = keyed.join(wanted, ["_d", "_r"]).select("_t", "_list").mapInArrow(cut, "_a long, _c long, _m long, _off int, _b binary")
    fetched = saved(fetched, "suffix-fetched")
    found = (_sorted_contexts(fetched.filter(F.col("_m") <= CONTEXTS), length)
             .unionByName(_counted_contexts(fetched.filter(F.col("_m") > CONTEXTS), length)))
    whole = contexts.filter("_k > 1").select("_a", "_c", F.array(F.lit(0), F.col("_x._n")).alias("_w"))
    # a context that occurs twice is a repeat as a whole, whatever the sort says
    found = saved(found.join(contexts.filter("_k = 1").select("_a", "_c"), ["_a", "_c"], "left_semi").unionByName(whole), "suffix-found")
    spans = F.transform(F.sequence(F.lit(1), F.size("_w") - 1, F.lit(2)), lambda i: F.struct(
        (F.col("_at") + F.element_at("_w", i)).alias("first"), (F.col("_at") + F.element_at("_w", i + 1)).alias("end")))
    discard(contexts, fetched)
    return (all_.join(found, ["_a", "_c"]).select("_d", "_r", spans.alias("_s"))
            .groupBy("_d", "_r").agg(F.flatten(F.collect_list("_s")).alias("_spans")))


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """The documents with ``removed`` (maximal removed runs: first byte, end) and
    ``kept`` (the bytes that are left) in place of the text."""
    spans = repeats(docs, text, doc_id, length)
    rest = [c for c in docs.columns if c not in (text, "removed", "kept")]
    body = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(rest)], F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("_d"),
                       F.xxhash64(whole_text(text)).alias("_r"), whole_text(text).alias("_t"))
    own = [f"_c{i}" for i in range(len(rest))]
    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(own, rest, strict=True))
    schema += (", " if schema else "") + "removed array<struct<first:int,end:int>>, kept binary"
    kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text_, spans_ in zip(batch.column("_t"), batch.column("_spans"), strict=True):
                data = (text_.as_buffer() or pa.py_buffer(b"")).to_pybytes()
                runs: list[list[int]] = []
                for first, end in sorted((x["first"], x["end"] + length - 1) for x in spans_.as_py() or ()):
                    if runs and first <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([first, end])
                removed.append([{"first": a, "end": b} for a, b in runs])
                at = [0, *(x for run in runs for x in run), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(at[::2], at[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([*map(batch.column, own), pa.array(removed, kind), pa.array(kept, pa.binary())], names=[*own, "removed", "kept"])

    out = body.join(spans, ["_d", "_r"], "left").select(*own, "_t", "_spans").mapInArrow(drop, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(own, rest, strict=True)], "removed", "kept")


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes, removed runs and a digest of what is left of every document."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    found = without_repeats(docs.withColumn("n_bytes", F.octet_length(whole_text()).cast("long")))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["first"]).cast("long"))
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
