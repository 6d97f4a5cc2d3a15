"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut into pre-tokens by a pattern and each pre-token is encoded on
its own, without special tokens:

1. a minimal perfect hash (hash and displace: one displacement per bucket of
   about four keys, exactly as many slots as ranks) finds pre-tokens that are
   vocabulary entries as a whole; the stored bytes are compared, so a foreign
   pre-token never gets a rank;
2. the rest is merged byte by byte: a heap of (rank, position) over a doubly
   linked list of symbols, lowest rank first, leftmost first on equal ranks,
   O(n log n) for a pre-token of n bytes.

The tables are built once on the driver from a rank file (its path is a
parameter, its size is the vocabulary's) and broadcast.  Encoding is a narrow
map over the rows: no shuffle, no state that grows with the input.  Each
Python worker remembers the ids of at most ``MEMO`` short pre-tokens.

Defined cases: a null text is read as empty; an empty text has no ids and
decodes to no bytes; unknown ids raise; repeated rows and extra columns pass
through unchanged (``ids`` and ``decoded`` are appended, and an input column
of that name is replaced).
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpipe.llm.common import workers_import

MEMO = 1 << 19
#: Rows of a batch that are coded, and sent on, at a time.
SLICE = 512
MEMO_BYTES = 64
BUCKET_KEYS = 4


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PerfectHash:
    """Minimal perfect hash from the keys to ``0..n-1`` and the value of each key."""

    def __init__(self, table: dict[bytes, int]):
        n = self.n = len(table)
        self.buckets = max(1, n // BUCKET_KEYS)
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * n
        self.values = [-1] * n
        groups: list[list[bytes]] = [[] for _ in range(self.buckets)]
        hashed = {key: xxhash.xxh64_intdigest(key) for key in table}
        for key, h in hashed.items():
            groups[h % self.buckets].append(key)
        order = sorted((b for b in range(self.buckets) if groups[b]), key=lambda b: -len(groups[b]))
        taken = bytearray(n)
        free = iter(())
        for b in order:
            group = groups[b]
            if len(group) == 1:  # the smallest buckets come last: any free slot will do
                if not free.__length_hint__():
                    free = iter([s for s in range(n) if not taken[s]])
                slot = next(free)
                self.shift[b], slots = -slot - 1, [slot]
            else:
                steps = [(hashed[k] >> 20, (hashed[k] >> 41) | 1) for k in group]
                d = 0
                while True:
                    slots = []
                    for at, step in steps:
                        s = (at + d * step) % n
                        if taken[s] or s in slots:
                            break
                        slots.append(s)
                    else:
                        break
                    d += 1
                self.shift[b] = d
            for key, slot in zip(group, slots, strict=True):
                taken[slot] = 1
                self.keys[slot], self.values[slot] = key, table[key]

    def _slot(self, h: int, d: int) -> int:
        return ((h >> 20) + d * ((h >> 41) | 1)) % self.n

    def get(self, key: bytes) -> int:
        """The value of ``key``, or -1 for a key that is not in the table."""
        if not self.n:
            return -1
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.buckets]
        slot = -d - 1 if d < 0 else self._slot(h, d)
        return self.values[slot] if self.keys[slot] == key else -1


def merge_bytes(piece: bytes, rank_of) -> list[int]:
    """BPE merges of one pre-token by a heap over linked symbols.

    ``rank_of(bytes)`` gives a rank or None.  ``end[i]`` is the end of the
    symbol that starts at byte ``i``, which is also where the next one starts;
    it is 0 once the symbol is merged away.  ``start[e]`` is the start of the
    symbol that ends at ``e``.
    """
    n = len(piece)
    end, start = list(range(1, n + 1)), list(range(-1, n))
    bits = n.bit_length()
    low, push = (1 << bits) - 1, heapq.heappush
    # a heap entry is one integer: rank, then start, then end of the merged symbol
    heap = [((r << bits | i) << bits) + i + 2 for i in range(n - 1) if (r := rank_of(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        top = heapq.heappop(heap)
        stop, i = top & low, top >> bits & low
        j = end[i]
        if not j or j >= stop or end[j] != stop:
            continue  # one of the two symbols has changed since
        end[i], end[j], start[stop] = stop, 0, i
        if stop < n and (r := rank_of(piece[i:end[stop]])) is not None:
            push(heap, ((r << bits | i) << bits) + end[stop])
        if i and (r := rank_of(piece[start[i]:stop])) is not None:
            push(heap, ((r << bits | start[i]) << bits) + stop)
    ids, i = [], 0
    while i < n:
        if (r := rank_of(piece[i:end[i]])) is None:
            raise ValueError("the rank file lacks single bytes")
        ids.append(r)
        i = end[i]
    return ids


class Codec:
    """Encoder and decoder over one rank table; picklable, meant for broadcast."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.lookup = PerfectHash(ranks)
        self.ranks = ranks  # for the merges
        self.pattern = white_space_property(pattern)
        self.token = {r: b for b, r in ranks.items()}
        self._memo = None

    def __getstate__(self):
        return {**self.__dict__, "_memo": None}

    def piece_ids(self, piece: str) -> bytes:
        """Ids of one pre-token as packed 32-bit integers."""
        raw = piece.encode("utf-8")
        rank = self.lookup.get(raw)
        return array("i", (rank,) if rank >= 0 else merge_bytes(raw, self.ranks.get)).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        if self._memo is None:
            self._memo, self._split = _Memo(self.piece_ids), regex.compile(self.pattern).findall
        return np.frombuffer(b"".join(map(self._memo.__getitem__, self._split(text))), np.int32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, np.asarray(ids).tolist()))


class _Memo(dict):
    """Ids by pre-token, emptied when it holds ``MEMO`` entries."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, piece: str) -> bytes:
        ids = self.compute(piece)
        if len(piece) <= MEMO_BYTES:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = ids
        return ids


def white_space_property(pattern: str) -> str:
    """``\\s`` as the White_Space property: the ``regex`` module's own ``\\s``
    also takes the separators U+001C..U+001F, which the property leaves out."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


def make_codec(path: str, pattern: str) -> Codec:
    return Codec(load_ranks(path), pattern)


def _append(df: DataFrame, source: str, name: str, kind: T.DataType, make) -> DataFrame:
    rest = [c for c in df.columns if c != name]
    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE):
                batch = whole.slice(lo, SLICE)
                yield pa.RecordBatch.from_arrays([*map(batch.column, rest), make(batch.column(source))], names=[*rest, name])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, codec: Codec, text: str = "text") -> DataFrame:
    """Appends ``ids array<int>``: the token ids of every whole text."""
    workers_import(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(codec)

    def make(texts: pa.Array) -> pa.Array:
        found = [shared.value.encode(x.as_py()) for x in texts]
        ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *found])))

    return _append(df, text, "ids", T.ArrayType(T.IntegerType()), make)


def decode(df: DataFrame, codec: Codec, ids: str = "ids") -> DataFrame:
    """Appends ``decoded binary``: the bytes that the ids stand for (null ids: none)."""
    workers_import(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(codec)

    def make(lists: pa.Array) -> pa.Array:
        return pa.array([shared.value.decode(x.values.to_numpy(zero_copy_only=False) if x.is_valid else ()) for x in lists], pa.binary())

    return _append(df, ids, "decoded", T.BinaryType(), make)


def digests(df: DataFrame) -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` from ``ids`` and ``decoded``."""
    return (df.withColumn("n_tokens", F.size("ids").cast("long"))
            .withColumn("ids_sha256", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256))
            .withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("ids", "decoded"))


def op5_byte_bpe(spark, sf_dir: str, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded; digests of both."""
    import public_tokenizers

    codec = make_codec(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(decode(encode(docs, codec).drop("text"), codec))
