"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut the bytes of a blank and the text.  Interval coalescing: the
tokens of both, as byte ranges, are sorted by start; with the running maximum of
their ends, a group breaks where a start reaches it, so groups are the finest
ranges that both tokenizers share.  Within a group every A token is linked to
every B token.  One pass of array operations does this for a block of documents.

How many documents link a pair of ids is counted over the whole corpus: a block
sends its distinct pairs with their number of documents, Spark adds them up, finds
the best count of each A id, and returns to every block the counts of its own
pairs.  So a pair is shuffled once a block, not once a document, and a document's
links are summed where its block is; nothing is broadcast but the two vocabularies.

A block is bounded by ``BLOCK_BYTES`` of text (a longer text is a block of its own) and
``BLOCK_DOCS``; links are expanded ``LINKS`` at a time and merged by pair at once.

Defined cases: texts that are null, empty, or whose tokens' bytes aren't the blank
and the text have no tokens; repeated rows are documents of their own, in the
counts too; null ids stay null; strings of special tokens are plain text; a very
long text is encoded whole; an empty table gives no rows; extra columns pass
through, except for the text and columns named like an output.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpipe.llm.common import read_table, saved, tucked, untucked, workers_import

BLOCK_BYTES = 1 << 21
BLOCK_DOCS = 512
LINKS = 1 << 22

# The pattern of byte-level pre-tokenizers, a fixed value, and the characters beyond those whose
# classes are the same in every engine's version.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ODD = re.compile("[^\\x00-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")


def _byte_level() -> dict[str, int]:
    """The byte for each character of a byte-level vocabulary: printable ones stand for
    themselves, the others for the characters from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers and the bytes of every id, made from the files' contents."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        chars = _byte_level()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.lengths = [np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes)]
        # Every id as text, followed by the sign after it: a token of its side, or the last one.
        self.written = np.array([f"{i}{sign}" for n, signs in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for sign in signs for i in range(n)], object)

        self.ranked = _ranked(a_json, self.a_bytes)

    def _encode_a(self, text: str) -> list[int]:
        if self.ranked is not None and not _ODD.search(text):
            return self.ranked.encode_ordinary(text)
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both tokenizers; none where the bytes of either aren't the blank and the text."""
        whole = [" " + t for t in texts]
        a = [self._encode_a(t) for t in whole]
        b = self.b.encode(texts, num_threads=1)
        for i, text in enumerate(whole):
            data = text.encode(errors="surrogatepass")
            if not texts[i] or b"".join(map(self.a_bytes.__getitem__, a[i])) != data or b"".join(map(self.b_bytes.__getitem__, b[i])) != data:
                a[i], b[i] = [], []
        return a, b


def _ranked(a_json: str, table: list[bytes]):
    """The same tokenizer as an encoder by ranks, several times faster as it makes ids only; None
    where the file isn't a plain byte-level BPE whose merges are its vocabulary in order."""
    import tiktoken

    read = json.loads(a_json)
    model, cut = read["model"], read.get("pre_tokenizer") or {}
    special = {t["id"] for t in read.get("added_tokens", ())}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", ())]
    plain = (read.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
    if not plain or any(model["vocab"].get("".join(m)) != 256 + i for i, m in enumerate(pairs)):
        return None
    ranks = {x: i for i, x in enumerate(table) if i not in special}
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group of every interval: groups break where a start reaches the running maximum of ends."""
    order = np.lexsort((starts,))
    reached = np.maximum.accumulate(ends[order])
    group = np.zeros(len(starts), np.int64)
    group[order[1:]] = np.cumsum(starts[order[1:]] >= reached[:-1])
    return group


class Block:
    """The alignment of a block of documents, as arrays."""

    def __init__(self, tok: Tokenizers, texts: list[str | None]):
        self.tok, n = tok, len(texts)
        a, b = tok.encode([t or "" for t in texts])
        self.sizes = [np.array([len(x) for x in side], np.int64) for side in (a, b)]
        self.ids = [np.fromiter(chain.from_iterable(side), np.int64, int(n.sum())) for side, n in zip((a, b), self.sizes, strict=True)]
        self.docs = [np.repeat(np.arange(n), s) for s in self.sizes]
        ends = [np.cumsum(length[ids]) for length, ids in zip(tok.lengths, self.ids, strict=True)]
        starts = [e - length[ids] for e, length, ids in zip(ends, tok.lengths, self.ids, strict=True)]
        group = coalesce(np.concatenate(starts), np.concatenate(ends))
        self.group = [group[:len(self.ids[0])], group[len(self.ids[0]):]]
        self.n_groups = int(group.max(initial=-1)) + 1
        self.members = [np.bincount(g, minlength=self.n_groups) for g in self.group]
        doc_of = np.zeros(self.n_groups, np.int64)
        doc_of[self.group[0]] = self.docs[0]
        self.groups = np.bincount(doc_of, minlength=n)
        self.links = np.bincount(doc_of, self.members[0] * self.members[1], n).astype(np.int64)
        self.doc_of = doc_of

    def written(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every document."""
        last = [np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in self.group]
        na, nb = len(self.tok.a_bytes), len(self.tok.b_bytes)
        at = np.concatenate([self.ids[0] + na * last[0], 2 * na + self.ids[1] + nb * last[1]])
        order = np.argsort(np.concatenate(self.group), kind="stable")
        parts = self.tok.written[at[order]].tolist()
        ends = np.cumsum(self.sizes[0] + self.sizes[1]).tolist()
        return ["".join(parts[lo:hi])[:-1] for lo, hi in zip([0, *ends], ends, strict=False)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (document, pair code) in order, and the links of each."""
        nb = len(self.tok.b_bytes)
        space = len(self.tok.a_bytes) * nb
        first_b = np.cumsum(self.members[1]) - self.members[1]
        width = self.members[1][self.group[0]]  # links of each A token
        upto = np.cumsum(width)
        keys, times = np.empty(0, np.int64), np.empty(0, np.int64)
        lo = 0
        while lo < len(width):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + LINKS, "right")))
            w = width[lo:hi]
            start = np.cumsum(w) - w
            b = np.repeat(first_b[self.group[0][lo:hi]] - start, w) + np.arange(int(w.sum()))
            code = np.repeat(self.docs[0][lo:hi] * space + self.ids[0][lo:hi] * nb, w) + self.ids[1][b]
            found, n = np.unique(code, return_counts=True)
            if len(keys):
                found, back = np.unique(np.concatenate([keys, found]), return_inverse=True)
                n = np.bincount(back, np.concatenate([times, n])).astype(np.int64)
            keys, times, lo = found, n, hi
        return keys // space, keys % space, times


_held: dict[tuple, Tokenizers] = {}


def _tokenizers(shared) -> Tokenizers:
    """One copy a worker process, kept from task to task."""
    if shared.value not in _held:
        _held.clear()
        _held[shared.value] = Tokenizers(*shared.value)
    return _held[shared.value]


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and (size + len(t or "") > BLOCK_BYTES or i - lo == BLOCK_DOCS):
            yield lo, i
            lo, size = i, 0
        size += len(t or "")
    if lo < len(texts):
        yield lo, len(texts)


def load(path_a: str, path_b: str) -> tuple[str, bytes]:
    """The contents of both tokenizer files."""
    return Path(path_a).read_text("utf-8"), Path(path_b).read_bytes()


def groups_of(docs: DataFrame, files: tuple[str, bytes], text: str = "text") -> DataFrame:
    """The rows with ``groups``: the A ids and B ids of each group of the whole text, in order."""
    workers_import(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(files)
    names = [c for c in docs.columns if c != "groups"]
    kind = T.ArrayType(T.StructType([T.StructField("a", T.ArrayType(T.IntegerType())), T.StructField("b", T.ArrayType(T.IntegerType()))]))
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("groups", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizers(shared)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for lo, hi in _blocks(texts):
                block = Block(tok, texts[lo:hi])
                sides = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(m)), pa.int32()), pa.array(ids, pa.int32()))
                         for m, ids in zip(block.members, block.ids, strict=True)]
                every = pa.StructArray.from_arrays(sides, ["a", "b"])
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(block.groups)), pa.int32()), every)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in names), lists], names=[*names, "groups"])

    return docs.select(names).mapInArrow(run, schema)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_ADDED = T.StructType([*[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("groups_sha256", T.StringType())])


def _aligned(rows: DataFrame, files: tuple[str, bytes]) -> DataFrame:
    """One row a document with its links by pair (``_ab``, ``_n``), and in the first row of each
    block the block's pairs with their number of documents (``_every``, ``_docs``)."""
    workers_import(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(files)
    rest = [c for c in rows.columns if c != "_text"]
    longs = T.ArrayType(T.LongType())
    new = [T.StructField("_block", T.LongType()), *_ADDED.fields, *[T.StructField(c, longs) for c in ("_ab", "_n", "_every", "_docs")]]
    schema = T.StructType([rows.schema[c] for c in rest] + new)

    def lists(sizes: np.ndarray, values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, number = _tokenizers(shared), TaskContext.get().partitionId() << 36
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for lo, hi in _blocks(texts):
                block, n = Block(tok, texts[lo:hi]), hi - lo
                doc, ab, times = block.pairs()
                every, docs = np.unique(ab, return_counts=True)
                digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in block.written()]
                first = np.zeros(n, np.int64)
                first[0] = len(every)
                sizes = np.bincount(doc, minlength=n)
                made = [pa.array(np.full(n, number), pa.int64()), *(pa.array(x, pa.int64()) for x in (*block.sizes, block.groups, block.links)),
                        pa.array(digests, pa.string()), lists(sizes, ab), lists(sizes, times), lists(first, every), lists(first, docs)]
                number += 1
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, n) for c in rest), *made], names=schema.names)

    return rows.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """``_p`` (pair code), ``c`` (documents that hold it linked) and ``best`` (the highest of its A id)."""
    sent = aligned.select(F.explode(F.arrays_zip("_every", "_docs")).alias("x")).select(F.col("x._every").alias("_p"), F.col("x._docs").alias("n"))
    counts = saved(sent.groupBy("_p").agg(F.sum("n").alias("c")), "alignment-counts")
    top = counts.groupBy(F.expr(f"_p div {n_b}").alias("_a")).agg(F.max("c").alias("top"))
    return counts.withColumn("_a", F.expr(f"_p div {n_b}")).join(top, "_a").select("_p", "c", (F.col("c") == F.col("top")).alias("best"))


def align(docs: DataFrame, files: tuple[str, bytes], text: str = "text") -> DataFrame:
    """The rows without their texts, with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups_sha256``."""
    outputs = (*_ADDED.names, "n_best", "count_sum")
    names = [c for c in docs.columns if c not in (text, *outputs)]
    rows = tucked(docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias("_text")), F.col("_text")).drop(f"_c{len(names)}")
    rows = saved(_aligned(rows, files), "alignment-rows")
    n_b = len(Tokenizers(*files).b_bytes)
    asked = rows.select(F.col("_block").alias("_asker"), F.explode("_every").alias("_p"))
    told = asked.join(pair_counts(rows, n_b), "_p")
    own = rows.drop("_every", "_docs")
    rest = [f"_c{i}" for i in range(len(names))]
    schema = T.StructType([own.schema[c] for c in rest] + _ADDED.fields + [T.StructField(c, T.LongType()) for c in outputs[-2:]])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        code, c, best = (right.column(x).to_numpy() for x in ("_p", "c", "best"))
        order = np.argsort(code)
        ab, n = (left.column(x).combine_chunks() for x in ("_ab", "_n"))
        sizes = np.diff(ab.offsets.to_numpy())
        at = order[np.searchsorted(code[order], ab.flatten().to_numpy())] if len(code) else np.zeros(0, np.int64)
        doc, times = np.repeat(np.arange(left.num_rows), sizes), n.flatten().to_numpy()
        sums = [np.zeros(left.num_rows, np.int64) for _ in range(2)]
        np.add.at(sums[0], doc, times * best[at])
        np.add.at(sums[1], doc, times * c[at])
        return pa.table([*(left.column(x) for x in (*rest, *_ADDED.names)), *map(pa.array, sums)], names=schema.names)

    found = own.groupBy("_block").cogroup(told.groupBy("_asker")).applyInArrow(run, schema)
    return found.select(*untucked(names), *outputs)


def op12_token_alignment(spark, sf_dir: str, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Both tokenizers' tokens of every whole text of ``documents``, aligned and counted."""
    import public_tokenizers

    files = load(path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model"))
    return align(read_table(spark, sf_dir, "documents", "doc_id", "text"), files)
