"""Personal data by bootstrapped contextual extraction.

1. Base rules (e-mail addresses, IPv4 addresses, payment cards, phone numbers with
   ``+``) find the seed entities of every whole text, in one linear scan.
2. Around every candidate identifier (a run of tokens with digits or ``@``) the
   words next to it give lexical patterns: two words before, two after, one on
   each side, or a word and a sign such as ``:`` or ``=`` before.  The plain words
   around a candidate fill the same slots and give the patterns' background.
3. Spark scores the graph of patterns and instances: a pattern's confidence is the
   trust of its distinct instances over all its distinct fillers, background
   included; an instance's trust is the noisy-or of its patterns.  Seeds have trust
   1, what a base rule matched and refused (a wrong check digit) has 0 for good
   (numbers of fewer than ``CARD_LEAST`` digits aren't refused cards).
   ``ROUNDS`` times, in whole millionths, so that no order of summing matters.
4. Candidates that a trusted pattern surrounds, that can be of its kind by their
   characters, and whose trust is high enough are found as well.

Copies of a text count once, as instances and background texts are distinct.
Edges are aggregated on the map side; patterns with fewer than ``SUPPORT`` instances
go before anything is joined.  Texts are read once: places, candidates and
context hashes of a row are written, and the rounds work on those.

Defined cases: null text is read as empty and has no span; a repeated row has its
own result; null ids stay null; a very long text is scanned whole, contexts reach
``WINDOW`` characters; ties of kinds go to the kind listed first; an empty table
gives no rows; extra columns pass through, except for ``text`` and columns named
like an output.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpipe.llm.common import read_table, saved, tucked, untucked, whole_text, workers_import

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 3
PATTERN_MIN = 600_000
TRUST_MIN = 700_000
ONE = 1_000_000
WINDOW = 400
LONGEST = 64
CARD_LEAST = 13
SEED, OPEN, REFUSED = 1, 0, -1

# The contract's rules.  Possessive, and anchored where a match can only start, so
# that no text is scanned more than a few times.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s|\Z")
_CORE = re.compile(r"[+(]?\w(?:.*\w)?", re.S)
_WORD = re.compile(r"[^\W\d_]+")
_CUE = re.compile(r"([^\W\d_]+)\s?([:=#>])[\s\"'(]*\Z")
_CUED = re.compile(r"([^\W\d_]+)\s?([:=#>])[\s\"'(]*[^\W\d_]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def _octet(part: str) -> bool:
    part = part.lstrip("0") or "0"
    return len(part) < 4 and int(part) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for at in _DOMAIN.finditer(text):
        if at.start() < last:
            continue
        lo = at.start()
        while lo > last and (text[lo - 1].isalnum() and text[lo - 1].isascii() or text[lo - 1] in "._%+-"):
            lo -= 1
        if lo < at.start():
            yield lo, at.end()
            last = at.end()


def base_spans(text: str) -> tuple[list[tuple], list[tuple]]:
    """(kind, start, end) of the base rules' entities, and of the matches they refuse."""
    good, bad = [(0, a, b) for a, b in _emails(text)], []
    for kind, rule in ((1, _IP), (2, _CARD), (3, _PHONE)):
        for m in rule.finditer(text):
            if kind == 1:
                ok = all(map(_octet, m.group().split(".")))
            else:
                d = _digits(m.group())
                ok = 16 <= len(d) <= 19 and luhn(d) if kind == 2 else 8 <= len(d) <= 15
                if kind == 2 and len(d) < CARD_LEAST:
                    continue  # a number, not a card that was refused
            (good if ok else bad).append((kind, m.start(), m.end()))
    return good, bad


def _could_be(value: str) -> list[int]:
    """The kinds that an open candidate's characters allow."""
    d = _digits(value)
    kinds = []
    if re.fullmatch(r"[^\s@]+@[^\s@]*\w", value):
        kinds.append(0)
    if re.fullmatch(r"[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}", value):
        kinds.append(1)
    if re.fullmatch(r"[0-9][0-9 ./_-]*[0-9]", value) and CARD_LEAST <= len(d) <= 19 and luhn(d):
        kinds.append(2)
    if re.fullmatch(r"[(]?[0-9][0-9 ().\-/]*[0-9]", value) and 7 <= len(d) <= 15:
        kinds.append(3)
    return kinds


def _key(*parts: str) -> int:
    return int.from_bytes(blake2b("\x1f".join(parts).encode(errors="replace"), digest_size=8).digest(), "little", signed=True)


def _slots(before: list[str], after: list[str]) -> list[int]:
    """Hashes of the word patterns of a slot between two lists of words."""
    out = []
    if len(before) > 1:
        out.append(_key("L", *before[-2:]))
    if len(after) > 1:
        out.append(_key("R", *after[:2]))
    if before and after:
        out.append(_key("M", before[-1], after[0]))
    return out


def _open_spans(text: str, taken: list[tuple]) -> Iterator[tuple[int, int]]:
    """Runs of tokens with a digit or ``@`` outside the taken spans, without the signs around them."""
    taken = sorted((a, b) for _, a, b in taken)
    floor = at = 0
    while m := _MARK.search(text, floor):
        i = m.start()
        while at < len(taken) and taken[at][1] <= i:
            at += 1
        if at < len(taken) and taken[at][0] <= i:
            floor = taken[at][1]
            continue
        stop = taken[at][0] if at < len(taken) else len(text)
        lo = max(floor, 1 + max(text.rfind(c, floor, i) for c in " \n\t\r"))
        hi = _SPACE.search(text, i, stop).start()
        while hi < stop and text[hi] == " " and _MARK.search(text, hi + 1, n := _SPACE.search(text, hi + 1, stop).start()):
            hi = n
        floor = max(hi, i + 1)
        if hi - lo <= 4 * LONGEST and (core := _CORE.search(text, lo, hi)) and 6 <= core.end() - core.start() <= LONGEST:
            yield core.start(), core.end()


def contexts(text: str) -> tuple[list[tuple], list[tuple], list[int]]:
    """Base spans, candidates (start, end, instance, kind, state, patterns) and background patterns."""
    good, bad = base_spans(text)
    rows = [(a, b, k, SEED) for k, a, b in good] + [(a, b, k, REFUSED) for k, a, b in bad if b - a > 5]
    rows += [(a, b, k, OPEN) for a, b in _open_spans(text, good + bad) for k in _could_be(text[a:b])]
    if not rows:
        return good, [], []
    found, background, held = [], set(), {}
    for a, b, kind, state in sorted(rows):
        if (a, b) not in held:
            left, right = text[max(0, a - WINDOW):a], text[b:b + WINDOW]
            if a > WINDOW:
                left = left[_SPACE.search(left).end():]
            before, after = ([w.lower() for w in _WORD.findall(s)] for s in (left, right))
            if b + WINDOW < len(text) and after and _WORD.fullmatch(right[-1]):
                after.pop()
            held[a, b] = _slots(before, after)
            if cue := _CUE.search(left[-LONGEST:]):
                held[a, b].append(_key("C", cue[1].lower(), cue[2]))
            for words in (before, after):
                for i in range(2, len(words) - 2):
                    background.update(_slots(words[i - 2:i], words[i + 1:i + 3]))
            for m in (*_CUED.finditer(left), *_CUED.finditer(right)):
                background.add(_key("C", m[1].lower(), m[2]))
        found.append((a, b, _key(KINDS[kind], text[a:b].lower()), kind, state, held[a, b]))
    return good, found, list(background)


_SPAN = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_CANDIDATE = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("inst", T.LongType()),
                           T.StructField("kind", T.IntegerType()), T.StructField("state", T.IntegerType()), T.StructField("pats", T.ArrayType(T.LongType()))])
_A_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
_A_CANDIDATE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("inst", pa.int64()), ("kind", pa.int32()), ("state", pa.int32()),
                                   ("pats", pa.list_(pa.int64()))]))


def _scanned(df: DataFrame) -> DataFrame:
    """``_row``, ``_base``, ``_cands``, ``_background`` and the text's hash in place of ``_text``."""
    workers_import(df.sparkSession)
    rest = [c for c in df.columns if c != "_text"]
    new = {"_row": T.LongType(), "_base": T.ArrayType(_SPAN), "_cands": T.ArrayType(_CANDIDATE), "_background": T.ArrayType(T.LongType())}
    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField(k, v) for k, v in new.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = [contexts(x.as_py()) for x in batch.column("_text")]
            made = [pa.array(range(row, row + len(out)), pa.int64()),
                    pa.array([[dict(zip(_SPAN.names, s, strict=True)) for s in r[0]] for r in out], _A_SPAN),
                    pa.array([[dict(zip(_CANDIDATE.names, s, strict=True)) for s in r[1]] for r in out], _A_CANDIDATE),
                    pa.array([r[2] for r in out], pa.list_(pa.int64()))]
            row += len(out)
            yield pa.RecordBatch.from_arrays([*map(batch.column, rest), *made], names=[*rest, *new])

    return df.mapInArrow(run, schema)


def _graph(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct edges (``pat``, ``kind``, ``inst``, ``state``) of the patterns with enough
    instances, and their number of background texts (``pat``, ``n_other``)."""
    edges = (rows.select(F.explode("_cands").alias("c")).select("c.inst", "c.kind", "c.state", F.explode("c.pats").alias("pat"))
             .groupBy("pat", "kind", "inst").agg(F.max("state").alias("state"), F.min("state").alias("_low")))
    edges = edges.select("pat", "kind", "inst", F.when(F.col("_low") < 0, F.col("_low")).otherwise(F.col("state")).alias("state"))
    edges = saved(edges, "pii-edges")
    often = edges.groupBy("pat", "kind").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= SUPPORT).select("pat", "kind")
    edges = saved(edges.join(often, ["pat", "kind"], "left_semi"), "pii-graph")
    other = (rows.select("_hash", F.explode("_background").alias("pat")).join(often.select("pat").distinct(), "pat", "left_semi")
             .distinct().groupBy("pat").agg(F.count(F.lit(1)).alias("n_other")))
    return edges, saved(other, "pii-background")


def bootstrap(edges: DataFrame, other: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Trusted patterns (``pat``, ``kind``, ``confidence``) and the trust of open instances
    (``inst``, ``kind``, ``trust``), in millionths, after some rounds over the graph."""
    trust = edges.filter("state = 0 AND false").select("inst", "kind", F.lit(0).cast("long").alias("trust"))
    for _ in range(rounds):
        known = F.when(F.col("state") == SEED, ONE).when(F.col("state") == REFUSED, 0).otherwise(F.coalesce("trust", F.lit(0)))
        sums = (edges.join(trust, ["inst", "kind"], "left").groupBy("pat", "kind")
                .agg(F.sum(known.cast("long")).alias("s"), F.count(F.lit(1)).alias("n")).filter(F.col("s") >= SUPPORT * ONE))
        score = F.expr("s div (n + coalesce(n_other, 0) + 1)")
        patterns = (sums.join(other, "pat", "left").select("pat", "kind", score.alias("confidence"))
                    .filter(F.col("confidence") >= PATTERN_MIN))
        patterns = saved(patterns, "pii-patterns")
        doubt = F.floor(F.log(F.greatest(F.lit(ONE) - F.col("confidence"), F.lit(1)) / ONE) * ONE).cast("long")
        trust = (edges.filter(F.col("state") == OPEN).join(patterns, ["pat", "kind"])
                 .groupBy("inst", "kind").agg(F.sum(doubt).alias("d"))
                 .select("inst", "kind", F.floor((1 - F.exp(F.col("d") / ONE)) * ONE).cast("long").alias("trust")))
        trust = saved(trust, "pii-trust")
    return patterns, trust


def find_identifiers(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows without their texts, with ``base`` and ``spans`` (all spans): arrays of
    (kind, start, end), kinds numbered as in ``KINDS``, code points, ends exclusive."""
    names = [c for c in docs.columns if c not in (text, "base", "spans")]
    rows = _scanned(tucked(docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias("__text")), whole_text("__text").alias("_text"),
                           F.xxhash64(whole_text("__text")).alias("_hash")).drop(f"_c{len(names)}"))
    rows = saved(rows, "pii-rows")
    patterns, trust = bootstrap(*_graph(rows))
    hits = (rows.select("_row", F.explode("_cands").alias("c")).filter(F.col("c.state") == OPEN)
            .select("_row", "c.start", "c.end", "c.kind", "c.inst", F.explode("c.pats").alias("pat"))
            .join(trust.filter(F.col("trust") >= TRUST_MIN), ["inst", "kind"]).join(patterns.select("pat", "kind"), ["pat", "kind"], "left_semi"))
    best = hits.groupBy("_row", "start", "end").agg(F.max(F.struct("trust", (-F.col("kind")).alias("k"))).alias("b"))
    added = best.select("_row", F.struct((-F.col("b.k")).cast("int").alias("kind"), "start", "end").alias("s"))
    added = added.groupBy("_row").agg(F.collect_set("s").alias("_added"))
    rows = rows.select(*[f"_c{i}" for i in range(len(names))], "_row", "_base").join(added, "_row", "left")
    every = F.array_sort(F.concat("_base", F.coalesce("_added", F.array().cast(T.ArrayType(_SPAN)))))
    return rows.select(*untucked(names), F.array_sort("_base").alias("base"), every.alias("spans"))


def as_text(spans: str) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def op13_pii_bootstrap(spark, sf_dir: str) -> DataFrame:
    """Counts and digest of the base entities, and all spans, of every whole text."""
    found = find_identifiers(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", *map(count, range(len(KINDS))), F.sha2(as_text("base"), 256).alias("base_sha256"), as_text("spans").alias("spans"))
