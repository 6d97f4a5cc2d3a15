"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: the sources, in code point order with null last, get the repeating
``weights``; together they share ``budget`` times the size of all documents.
No target is above ``most`` times its source's size; what a capped source
leaves is reshared by weight until none is above.  The loop runs over one row
per source; each round sends two numbers to the driver.

Selection: a document of size s and quality weight w draws the exponential key
``-ln(u) / w`` (u: a hash of the seed, the id and the text, so reruns agree).
A target holds ``floor(target / size of source)`` complete epochs, which take
every document, and a remainder: documents sorted by key within their source
are taken as long as their prefix sum of sizes comes nearer to the remainder,
so that whole documents are taken and a source ends within half a document of
its target.

The last document is the one of those left that is nearest in size to what is still
open, where that brings the source nearer to its target; all others follow the keys.

Prefix sums never gather a source in one task: the keys' leading bits number
buckets, sizes are added up per (source, bucket), and the bucket where the remainder
ends is cut again until it holds at most ``EDGE_ROWS`` rows; only that one is sorted.

Defined cases: null text has size 0; null sources form one source; size 0 is
taken 0 words; a source whose documents have no words gets target 0; an empty
table gives an empty mix; rows that repeat in full have equal keys, and of the
equal rows at the edge any may be the taken ones (the result is the same
multiset); extra columns pass through (``mix`` replaces those named
like its results).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpipe.llm.common import read_table, saved, tucked, untucked, whole_text

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2.0
#: A key's place key / (1 + key) in bits, how many of them a round adds, and the rows sorted at most
#: (more only where so many keys are equal).
KEY_BITS, DIGIT_BITS = 50, 10
EDGE_ROWS = 20_000
MADE = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    """Number of runs of anything but white space (space, tab to carriage return)."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def quality_weight(text: Column) -> Column:
    """Share of letters among the characters that aren't spaces, damped into (0.05, 1]."""
    solid = F.length(F.regexp_replace(text, r"\s+", ""))
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return F.lit(0.05) + F.lit(0.95) * (letters + 10.0) / (solid + 10.0)


def exponential_key(weight: Column, *identity: Column, seed: int) -> Column:
    """``-ln(u) / weight`` with u in (0, 1) from a 64-bit hash of the identity."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *identity), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / weight


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
            most: float = MOST) -> DataFrame:
    """One row per source: ``_source``, ``_source_size`` and ``_target``.

    ``sizes`` has one row per source, the pre-aggregated ``_source`` and
    ``_source_size``.
    """
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    rank = F.row_number().over(order) - 1
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % n + 1).cast("int"))
    table = saved(sizes.withColumn("_weight", weight).withColumn("_cap", F.col("_source_size") * float(most)), "mix-sources")
    level = None  # words for each unit of weight, of the sources that aren't capped
    while True:
        capped = F.lit(False) if level is None else F.col("_cap") <= F.col("_weight") * level
        at = table.agg(F.sum("_source_size").alias("all"), F.sum(F.when(capped, F.col("_cap"))).alias("held"),
                       F.sum(F.when(~capped, F.col("_weight"))).alias("open")).first()
        if not at["open"]:
            break
        found = (budget * (at["all"] or 0) - (at["held"] or 0.0)) / at["open"]
        if level is not None and found <= level:
            break
        level = found
    target = F.least(F.col("_cap"), F.col("_weight") * F.lit(float(level or 0.0)))
    return table.select("_source", "_source_size", target.alias("_target"))


def _edges(rows: DataFrame, plan: DataFrame) -> tuple[DataFrame, int]:
    """The plan with the bucket ``_edge`` where each source's remainder ends and the words
    ``_before`` it, and how many leading bits of ``_at`` number a bucket.

    Each round cuts the edge buckets of the last one by ``DIGIT_BITS`` more bits, until none
    holds more than ``EDGE_ROWS`` rows: whatever the weights do to the keys, the bucket that
    is sorted in the end is small.  The driver sees one number a round."""
    own = plan.select(F.col("_source").alias("_s"), "_left")
    edges = saved(own.filter("_left > 0").select("_s", "_left", F.lit(0).cast("long").alias("_edge"), F.lit(0).cast("long").alias("_before")), "mix-edges")
    level, largest = 0, None
    while level < KEY_BITS and (largest is None or largest > EDGE_ROWS):
        level += DIGIT_BITS
        inside = rows.join(edges, F.col("_source").eqNullSafe(F.col("_s")) & (F.shiftright("_at", KEY_BITS - level + DIGIT_BITS) == F.col("_edge")))
        sums = (inside.groupBy("_s", F.shiftright("_at", KEY_BITS - level).alias("_bucket"))
                .agg(F.sum("size").alias("_sum"), F.count(F.lit(1)).alias("_n"), F.first("_left").alias("_left"), F.first("_before").alias("_start")))
        upto = Window.partitionBy("_s").orderBy("_bucket")  # at most 2**DIGIT_BITS rows a source
        found = (sums.withColumn("_before", F.col("_start") + F.sum("_sum").over(upto) - F.col("_sum"))
                 .filter((F.col("_before") <= F.col("_left")) & (F.col("_left") < F.col("_before") + F.col("_sum")))
                 .groupBy("_s").agg(F.max(F.struct("_bucket", "_before", "_left", "_n")).alias("_e")))
        edges = saved(found.select("_s", "_e._left", F.col("_e._bucket").alias("_edge"), "_e._before", "_e._n"), "mix-edges")
        largest = edges.agg(F.max("_n")).first()[0] or 0
    known = edges.select(F.col("_s").alias("_t"), "_edge", "_before")
    out = plan.withColumnRenamed("_source", "_s").join(known, F.col("_s").eqNullSafe(F.col("_t")), "left")
    return saved(out.select("_s", "_source_size", "_target", "_epochs", "_left", "_edge", F.coalesce("_before", F.lit(0)).alias("_before")), "mix-plan"), level


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MOST, seed: int = 8, keep_text: bool = False) -> DataFrame:
    """The rows of ``docs``, without ``text`` unless it is to be kept, and with ``size``, ``source_size``,
    ``target``, ``copies`` (how often the mix takes the document) and ``taken``
    (its words in the mix)."""
    body = whole_text(text)
    key = exponential_key(quality_weight(body), F.col(doc_id), body, seed=seed)
    rest = docs if keep_text else docs.drop(text)
    made = [F.col(doc_id).alias("_id"), F.col(source).alias("_source"), word_count(body).alias("size"), key.alias("_key")]
    place = F.floor(F.col("_key") / (1.0 + F.col("_key")) * float(1 << KEY_BITS)).cast("long")
    rows = tucked(docs, *made).withColumn("_at", place)
    rows = saved(rows if keep_text else rows.drop(f"_c{docs.columns.index(text)}"), "mix-rows")
    per_source = rows.groupBy("_source").agg(F.sum("size").alias("_source_size"), F.count(F.lit(1)).alias("_rows"))
    plan = targets(per_source.select("_source", "_source_size"), weights, budget, most)
    epochs = F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("_epochs", epochs).withColumn("_left", F.col("_target") - F.col("_epochs") * F.col("_source_size"))

    plan, level = _edges(rows.select("_source", "size", "_at"), plan)
    rows = rows.withColumn("_bucket", F.shiftright("_at", KEY_BITS - level)).drop("_at")
    rows = rows.join(plan, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")

    # no edge: nothing is left to fill, or all of it is
    at_edge = F.coalesce(F.col("_bucket") == F.col("_edge"), F.lit(False))
    order = Window.partitionBy("_source", "_bucket").orderBy("_key", F.col("_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = (rows.filter(at_edge).withColumn("_end", F.col("_before") + F.sum("size").over(order))
              .withColumn("_extra", (F.col("_end") <= F.col("_left")).cast("long")).drop("_end"))
    below = F.coalesce(F.col("_bucket") < F.col("_edge"), F.col("_left") >= F.col("_source_size")) & (F.col("_left") > 0)
    rows = inside.unionByName(rows.filter(~at_edge).withColumn("_extra", below.cast("long")))

    # the last document of a source: the one nearest in size to what is still open
    gap = (inside.groupBy("_source").agg((F.first("_left") - F.first("_before") - F.sum(F.col("size") * F.col("_extra"))).alias("_gap"))
           .withColumnRenamed("_source", "_s"))
    last = (rows.filter(F.col("_extra") == 0).join(gap, F.col("_source").eqNullSafe(F.col("_s")))
            .filter(F.abs(F.col("size") - F.col("_gap")) < F.col("_gap"))
            .groupBy("_source").agg(F.min(F.struct(F.abs(F.col("size") - F.col("_gap")).alias("off"), F.col("_key").alias("k"), F.col("_id").alias("i"), F.col("size").alias("z"))).alias("_last"))
            .withColumnRenamed("_source", "_s"))
    rows = rows.join(saved(last, "mix-last"), F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
    is_last = F.coalesce((F.col("_extra") == 0) & (F.col("_key") == F.col("_last.k")) & F.col("_id").eqNullSafe(F.col("_last.i")) & (F.col("size") == F.col("_last.z")), F.lit(False))
    one = F.row_number().over(Window.partitionBy("_source", "_key", "_id", "size").orderBy("size"))
    chosen = rows.filter(is_last).withColumn("_extra", (one == 1).cast("long"))  # of equal rows one
    out = rows.filter(~is_last).unionByName(chosen).withColumn("copies", F.col("_epochs") + F.col("_extra"))
    names = [(c, f"_c{i}") for i, c in enumerate(docs.columns) if c in rest.columns and c not in MADE]
    return out.select(*[F.col(n).alias(c) for c, n in names], "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
                      "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every taken document, as often as it is taken."""
    names = {"text": "text", "source": "source", "doc_id": "doc_id"} | {k: v for k, v in options.items() if k in ("text", "source", "doc_id")}
    own = {v: F.col(v).alias(k) for k, v in names.items()}
    rows = mix(tucked(docs, *own.values()), keep_text=True, **{k: v for k, v in options.items() if k not in names})
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy")
    return rows.select("*", copies).select(*untucked(docs.columns))


def op8_source_mix(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents: size, source size, target and taken words of each."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
