"""From raw documents to token ids: quality, line dedup, near-dedup, mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; ``run`` writes every stage's rows to the shared folder and reads
them again.  All stages but the last return the columns of ``documents``.

SQL can't express the stages (a fitted density, signatures, hashed sampling,
byte merges); ``tests/llm/test_pipeline.py`` holds them against brute force.

Defined cases, for every stage: null text is read as empty (each stage says below
what becomes of it); nulls in other columns, very long texts and extra columns,
whatever their names, pass through; repeated rows are rows of their own until the
line stage keeps one of them; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpipe.llm import bag_minhash, byte_bpe, line_dedup, quality_qda, source_mix
from clickpipe.llm.common import read_table, saved, tucked, untucked


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier, fitted on the labelled ones, accepts.

    An empty text is scored like any other; without labels all are kept if the prior is at least the threshold."""
    rows = tucked(docs, F.col("doc_id"), F.col("text"))
    rows = saved(quality_qda.with_statistics(rows).drop("text"), "quality-statistics")  # one pass over the texts
    model = quality_qda.train(rows, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality_qda.classify(rows, model).filter("predicted = 1").select(*untucked(docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops all but the first line of each component of alike lines.

    Texts without a line that isn't blank stay; of repeated rows with one, one stays."""
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates; texts without words stay."""
    return bag_minhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and samples whole documents to the sources' target weights; null sources are
    one source, and texts without words are taken as often as their source's epochs say."""
    return source_mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, path: str | None = None) -> DataFrame:
    """Token ids of every document, and whether they decode to its bytes; an empty text has none."""
    import public_tokenizers

    codec = byte_bpe.make_codec(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = byte_bpe.decode(byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), codec), codec)
    exact = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", exact.alias("exact"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("mixing to target weights", mix),
    ("byte-level BPE", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
