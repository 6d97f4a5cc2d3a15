import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from clickpipe.llm.common import read_table, saved

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SMALL, "documents")
    names, columns = [], docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        names.append(name)
        after = saved(stage(spark, before, SMALL), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns and after.dtypes == docs.dtypes
            assert after.filter(F.col("text").isNull()).count() == 0
        if name == "quality classifier":
            good = read_table(spark, SMALL, "labels").filter("quality = 1")
            assert good.join(after, "doc_id", "left_anti").count() == 0
            assert after.count() < docs.count()
        if name == "line dedup":
            lines = after.select(F.explode(F.split("text", "\n")).alias("l")).filter("l RLIKE '\\\\S'")
            assert lines.count() == lines.select(F.lower(F.trim("l"))).distinct().count()
            assert after.filter("length(text) <> n_chars").count() == 0
        if name == "MinHash near-dedup":
            assert after.count() == after.select("doc_id").distinct().count()
        if name == "mixing to target weights":
            assert after.select("doc_id").distinct().join(before, "doc_id", "left_anti").count() == 0
            assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
        before = after
    assert len(names) == 5 and before.filter("NOT exact").count() == 0
    import tiktoken

    from clickpipe.llm.byte_bpe import load_ranks

    ranks = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert all(theirs.decode(r.ids) for r in before.limit(5).collect())


def test_run_is_repeatable(spark):
    one, two = (corpus_pipeline.run(spark, SMALL).groupBy("doc_id", "n_tokens").count() for _ in range(2))
    assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0


def test_empty_tables(spark, tmp_path):
    for t in ("documents", "labels"):
        read_table(spark, SMALL, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_pass_every_stage(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows, and columns with clashing names."""
    docs = read_table(spark, SMALL, "documents")
    long = " ".join(f"word{i % 977} of a very long text, number {i}." for i in range(12_000))
    odd = [(None, None, None, None, None), (900_001, None, "en", None, None), (900_002, "", None, "s1", 0), (900_003, long, "en", "s1", len(long)),
           (900_004, "A plain sentence of several words, with a comma, and an end. Another one follows it here, of the same kind.", "en", "s1", 108)]
    odd += [odd[-1]] * 3 + [odd[1]]
    extra = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    names = ("_c0", "_t", "score", "predicted", "_gone", "_kept", "size", "target", "copies", "_u", "_id", "kept", "words", "n_tokens")
    for c in names:
        extra = extra.withColumn(c, F.lit(f"own {c}"))
    extra = saved(extra, "test-odd")
    read_table(spark, SMALL, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    before = extra
    for name, stage in corpus_pipeline.STAGES:
        after = saved(stage(spark, before, str(tmp_path)), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.dtypes == extra.dtypes, name
            assert all(r[0] == f"own {c}" for c in names for r in after.select(f"`{c}`").distinct().collect())
            assert after.select("doc_id").subtract(before.select("doc_id")).count() == 0  # null counts as equal
        if name == "line dedup":
            assert after.filter("doc_id = 900004").count() <= 1
        before = after
    assert before.filter("NOT exact").count() == 0
