import random
from collections import Counter

import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickpipe.operators.assemble import FEATURES, labelled_data
from clickpipe.operators.categories import find_categories
from clickpipe.operators.dictionary import build_dictionary, decode, encode


@pytest.fixture(scope="module")
def words(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice(["a", "b", "é", "zz", "", "a "]) if i % 3 else f"w{i % 40}") for i in range(900)] + [(-1, None)]
    return spark.createDataFrame(rows, "id int, w string")


@pytest.mark.parametrize("order", ["frequencyDesc", "frequencyAsc", "alphabetAsc", "alphabetDesc"])
def test_dictionary_equals_sparks_indexer(words, order):
    theirs = StringIndexer(inputCol="w", stringOrderType=order).fit(words.dropna()).labels
    assert [r.value for r in build_dictionary(words, "w", order).orderBy("index").collect()] == list(theirs)


def test_dictionary_over_many_tasks(spark):
    counts = Counter(f"v{i % 997:03}" for i in range(5000))
    df = spark.range(5000).select(F.format_string("v%03d", F.col("id") % 997).alias("v")).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = build_dictionary(df, "v").orderBy("index").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [(r.value, r.n) for r in found] == sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    assert [r["index"] for r in found] == list(range(997))


def test_unseen_and_null_policy(spark, words):
    table = {"w": build_dictionary(words.filter("id % 2 = 0"), "w")}
    n = table["w"].count()
    known = {r.value for r in table["w"].collect()}
    kept = encode(words, table, invalid="keep")
    assert kept.count() == words.count() and {r.w_index == n for r in kept.collect() if r.w not in known} == {True}
    assert encode(words, table, invalid="skip").count() == sum(r.w in known for r in words.collect())
    with pytest.raises(Exception, match="invalid value in column w"):
        encode(words, table).count()
    back = decode(encode(words, table, invalid="skip"), table)
    assert back.filter("w_value <> w").count() == 0
    empty = {"w": build_dictionary(words.filter("false"), "w")}
    assert {r.w_index for r in encode(words, empty, invalid="keep").collect()} == {0}
    with pytest.raises(ValueError):
        build_dictionary(words, "w", "random")


def test_categories_equal_sparks_indexer(spark, tables):
    rows = VectorAssembler(inputCols=FEATURES, outputCol="v").transform(labelled_data(**tables))
    for most in (4, 5, 30, 60):
        theirs = VectorIndexer(inputCol="v", outputCol="t", maxCategories=most).fit(rows)
        mine = find_categories(rows, "v", len(FEATURES), most)
        maps = {i: sorted(m, key=m.get) for i, m in theirs.categoryMaps.items()}
        assert mine.values == maps
        both = mine.transform(theirs.transform(rows), "v", "mine")
        assert both.filter(vector_to_array("mine") != vector_to_array("t")).count() == 0


def test_category_zero_and_unseen(spark):
    from pyspark.ml.functions import array_to_vector

    make = lambda xs: spark.createDataFrame([([float(a), float(b)],) for a, b in xs], "x array<double>").select(array_to_vector("x").alias("v"))
    found = find_categories(make([(-1, i) for i in range(100)] + [(0, 3.5), (-0.0, 4), (2, 4)]), "v", 2, 3)
    assert found.values == {0: [0.0, -1.0, 2.0]}  # zero first; slot 1 is continuous
    get = lambda df: [r[0] for r in df.select(vector_to_array("o")).collect()]
    assert get(found.transform(make([(-0.0, 9), (2, 9)]), "v", "o")) == [[0.0, 9.0], [2.0, 9.0]]
    unseen = make([(7, 1), (-1, 1)])
    assert get(found.transform(unseen, "v", "o", "keep")) == [[3.0, 1.0], [1.0, 1.0]]
    assert get(found.transform(unseen, "v", "o", "skip")) == [[1.0, 1.0]]
    with pytest.raises(Exception, match="invalid value in column"):
        found.transform(unseen, "v", "o").count()
