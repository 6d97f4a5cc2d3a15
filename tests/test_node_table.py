import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickpipe.plans import node_table
from clickpipe.plans.workflow import fit_pipeline, prepare
from clickpipe.sources.fixtures import fixture_tables


@pytest.fixture(scope="module")
def split(tables):
    return prepare(tables)


@pytest.mark.parametrize("name, params", [("dt", {}), ("dt", {"maxDepth": 1}), ("dt", {"maxDepth": 0}), ("rf", {"numTrees": 3}), ("gbt", {"maxIter": 4})])
def test_equal_to_the_model(split, name, params):
    model = fit_pipeline(name, split.train, **params)
    rows = model.transform(split.test).select("features", F.col("prediction").alias("own"), vector_to_array("rawPrediction").alias("own_raw"))
    found = node_table.predict(model.stages[-1], rows)
    same = F.forall(F.zip_with("raw", "own_raw", lambda a, b: F.abs(a - b) < 1e-12), lambda x: x)
    row = found.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("own") == F.col("prediction")).alias("same"), F.count_if(same).alias("raw")).first()
    assert row.n == split.test.count() == row.same == row.raw


def test_without_broadcast_blocks(split, monkeypatch):
    monkeypatch.setattr(node_table, "BROADCAST_BLOCKS", 0)
    model = fit_pipeline("dt", split.train, maxDepth=20)
    found = node_table.predict(model.stages[-1], model.transform(split.test).withColumnRenamed("prediction", "own"))
    assert found.filter("own <> prediction").count() == 0


def test_blocks_are_bounded_and_whole(spark):
    """Depth 30 at sf0.01: every node in one block, no block over 2**LEVELS - 1 nodes."""
    model = fit_pipeline("dt", prepare(fixture_tables(spark, "/root/testdata/sf0.01")).train).stages[-1]
    nodes = node_table.node_table(spark, node_table.save_nodes(model))
    table = node_table.blocks(nodes)
    row = table.agg(F.sum(F.size("items")).alias("n"), F.max(F.size("items")).alias("most"), F.max("step").alias("steps")).first()
    assert row.n == nodes.count() == model.numNodes and row.most <= 2 ** node_table.LEVELS - 1 and row.steps == model.depth // node_table.LEVELS


def test_categorical_splits(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler, VectorIndexer

    df = spark.range(600).select((F.col("id") % 6).cast("double").alias("c"), (F.col("id") % 50).cast("double").alias("x"),
                                 ((F.col("id") % 6).isin(1, 4) | (F.col("id") % 50 > 40)).cast("double").alias("label"))
    rows = VectorAssembler(inputCols=["c", "x"], outputCol="v").transform(df)
    rows = VectorIndexer(inputCol="v", outputCol="features", maxCategories=6).fit(rows).transform(rows)
    model = DecisionTreeClassifier(maxDepth=6).fit(rows)
    found = node_table.predict(model, model.transform(rows).withColumnRenamed("prediction", "own").select("features", "own"))
    assert found.filter("own <> prediction").count() == 0 and found.filter("own = 1").count() > 0


def test_other_models_are_refused(split):
    with pytest.raises(ValueError):
        node_table.predict(fit_pipeline("lr", split.train).stages[-1], split.test)


def test_equal_vectors_are_walked_once(spark, split, monkeypatch):
    """Copies, a negative zero and vectors of both storages: every row stays, a vector is walked once."""
    from pyspark.ml.linalg import Vectors

    model = fit_pipeline("rf", split.train, numTrees=2, maxDepth=4)
    kinds = [Vectors.dense([0.0, 0.2, 0.4, 0.6, 0.8, 1.0]), Vectors.dense([-0.0, 0.2, 0.4, 0.6, 0.8, 1.0]),
             Vectors.dense([0.5, 0.0, 0.0, 0.0, 0.0, 0.0]), Vectors.sparse(6, [0], [0.5])]
    rows = spark.createDataFrame([(i, kinds[i % 4]) for i in range(200)], ["no", "features"])
    seen, walk = [], node_table.leaves

    def leaves(df, *args, **named):
        seen.append(df.count())
        return walk(df, *args, **named)

    monkeypatch.setattr(node_table, "leaves", leaves)
    own = model.stages[-1].transform(rows).select("no", F.col("prediction").alias("own"))
    found = node_table.predict(model.stages[-1], rows)
    assert found.columns == ["no", "features", "raw", "prediction"]
    row = found.join(own, "no").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("own") == F.col("prediction")).alias("same")).first()
    assert row.n == row.same == 200 and seen == [2]


def test_learners_of_tree_nodes_share_one_training_input(spark, monkeypatch):
    from clickpipe.plans import more_queries, workflow

    made, plain = [], workflow.counted_rows
    monkeypatch.setattr(workflow, "counted_rows", lambda df: made.append(1) or plain(df))
    monkeypatch.setattr(more_queries, "NODE_LEARNERS", {"dt": {"maxDepth": 2}, "rf": {"numTrees": 2, "maxDepth": 2}})
    rows = more_queries.q_tree_nodes(spark, "/root/testdata/sf0.001").collect()
    assert [r.learner for r in rows] == ["dt", "rf"] and all(r.n_rows == r.n_equal > 0 for r in rows)
    assert len(made) == 1
