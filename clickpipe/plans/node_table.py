"""Tree models as tables of nodes, scored by joins.

Spark's tree models are objects that every executor holds whole; a forest of depth 30
has hundreds of thousands of nodes a tree.  Here a saved model's nodes are read as a
table and packed into blocks: a block is a node whose depth is a multiple of ``LEVELS``
with all nodes less than ``LEVELS`` below it (at most 2**LEVELS - 1).  Scoring walks a
row through one block a step, so four joins score a tree of depth 30, and a task holds
the blocks of its own rows only.

A node's depth and block come from ancestor doubling (five joins of the node table with
itself).  The few blocks of the top steps, which many rows share, are broadcast after
a check of their number; the others are joined on (tree, node).  Equal feature vectors
are walked once, and their rows joined to the result.  Sums over trees are taken
in the order of the trees, so the results equal the model's own to the bit.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpipe.plans.grown_trees import GrownModel
from clickpipe.session import ensure_checkpoint_dir, shared_scratch

#: Levels a block; a power of two.
LEVELS = 8
#: Spark's trees are at most 30 deep: five doublings reach every root.
DOUBLINGS = 5
#: Blocks of a step that are broadcast at most: with 255 nodes of about 80 bytes each, 40 MB.
BROADCAST_BLOCKS = 2048


def save_nodes(model, path: str | None = None) -> str:
    """Saves a tree model in Spark's own format to the shared folder; returns the path (of a grown model:
    where its nodes are already)."""
    from pyspark.sql import SparkSession

    if isinstance(model, GrownModel) and path is None:
        return model.path

    path = path or shared_scratch(SparkSession.getActiveSession(), "tree-model")
    model.write().overwrite().save(path)
    return path


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """One row a node: ``tree``, ``node``, ``feature``, ``cut`` (threshold, or the left
    categories), ``categories`` (-1: threshold), ``left``, ``right``, ``prediction``, ``stats``."""
    data = spark.read.parquet(f"{path}/data")
    one = "nodeData" not in data.columns
    rows = data.select(F.lit(0).alias("tree"), *data.columns) if one else data.select(F.col("treeID").alias("tree"), "nodeData.*")
    return rows.select("tree", F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
                       F.col("split.leftCategoriesOrThreshold").alias("cut"), F.col("split.numCategories").alias("categories"),
                       F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), "prediction", F.col("impurityStats").alias("stats"))


def _checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _jump(steps: DataFrame, by: DataFrame) -> DataFrame:
    """Ancestors reached by going ``steps`` and then ``by``: ``tree``, ``node``, ``up``, ``far``."""
    second = by.select("tree", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("far").alias("_far"))
    return steps.join(second, ["tree", "up"]).select("tree", "node", F.col("_up").alias("up"), (F.col("far") + F.col("_far")).alias("far"))


def blocks(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``tree``, ``root``, ``step`` (its depth / ``levels``) and ``items``: the block's nodes by
    number, with the places of their children in the block (-1: in another one)."""
    child = nodes.filter("left >= 0").select("tree", F.col("node").alias("up"), F.explode(F.array("left", "right")).alias("node"))
    root = nodes.filter("node = 0").select("tree", "node", F.col("node").alias("up"), F.lit(0).alias("far"))
    ups = [_checkpointed(child.select("tree", "node", "up", F.lit(1).alias("far")).unionByName(root))]
    for _ in range(DOUBLINGS):
        ups.append(_checkpointed(_jump(ups[-1], ups[-1])))
    placed = ups[-1].select("tree", "node", F.col("far").alias("depth"), F.col("node").alias("root"))
    for bit in range(int(math.log2(levels))):  # up by depth mod levels, a power of two at a time
        up = ups[bit].select("tree", F.col("node").alias("root"), F.col("up").alias("_up"))
        wanted = F.col("depth").bitwiseAND(1 << bit) != 0
        placed = placed.join(up, ["tree", "root"]).select("tree", "node", "depth", F.when(wanted, F.col("_up")).otherwise(F.col("root")).alias("root"))
    whole = nodes.join(placed, ["tree", "node"])
    item = F.struct("node", "feature", "cut", "categories", "left", "right", "prediction", "stats")
    packed = whole.groupBy("tree", "root").agg(F.array_sort(F.collect_list(item)).alias("_items"), F.floor(F.min("depth") / levels).cast("int").alias("step"))
    numbers = F.transform("_items", lambda x: x["node"])
    place = lambda x, side: (F.array_position("_numbers", x[side]) - 1).cast("int").alias(f"{side}_at")
    items = F.transform("_items", lambda x: F.struct(*[x[c].alias(c) for c in ("feature", "cut", "categories", "left", "right", "prediction", "stats")],
                                                     place(x, "left"), place(x, "right")))
    return _checkpointed(packed.withColumn("_numbers", numbers).select("tree", "root", "step", items.alias("items")))


def _walk(levels: int) -> Column:
    """From a block's root down: (place of the leaf, or -1; node to go on from)."""

    def step(at: Column, _: Column) -> Column:
        item = F.get("items", at["at"])
        value = F.get("_x", item["feature"])
        left = F.when(item["categories"] < 0, value <= item["cut"][0]).otherwise(F.array_contains(item["cut"], value))
        inner = (at["at"] >= 0) & (item["left"] >= 0)
        return F.struct(F.when(inner, F.when(left, item["left_at"]).otherwise(item["right_at"])).otherwise(at["at"]).alias("at"),
                        F.when(inner, F.when(left, item["left"]).otherwise(item["right"])).otherwise(at["node"]).alias("node"))

    start = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("node"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), start, step)


def leaves(rows: DataFrame, table: DataFrame, trees: int, features: str = "features", levels: int = LEVELS) -> DataFrame:
    """The leaf of every row in every tree: ``_row``, ``tree``, ``prediction``, ``stats``.

    ``rows`` has a unique ``_row``; ``table`` holds blocks."""
    state = rows.select("_row", vector_to_array(features).alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("root"))
    sizes = {r["step"]: r["count"] for r in table.groupBy("step").count().collect()}  # one row a step
    done = None
    for step in sorted(sizes):
        part = table.filter(F.col("step") == step).drop("step")
        if sizes[step] <= BROADCAST_BLOCKS:
            part = F.broadcast(part)
        walked = _checkpointed(state.join(part, ["tree", "root"]).withColumn("_at", _walk(levels))
                               .select("_row", "tree", F.col("_at.node").alias("root"), F.get("items", F.col("_at.at")).alias("leaf"), "_x")
                               .select("_row", "tree", "root", "leaf.prediction", "leaf.stats", F.when(F.col("leaf").isNull(), F.col("_x")).alias("_x")))
        found = walked.filter("_x IS NULL").select("_row", "tree", "prediction", "stats")
        done = found if done is None else done.unionByName(found)
        state = walked.filter("_x IS NOT NULL").select("_row", "_x", "tree", "root")
    return done


def predict(model, df: DataFrame, features: str = "features", names: tuple[str, str] = ("raw", "prediction")) -> DataFrame:
    """The rows with ``raw`` (array, as the model's ``rawPrediction``) and ``prediction`` (or other ``names``),
    from the model's nodes: decision tree, random forest or gradient-boosted classifier.

    The joins of the documents copy rows, so equal vectors are walked once: what is walked and
    kept between steps grows with the distinct vectors times the trees."""
    kind = type(model).__name__
    if isinstance(model, GrownModel):
        kind = ("RandomForest" if model.forest else "DecisionTree") + "ClassificationModel"
    if kind not in ("DecisionTreeClassificationModel", "RandomForestClassificationModel", "GBTClassificationModel"):
        raise ValueError(f"no tree classifier: {kind}")
    if kind.startswith("Decision"):
        trees = 1
    else:
        trees = model.learner.getNumTrees() if isinstance(model, GrownModel) else len(model.trees)
    table = blocks(node_table(df.sparkSession, save_nodes(model)))
    rows = _checkpointed(df.withColumn("_row", vector_to_array(features)))
    vectors = rows.select(F.col("_row").alias("_own")).distinct().withColumn("_row", F.monotonically_increasing_id())
    vectors = _checkpointed(vectors.withColumn("_vector", array_to_vector("_own")))
    found = leaves(vectors, table, trees, "_vector").groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("tree", "prediction", "stats"))).alias("_l"))
    if kind.startswith("Decision"):
        raw = F.col("_l")[0]["stats"]
    elif kind.startswith("Random"):  # each tree's leaf shares, added up in order
        whole = lambda s: F.aggregate(s, F.lit(0.0), lambda a, b: a + b)
        zero = F.transform(F.col("_l")[0]["stats"], lambda _: F.lit(0.0))
        raw = F.aggregate("_l", zero, lambda a, t: F.zip_with(a, t["stats"], lambda x, y: F.when(whole(t["stats"]) != 0, x + y / whole(t["stats"])).otherwise(x)))
    else:
        weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
        margin = F.aggregate(F.transform("_l", lambda t, i: t["prediction"] * F.get(weights, i)), F.lit(0.0), lambda a, b: a + b)
        raw = F.array(-margin, margin)
    walked = vectors.join(found.select("_row", raw.alias("raw")), "_row").select(F.col("_own").alias("_row"), "raw")
    out = rows.join(walked, "_row").drop("_row")
    best = F.array_position("raw", F.array_max("raw")).cast("double") - 1  # ties: the first class
    return out.withColumn(names[1], best).withColumnRenamed("raw", names[0])
