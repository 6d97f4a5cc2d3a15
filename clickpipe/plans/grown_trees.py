"""Deep trees and forests grown where their rows lie.

Spark's learner sends a dense histogram (features x bins x classes) of every node from every
partition and passes over all rows for each group of nodes.  A tree of depth 30 has a node for
every few rows, so the histograms outweigh the rows by far and passes times rows is quadratic.
Here the values are cut into bins once and packed into arrays.  Only nodes of more than
``LOCAL`` rows get histograms, a level a pass, summed and judged by tasks; then the rows of each
smaller node are dealt to one task, which grows the whole subtree below it.

Bins, gains, ties, leaves and pruning are those of Spark's learner.  The cut candidates of more
rows than it samples come from a sample of the same size, chosen by the rows' content.  A forest's
draws are functions of the seed and of a row's content (how often a tree sees it: Poisson, as for
its copies one by one) or of a node's place (its features), so that a model depends neither on
partitions nor on the order in which nodes are grown.

Spark's models travel inside the plan: every task that scores unpacks all trees anew.  The nodes
of a ``GrownModel`` are written in the format that Spark's models are saved in; it scores by packed
arrays, sent once to a worker, or beyond ``ARRAY_NODES`` by joins with that table of nodes.
Whatever else is asked of it, Spark's own model answers, read from there at the first such call.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import (DecisionTreeClassificationModel, DecisionTreeClassifier, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpipe.session import shared_scratch

#: Rows of a packed array at most.
SLICE = 1 << 16
#: Rows of a node at most whose subtree one task grows.
LOCAL = 1 << 16
#: Nodes with a histogram at a time: with six features of 128 bins, 38 MB a task.
GROUP = 2048
#: Nodes of a model at most that scores by arrays: about 14 bytes each in every worker.
ARRAY_NODES = 1 << 22
#: Classes at most; a histogram has one number a class.
MAX_CLASSES = 100
#: Spark's learner looks for cuts in this many rows at least, or the square of the bins.
CUT_ROWS = 10000

NODE = ("id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, "
        "leftChild int, rightChild int, split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>")


def grows(learner) -> bool:
    """Whether the learner's model can be grown here: Gini, no bounds on a node but its depth, no weights of its own."""
    if not isinstance(learner, (DecisionTreeClassifier, RandomForestClassifier)) or learner.isDefined(learner.weightCol) and learner.getWeightCol():
        return False
    if (learner.getImpurity(), learner.getMinInstancesPerNode(), learner.getMinInfoGain(), learner.getMinWeightFractionPerNode()) != ("gini", 1, 0.0, 0.0):
        return False
    if not 2 <= learner.getMaxBins() <= 256 or learner.isSet(learner.thresholds) or learner.getLeafCol():
        return False
    if isinstance(learner, DecisionTreeClassifier):
        return True
    return learner.getSubsamplingRate() == 1.0 and learner.getFeatureSubsetStrategy() in ("auto", "all", "sqrt", "log2", "onethird")


def features_each(learner, width: int) -> int:
    """Features that a node may be cut by."""
    if isinstance(learner, DecisionTreeClassifier):
        return width
    strategy = learner.getFeatureSubsetStrategy()
    if strategy == "auto":
        strategy = "all" if learner.getNumTrees() == 1 else "sqrt"
    return {"all": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width))), "onethird": math.ceil(width / 3)}[strategy]


def cut_points(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Thresholds of one feature, at most ``most``: between neighbours if they are few, else those
    nearest to equal shares of the weight (as Spark's learner finds them)."""
    kept = np.isfinite(values)
    values, at = np.unique(values[kept], return_inverse=True)
    counts = np.bincount(at, weights[kept], len(values))
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) <= most:
        return middles
    reached = np.cumsum(counts)
    stride = target = reached[-1] / (most + 1)
    found = []
    for i in range(1, len(values)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            found.append(middles[i - 1])
            target += stride
    return np.array(found[:most])


def task_functions(cuts: list, classes: int, trees: int, each: int, seed: int, max_depth: int, drawn: bool, size: int, local: int):
    """The functions of the tasks, made here so that they reach them by value: tasks needn't import this package."""
    width, bins = len(cuts), max(len(c) for c in cuts) + 1
    splits = np.array([len(c) for c in cuts])
    tiny = float(np.finfo(float).eps)

    def mixed(x):
        """A 64-bit hash of 64-bit numbers."""
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def chained(parts):
        h = np.array([seed & 0xFFFFFFFFFFFFFFFF], np.uint64)  # an array: scalars warn where they wrap around
        for p in parts:
            h = mixed(mixed(p + np.uint64(0x9E3779B97F4A7C15)) ^ (h * np.uint64(0xD1342543DE82EF95) + np.uint64(1)))
        return h

    def poisson(means, hashes):
        """Draws with these means from uniform hashes: the inverse of the distribution for small means."""
        out, u = np.zeros(len(means), np.int64), (hashes >> np.uint64(11)).astype(float) * 2.0 ** -53
        many = means > 64
        share = np.where(many, 2.0, np.exp(-np.minimum(means, 700.0)))
        reached, k = share.copy(), 0
        open_ = np.flatnonzero(u >= reached)
        while len(open_) and k < 512:
            k += 1
            share[open_] *= means[open_] / k
            reached[open_] += share[open_]
            out[open_] = k
            open_ = open_[u[open_] >= reached[open_]]
        for i in np.flatnonzero(many):
            out[i] = np.random.default_rng(int(hashes[i])).poisson(means[i])
        return out

    def packed(batches):
        """Rows in arrays: bins, class and each tree's number of the row."""
        held, n = [], 0

        def block():
            x, y, c = (np.concatenate([h[i] for h in held]) for i in range(3))
            codes = np.empty((len(x), width), np.uint8)
            for f in range(width):
                codes[:, f] = np.searchsorted(cuts[f], x[:, f], side="left")
            if drawn:
                clean = x + 0.0
                row = chained([*[clean[:, f].copy().view(np.uint64) for f in range(width)], y.astype(np.uint64)])
                w = np.stack([poisson(c.astype(float), chained([row, np.full(len(row), t, np.uint64)])) for t in range(trees)])
            else:
                w = np.broadcast_to(c, (trees, len(c)))
            kind = np.uint16 if w.max(initial=0) < 1 << 16 else np.int64
            return pa.RecordBatch.from_pydict({"n": pa.array([len(x)], pa.int32()), "wide": pa.array([np.dtype(kind).itemsize], pa.int32()), "x": pa.array([codes.tobytes()], pa.binary()),
                                               "y": pa.array([y.astype(np.uint8).tobytes()], pa.binary()), "w": pa.array([w.astype(kind).tobytes()], pa.binary())})

        for b in batches:
            x = np.asarray(b.column(0).flatten(), float).reshape(-1, width)
            held.append((x, np.asarray(b.column(1)), np.asarray(b.column(2))))
            n += len(x)
            if n >= size:
                yield block()
                held, n = [], 0
        if n:
            yield block()

    def arrays(row):
        kind = np.uint16 if row["wide"] == 2 else np.int64
        return (np.frombuffer(row["x"], np.uint8).reshape(-1, width), np.frombuffer(row["y"], np.uint8),
                np.frombuffer(row["w"], kind).reshape(trees, -1))

    def impurity(counts):
        """Gini of counts by class (last axis), summed up in the order of Spark's."""
        total = counts.sum(-1)
        out, whole = np.ones(total.shape), np.where(total == 0, 1.0, total)
        for c in range(classes):
            share = counts[..., c] / whole
            out -= share * share
        return np.where(total == 0, 0.0, out)

    def gains(left, whole, parent):
        """Gains of cuts, ``-inf`` where a side is empty or the gain is below 0."""
        right = whole - left
        l, r = left.sum(-1), right.sum(-1)
        gain = parent - l / (l + r) * impurity(left) - r / (l + r) * impurity(right)
        return np.where((l > 0) & (r > 0) & (gain >= 0), gain, -np.inf)

    def allowed(tree, places):
        """Which features the nodes at these places (1: the root, then 2n and 2n + 1) may be cut by."""
        if each >= width:
            return np.ones((len(places), width), bool)
        at = chained([np.full(len(places), tree, np.uint64), places.astype(np.uint64)])
        scores = np.stack([chained([at, np.full(len(places), f, np.uint64)]) for f in range(width)], 1)
        return np.argsort(np.argsort(scores, 1, kind="stable"), 1) < each

    def walked(codes, top):
        """The node of a growing tree in which each row lies."""
        feature, cut, left, right = top
        at = np.zeros(len(codes), np.int32)
        moving = np.arange(len(codes))
        while len(moving):
            node = at[moving]
            moving, node = moving[feature[node] >= 0], node[feature[node] >= 0]
            goes = codes[moving, feature[node]] <= cut[node]
            at[moving] = np.where(goes, left[node], right[node])
        return at

    def histograms(tops, wanted):
        """Numbers by feature, bin and class (and of rows) of the wanted nodes, a task's own sums."""
        slots = {t: {node: i for i, node in enumerate(w)} for t, w in wanted.items()}

        def sums(rows):
            held = {t: np.zeros((len(w), width, bins, classes + 1)) for t, w in wanted.items()}
            for row in rows:
                codes, y, w = arrays(row)
                for t, hist in held.items():
                    slot = np.full(len(tops[t][0]), -1, np.int64)
                    slot[list(slots[t])] = list(slots[t].values())
                    at = slot[walked(codes, tops[t])]
                    here = np.flatnonzero((at >= 0) & (w[t] > 0))
                    base, number = at[here] * bins, w[t][here].astype(float)
                    for f in range(width):
                        key = base + codes[here, f]
                        flat = (key * classes + y[here])
                        found = np.bincount(flat, number, len(hist) * bins * classes).reshape(len(hist), bins, classes)
                        hist[:, f, :, :classes] += found
                        hist[:, f, :, classes] += np.bincount(key, None, len(hist) * bins).reshape(len(hist), bins)
            for t, hist in held.items():
                for node, i in slots[t].items():
                    if hist[i, 0, :, classes].any():
                        yield (t, node), hist[i]

        return sums

    def judged(places):
        """The best cut of a node from its histogram: feature, bin, gain, own counts, left counts, rows on both sides."""

        def best(item):
            (tree, node), hist = item
            counts = hist[0, :, :classes].sum(0)
            may = allowed(tree, np.array([places[tree, node]]))[0]
            parent, top = impurity(counts), (-1, 0, -np.inf, counts, hist[0, :, classes].sum(), 0.0)
            for f in range(width):
                if not may[f] or not splits[f]:
                    continue
                left = np.cumsum(hist[f], 0)[:splits[f]]
                gain = gains(left[:, :classes], counts, parent)
                at = int(np.argmax(gain))
                if gain[at] > top[2]:
                    top = (f, at, float(gain[at]), left[at, :classes].copy(), left[at, classes], hist[f, :, classes].sum() - left[at, classes])
            return (tree, node), (top[0], top[1], top[2], float(parent), counts, top[3], top[4], top[5])

        return best

    def dealt(tops, parts):
        """The rows of small nodes, by the task that grows them."""

        def pieces(rows):
            for row in rows:
                codes, y, w = arrays(row)
                for t in range(trees):
                    own = np.full(len(tops[t][0]), -1, np.int64)
                    mine = [node for tree, node in parts if tree == t]
                    own[mine] = mine
                    at = own[walked(codes, tops[t])]
                    here = np.flatnonzero((at >= 0) & (w[t] > 0))
                    here = here[np.argsort(at[here], kind="stable")]
                    nodes, starts = np.unique(at[here], return_index=True)
                    for node, piece in zip(nodes.tolist(), np.split(here, starts[1:])):
                        yield parts[t, node], (t, node, codes[piece].tobytes(), y[piece].tobytes(), w[t][piece].astype(np.int64).tobytes())

        return pieces

    def subtree(tree, place, depth, codes, y, w):
        """The whole subtree of a node: arrays by node, the root first and children behind their parents."""
        at, w = np.zeros(len(y), np.int64), w.astype(float)
        counts = np.stack([np.bincount(at, w * (y == c), 1) for c in range(classes)], 1)
        places, levels, begin = np.array([place]), [], 0
        grown = np.arange(1 if depth < max_depth else 0)  # the level's nodes that may be cut; rows lie in those only
        while True:
            k, own = len(counts), impurity(counts)
            feature, cut = np.full(k, -1), np.zeros(k, np.int64)
            gain, lower = np.full(k, -np.inf), np.zeros_like(counts)
            live, n = counts[grown], len(grown)
            if n:
                may = allowed(tree, places[grown])
                for f in np.flatnonzero(splits):
                    here = slice(None) if may[:, f].all() else np.flatnonzero(may[at, f])
                    key = at[here] * bins + codes[here, f]
                    if not len(key):
                        continue
                    order = np.argsort(key, kind="stable")
                    key, number, kind = key[order], w[here][order], y[here][order]
                    ends = np.flatnonzero(np.append(key[1:] != key[:-1], True))
                    sums = np.stack([np.cumsum(np.where(kind == c, number, 0.0))[ends] for c in range(classes)], 1)
                    node, bin_ = key[ends] // bins, key[ends] % bins
                    first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
                    before = np.zeros((n, classes))
                    before[node[first[1:]]] = sums[first[1:] - 1]
                    left = sums - before[node]
                    found = gains(left, live[node], own[grown][node])
                    found[bin_ >= splits[f]] = -np.inf
                    most = np.maximum.reduceat(found, first)
                    spot = np.where(found == np.repeat(most, np.diff(np.append(first, len(found)))), np.arange(len(found)), len(found))
                    spot = np.minimum.reduceat(spot, first)
                    better = most > gain[grown[node[first]]]
                    which, spot = grown[node[first]][better], spot[better]
                    feature[which], cut[which], gain[which], lower[which] = f, bin_[spot], most[better], left[spot]
            cutting = gain > 0
            # Spark's marks: a node without a valid cut has no impurity; one that isn't tried has its own.
            shown = own.copy()
            shown[grown[np.isneginf(gain[grown])]] = -1.0
            feature[~cutting] = -1
            level = {"feature": feature, "cut": cut, "gain": np.where(cutting, gain, -1.0), "impurity": np.where(cutting, own, shown),
                     "counts": counts, "left": np.full(k, -1), "right": np.full(k, -1)}
            parents = np.flatnonzero(cutting)
            begin += k
            level["left"][parents] = begin + 2 * np.arange(len(parents))
            level["right"][parents] = begin + 2 * np.arange(len(parents)) + 1
            levels.append(level)
            if not len(parents):
                break
            rank = np.full(k, -1)
            rank[parents] = np.arange(len(parents))
            node = grown[at]
            going = np.flatnonzero(rank[node] >= 0)
            node = node[going]
            child = 2 * rank[node] + (codes[going, feature[node]] > cut[node])
            depth += 1
            counts = np.empty((2 * len(parents), classes))
            counts[0::2], counts[1::2] = lower[parents], level["counts"][parents] - lower[parents]
            places = np.repeat(places[parents] * 2, 2) + np.tile([0, 1], len(parents))
            grown = np.flatnonzero(np.abs(impurity(counts)) >= tiny) if depth < max_depth else np.arange(0)
            order = np.full(len(counts), -1)
            order[grown] = np.arange(len(grown))
            kept = order[child] >= 0
            going, at = going[kept], order[child[kept]]
            codes, y, w = codes[going], y[going], w[going]
        whole = {c: np.concatenate([v[c] for v in levels]) for c in levels[0]}
        return pruned(whole, np.cumsum([0] + [len(v["feature"]) for v in levels]))

    def pruned(nodes, bounds):
        """Siblings that are leaves of one prediction go, and the numbers close up."""
        predicts = nodes["counts"].argmax(1)
        alive = np.ones(len(predicts), bool)
        for a, b in zip(bounds[-2::-1], bounds[:0:-1]):
            inner = a + np.flatnonzero(nodes["left"][a:b] >= 0)
            l, r = nodes["left"][inner], nodes["right"][inner]
            same = inner[(nodes["left"][l] < 0) & (nodes["left"][r] < 0) & (predicts[l] == predicts[r])]
            alive[nodes["left"][same]] = alive[nodes["right"][same]] = False
            nodes["left"][same] = nodes["right"][same] = nodes["feature"][same] = -1
            nodes["gain"][same] = -1.0
        number = np.cumsum(alive) - 1
        for side in ("left", "right"):
            nodes[side] = np.where(nodes[side] >= 0, number[nodes[side]], -1)
        return {c: v[alive] for c, v in nodes.items()}

    def finished(starts):
        """Subtrees of the nodes dealt to a task: tree, node, size, and the nodes' arrays."""

        def growing(rows):
            held = {}
            for _, (t, node, *parts) in rows:
                held.setdefault((t, node), []).append(parts)
            for t, node in sorted(held):
                x, y, w = (b"".join(p[i] for p in held[t, node]) for i in range(3))
                place, depth = starts[t, node]
                found = subtree(t, place, depth, np.frombuffer(x, np.uint8).reshape(-1, width), np.frombuffer(y, np.uint8), np.frombuffer(w, np.int64))
                held[t, node] = None
                kinds = {"feature": np.int16, "cut": np.int16, "left": np.int32, "right": np.int32}
                yield (t, node, len(found["feature"]), *[found[c].astype(kinds.get(c, float)).tobytes() for c in ("feature", "cut", "left", "right", "gain", "impurity", "counts")])

        return growing

    def numbered(ids):
        """Rows of the saved format from subtrees, with their nodes' numbers in the tree."""

        def written(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    root, offset = ids[row["tree"], row["node"]]
                    feature, cut = np.frombuffer(row["feature"], np.int16), np.frombuffer(row["cut"], np.int16)
                    left, right = np.frombuffer(row["left"], np.int32), np.frombuffer(row["right"], np.int32)
                    counts = np.frombuffer(row["counts"], float).reshape(-1, classes)
                    number = np.concatenate([[root], offset + np.arange(len(feature) - 1)]).astype(np.int32)
                    inner = feature >= 0
                    values = np.array([cuts[f][c] for f, c in zip(feature[inner], cut[inner])], float)
                    m = len(feature)
                    split = pa.StructArray.from_arrays([
                        pa.array(feature.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(inner)]).astype(np.int32)), pa.array(values)),
                        pa.array(np.full(m, -1, np.int32))], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(m, row["tree"], np.int32)), pa.array(number), pa.array(counts.argmax(1).astype(float)),
                        pa.array(np.frombuffer(row["impurity"], float)), pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * classes), pa.array(counts.ravel())),
                        pa.array(counts.sum(1).astype(np.int64)), pa.array(np.frombuffer(row["gain"], float)),
                        pa.array(np.where(left >= 0, number[left], -1).astype(np.int32)), pa.array(np.where(right >= 0, number[right], -1).astype(np.int32)), split],
                        ["tree", "id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])

        return written

    return packed, histograms, judged, dealt, finished, numbered, pruned


class _Top:
    """The nodes of one tree above its subtrees, in the order of their making."""

    def __init__(self):
        self.feature, self.cut, self.left, self.right = [], [], [], []
        self.gain, self.impurity, self.counts, self.depth, self.place = [], [], [], [], []

    def add(self, counts, depth: int, place: int, impurity: float) -> int:
        for name, value in (("feature", -1), ("cut", 0), ("left", -1), ("right", -1), ("gain", -1.0),
                            ("impurity", impurity), ("counts", counts), ("depth", depth), ("place", place)):
            getattr(self, name).append(value)
        return len(self.feature) - 1

    def arrays(self) -> tuple:
        return tuple(np.array(getattr(self, c), np.int64) for c in ("feature", "cut", "left", "right"))

    def closed(self, roots: dict) -> tuple[list[int], list]:
        """The nodes that stay once leaves of one prediction are merged, and each node's record.

        ``roots``: the records of nodes whose subtrees tasks have grown."""
        record = [roots.get(i) or (self.feature[i] >= 0, self.impurity[i], self.counts[i]) for i in range(len(self.feature))]
        gone = set()
        for i in reversed(range(len(record))):
            l, r = self.left[i], self.right[i]
            if l >= 0 and not record[l][0] and not record[r][0] and int(np.argmax(record[l][2])) == int(np.argmax(record[r][2])):
                record[i] = (False, self.impurity[i], self.counts[i])
                self.feature[i] = self.left[i] = self.right[i] = -1
                self.gain[i] = -1.0
                gone |= {l, r}
        return [i for i in range(len(record)) if i not in gone], record


def _gini(counts: np.ndarray) -> float:
    out = 1.0
    for c in counts:
        out -= (c / counts.sum()) ** 2
    return out


def _facts(learner, rows: DataFrame):
    """Number of rows, of copies and of classes, and the width; None where Spark's learner has to judge the input."""
    found = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("c").alias("copies"), F.max("y").alias("most"), F.min("y").alias("least"),
                     F.count_if(F.col("y").isNull() | (F.col("y") != F.floor("y"))).alias("odd"),
                     F.min(F.size("x")).alias("width"), F.max(F.size("x")).alias("widest")).first()
    whole = found["rows"] and not found["odd"] and found["least"] >= 0 and 1 <= found["most"] < MAX_CLASSES
    return found if whole and found["width"] == found["widest"] > 0 else None


def _cuts(rows: DataFrame, number: int, bins: int, width: int, seed: int) -> list[np.ndarray]:
    """Each feature's thresholds, from all rows or a sample by content of as many as Spark's learner takes."""
    most, needed = min(bins, number) - 1, max(bins * bins, CUT_ROWS)
    if needed < number:
        rows = rows.filter(F.pmod(F.xxhash64("x", "y", F.lit(seed)), F.lit(1 << 32)) < int(needed / number * (1 << 32)))
    found = rows.select("x", "c").toPandas()  # CUT_ROWS or the square of the bins
    x, c = np.array(found["x"].tolist(), float).reshape(-1, width), found["c"].to_numpy(float)
    return [cut_points(x[:, f], c, most) if len(x) else np.array([]) for f in range(width)]


def fit_grown(learner, data: DataFrame, copies: str):
    """The learner's model (a ``GrownModel``) of rows that stand for ``copies`` equal ones each, or None
    for input that Spark's learner has to judge."""
    spark, forest = data.sparkSession, isinstance(learner, RandomForestClassifier)
    attributes = data.schema[learner.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    rows = data.select(vector_to_array(learner.getFeaturesCol()).alias("x"), F.col(learner.getLabelCol()).cast("double").alias("y"), F.col(copies).cast("long").alias("c"))
    facts = None if {"nominal", "binary"} & set(attributes) else _facts(learner, rows)
    if facts is None:
        return None
    width, classes, trees, depth = facts["width"], int(facts["most"]) + 1, learner.getNumTrees() if forest else 1, learner.getMaxDepth()
    cuts = _cuts(rows, facts["rows"], learner.getMaxBins(), width, learner.getSeed())
    packed, histograms, judged, dealt, finished, numbered, _ = task_functions(
        cuts, classes, trees, features_each(learner, width), learner.getSeed(), depth, forest and learner.getBootstrap(), SLICE, LOCAL)
    blocks = rows.mapInArrow(packed, "n int, wide int, x binary, y binary, w binary").persist(StorageLevel.MEMORY_AND_DISK)
    held = None
    try:
        tops, small = _grow_tops(blocks.rdd, histograms, judged, trees, depth, facts["rows"])
        made = _deal(blocks.rdd, tops, small, dealt, finished)
        names = ("feature", "cut", "left", "right", "gain", "impurity", "counts")
        held = spark.createDataFrame(made, "tree int, node int, size int, " + ", ".join(f"{c} binary" for c in names)).persist(StorageLevel.MEMORY_AND_DISK)
        return _saved_model(learner, held, tops, cuts, classes, width, numbered)
    finally:
        blocks.unpersist()
        if held is not None:
            held.unpersist()


def _grow_tops(blocks, histograms, judged, trees: int, max_depth: int, rows: int) -> tuple[list[_Top], dict]:
    """The trees above their subtrees, a level a pass, and the (tree, node) of every subtree with its number of rows."""
    tops, small = [_Top() for _ in range(trees)], {}
    for top in tops:
        top.add(None, 0, 1, 0.0)
    wanted = [(t, 0) for t in range(trees)] if rows > LOCAL else []
    small = {} if wanted else {(t, 0): rows for t in range(trees)}
    while wanted:
        found = []
        for a in range(0, len(wanted), GROUP):
            some = {t: [n for u, n in wanted[a:a + GROUP] if u == t] for t in {u for u, _ in wanted[a:a + GROUP]}}
            places = {(t, n): tops[t].place[n] for t, ns in some.items() for n in ns}
            sums = blocks.mapPartitions(histograms([t.arrays() for t in tops], some)).reduceByKey(lambda x, y: x + y, min(len(places), blocks.getNumPartitions()))
            found += sums.map(judged(places)).collect()  # a cut a node
        wanted = []
        for (t, node), (feature, cut, gain, parent, counts, lower, below, above) in sorted(found, key=lambda x: x[0]):
            top = tops[t]
            top.counts[node] = counts
            top.impurity[node] = -1.0 if math.isinf(gain) else parent
            depth = top.depth[node] + 1
            if gain <= 0 or depth > max_depth:
                continue
            top.feature[node], top.cut[node], top.gain[node], top.impurity[node] = feature, cut, gain, parent
            for side, part, number in (("left", lower, below), ("right", counts - lower, above)):
                own = _gini(part)
                child = top.add(part, depth, top.place[node] * 2 + (side == "right"), own)
                getattr(top, side)[node] = child
                if depth < max_depth and abs(own) >= np.finfo(float).eps:
                    if number > LOCAL:
                        wanted.append((t, child))
                    else:
                        small[t, child] = int(number)
    return tops, small


def _deal(blocks, tops: list[_Top], small: dict, dealt, finished):
    """The subtrees, each grown by one task that holds the rows of nodes of about ``LOCAL`` rows together."""
    parts, number, filled = {}, 0, 0
    for key in sorted(small):
        if filled and filled + small[key] > LOCAL:
            number, filled = number + 1, 0
        parts[key] = number
        filled += small[key]
    starts = {(t, n): (tops[t].place[n], tops[t].depth[n]) for t, n in small}
    pieces = blocks.mapPartitions(dealt([t.arrays() for t in tops], parts))
    return pieces.partitionBy(number + 1, lambda k: k).mapPartitions(finished(starts))


def _saved_model(learner, held: DataFrame, tops: list[_Top], cuts: list, classes: int, width: int, numbered):
    """The trees' nodes in the format of Spark's learners, read back as its model."""
    spark, forest = held.sparkSession, isinstance(learner, RandomForestClassifier)
    sizes, roots = {}, [{} for _ in tops]
    first = lambda c, n: F.substring(c, 1, n).alias(c)
    for r in held.select("tree", "node", "size", first("impurity", 8), first("counts", 8 * classes)).collect():  # one row a subtree
        sizes[r["tree"], r["node"]] = r["size"]
        roots[r["tree"]][r["node"]] = (r["size"] > 1, float(np.frombuffer(r["impurity"])[0]), np.frombuffer(r["counts"]))
    ids, own = {}, []
    for t, top in enumerate(tops):
        stay, record = top.closed(roots[t])
        number = {node: i for i, node in enumerate(stay)}
        offset = len(stay)
        for node in stay:
            if (t, node) in sizes:
                ids[t, node] = (number[node], offset)
                offset += sizes[t, node] - 1
                continue
            inner, impurity, counts = record[node]
            f = top.feature[node]
            own.append((t, number[node], float(np.argmax(counts)), float(impurity), [float(c) for c in counts], int(counts.sum()), float(top.gain[node]),
                        number[top.left[node]] if inner else -1, number[top.right[node]] if inner else -1, (f, [float(cuts[f][top.cut[node]])] if inner else [], -1)))
    kept = held.join(F.broadcast(spark.createDataFrame([(t, n) for t, n in ids], "tree int, node int")), ["tree", "node"])
    nodes = kept.mapInArrow(numbered(ids), f"tree int, {NODE}")
    if own:
        nodes = nodes.unionByName(spark.createDataFrame(own, f"tree int, {NODE}"))
    if forest:
        nodes = nodes.select(F.col("tree").alias("treeID"), F.struct(*[c for c in nodes.columns if c != "tree"]).alias("nodeData"))
    else:
        nodes = nodes.drop("tree")
    path = shared_scratch(spark, "grown-trees")
    nodes.write.parquet(f"{path}/data")
    total = [0] * len(tops)
    for (t, n), (_, offset) in ids.items():
        total[t] = max(total[t], offset + sizes[t, n] - 1)
    for row in own:
        total[row[0]] = max(total[row[0]], row[1] + 1)
    arrays = _arrays(kept, ids, own, total, cuts, classes, forest) if sum(total) <= ARRAY_NODES else None
    return GrownModel(learner, path, width, classes, arrays)


def _arrays(kept: DataFrame, ids: dict, own: list, total: list[int], cuts: list, classes: int, forest: bool) -> tuple:
    """All trees' nodes behind one another: feature, bin, left child (the right one is next to it; a leaf: its
    place among the leaves, from -1 down), the leaves' votes, the roots, and the cuts."""
    base = np.concatenate([[0], np.cumsum(total)])
    feature, cut, left = np.full(base[-1], -1, np.int8), np.zeros(base[-1], np.uint8), np.full(base[-1], -1, np.int32)
    counts = np.zeros((base[-1], classes))
    for t, i, _, _, stats, _, _, l, _, (f, threshold, _) in own:
        at = base[t] + i
        feature[at], left[at], counts[at] = f, base[t] + l if l >= 0 else -1, stats
        cut[at] = np.searchsorted(cuts[f], threshold[0]) if l >= 0 else 0
    for r in kept.select("tree", "node", "feature", "cut", "left", "counts").toLocalIterator():  # a subtree at a time
        root, offset = ids[r["tree"], r["node"]]
        f = np.frombuffer(r["feature"], np.int16)
        at = base[r["tree"]] + np.concatenate([[root], offset + np.arange(len(f) - 1)]).astype(np.int64)
        l = np.frombuffer(r["left"], np.int32)
        feature[at], cut[at], left[at] = f, np.frombuffer(r["cut"], np.int16), np.where(l >= 0, at[l], -1)
        counts[at] = np.frombuffer(r["counts"]).reshape(-1, classes)
    leaf = np.flatnonzero(left < 0)
    left[leaf] = -1 - np.arange(len(leaf))
    votes = counts[leaf]
    if forest:
        whole = np.zeros(len(leaf))
        for c in range(classes):
            whole += votes[:, c]
        votes = np.where(whole[:, None] != 0, votes / np.where(whole == 0, 1.0, whole)[:, None], 0.0)
    return feature, cut, left, votes, base[:-1], cuts


def votes_by(sent):
    """A function of feature columns: each row's votes by class, summed up in the order of the trees."""

    @F.arrow_udf("array<double>")
    def votes(x: pa.Array) -> pa.Array:
        feature, cut, left, leaves, roots, cuts = sent.value
        values = np.asarray(x.flatten(), float).reshape(len(x), len(cuts))
        codes = np.stack([np.searchsorted(c, values[:, f], side="left") for f, c in enumerate(cuts)], 1).astype(np.uint8)
        out = np.zeros((len(x), leaves.shape[1]))
        for root in roots:
            at = np.full(len(x), root, np.int64)
            moving = np.flatnonzero(left[at] >= 0)
            while len(moving):
                node = at[moving]
                at[moving] = left[node] + (codes[moving, feature[node]] > cut[node])
                moving = moving[left[at[moving]] >= 0]
            out += leaves[-1 - left[at]]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))

    return votes


class GrownModel(Model):
    """Trees grown by ``fit_grown``: ``path`` holds their nodes as Spark's models keep them."""

    def __init__(self, learner, path: str, width: int, classes: int, arrays: tuple | None):
        super().__init__()
        self.learner, self.path, self.width, self.classes = learner, path, width, classes
        self.forest, self._arrays, self._sent, self._native = isinstance(learner, RandomForestClassifier), arrays, None, None

    def native(self):
        """Spark's own model of these nodes (on the driver, as those are)."""
        if self._native is None:
            from pyspark.sql import SparkSession

            spark, learner = SparkSession.getActiveSession(), self.learner
            few = [(Vectors.dense([0.0] * self.width), float(c)) for c in range(self.classes)]
            path = shared_scratch(spark, "grown-model")
            learner.fit(spark.createDataFrame(few, [learner.getFeaturesCol(), learner.getLabelCol()])).write().save(path)
            spark.read.parquet(f"{self.path}/data").write.mode("overwrite").parquet(f"{path}/data")
            self._native = (RandomForestClassificationModel if self.forest else DecisionTreeClassificationModel).load(path)
        return self._native

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        return getattr(self.native(), name)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from clickpipe.plans import node_table

        names = [self.learner.getOrDefault(c) for c in ("rawPredictionCol", "probabilityCol", "predictionCol")]
        if self._arrays is None:
            out = node_table.predict(self, dataset, self.learner.getFeaturesCol(), names=("_votes", "_best")).drop("_best")
        else:
            if self._sent is None:
                self._sent = dataset.sparkSession.sparkContext.broadcast(self._arrays)
            out = dataset.withColumn("_votes", votes_by(self._sent)(vector_to_array(self.learner.getFeaturesCol())))
        whole = F.aggregate("_votes", F.lit(0.0), lambda a, b: a + b)
        out = out.withColumn("_whole", whole)
        made = (array_to_vector("_votes"), array_to_vector(F.transform("_votes", lambda v: F.when(F.col("_whole") != 0, v / F.col("_whole")).otherwise(v))),
                F.array_position("_votes", F.array_max("_votes")).cast("double") - 1)  # ties: the first class
        return out.select(*dataset.columns, *[c.alias(n) for c, n in zip(made, names) if n])
