"""Count boosting with a log link, error curves, and sums of trees as one vectorised model.

MLlib grows the trees; what it lacks is built on top: Poisson deviance with
leaf values estimated anew by an aggregate, the error after every tree, the
kept number of trees by patience, and a model of the kept trees only.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfspan.session import discard, settle

#: A leaf without any sales would have an infinite value; margins move by at most this much.
LEAST_STEP = -8.0


def tree_arrays(tree, scale: float = 1.0) -> dict[str, list]:
    """Feature, threshold, children, value and leaf number of each node of a fitted MLlib tree, root first.

    Leaves are numbered from left to right, as MLlib numbers them.
    """
    out: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "value": [], "leaf": []}
    leaves = 0

    def walk(node) -> int:
        nonlocal leaves
        at = len(out["feature"])
        inner = node.subtreeDepth() > 0
        for name, first in (("feature", -1), ("threshold", 0.0), ("left", at), ("right", at), ("value", 0.0), ("leaf", -1)):
            out[name].append(first)
        if inner:
            split = node.split()
            out["feature"][at], out["threshold"][at] = split.featureIndex(), split.threshold()
            out["left"][at], out["right"][at] = walk(node.leftChild()), walk(node.rightChild())
        else:
            out["value"][at], out["leaf"][at] = scale * node.prediction(), leaves
            leaves += 1
        return at

    walk(tree._java_obj.rootNode())
    return out


def evaluate_trees(trees: Sequence[dict[str, list]], x: np.ndarray) -> np.ndarray:
    """Sum of the leaf values that the rows of ``x`` reach."""
    total = np.zeros(len(x))
    each = np.arange(len(x))
    for tree in trees:
        feature, threshold, left, right, value = (np.asarray(tree[c]) for c in ("feature", "threshold", "left", "right", "value"))
        node = np.zeros(len(x), np.int64)
        while True:
            inner = feature[node] >= 0
            if not inner.any():
                break
            low = x[each, np.maximum(feature[node], 0)] <= threshold[node]
            node = np.where(inner, np.where(low, left[node], right[node]), node)
        total += value[node]
    return total


class _TreeSumParams(Params):
    trees = Param(Params._dummy(), "trees", "node arrays of the trees as JSON", TypeConverters.toString)
    base = Param(Params._dummy(), "base", "value before the first tree", TypeConverters.toFloat)
    link = Param(Params._dummy(), "link", "identity or log", TypeConverters.toString)
    curve = Param(Params._dummy(), "curve", "errors after each tree as JSON", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)


class TreeSum(Model, _TreeSumParams, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts by a sum of trees behind a link; a plan of one step for any number of trees."""

    def __init__(self):
        super().__init__()
        self._setDefault(trees="[]", base=0.0, link="identity", curve="[]", featuresCol="features", predictionCol="prediction")

    @property
    def getNumTrees(self) -> int:
        return len(json.loads(self.getOrDefault(self.trees)))

    def named(self, column: str) -> TreeSum:
        """The same model with another prediction column."""
        return self.copy({self.predictionCol: column})

    def history(self, spark: SparkSession) -> DataFrame:
        """``iteration, train_error, valid_error`` after each tree that was grown, the kept ones and those beyond."""
        rows = [(n, a, b) for n, (a, b) in enumerate(json.loads(self.getOrDefault(self.curve)), 1)]
        return spark.createDataFrame(rows, "iteration int, train_error double, valid_error double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, base = json.loads(self.getOrDefault(self.trees)), self.getOrDefault(self.base)

        @F.pandas_udf("double")
        def margin(features: pd.Series) -> pd.Series:
            return pd.Series(base + (evaluate_trees(trees, np.vstack(features.to_numpy())) if len(features) else np.zeros(0)))

        value = margin(vector_to_array(F.col(self.getOrDefault(self.featuresCol))))
        linked = F.exp(value) if self.getOrDefault(self.link) == "log" else value
        return dataset.withColumn(self.getOrDefault(self.predictionCol), linked)


def kept_by_patience(errors: Sequence[float], patience: int) -> int:
    """Number of trees with the least error before ``patience`` trees in a row brought no better one."""
    best = 0
    for n, error in enumerate(errors):
        if error < errors[best]:
            best = n
        elif n - best >= patience:
            break
    return best + 1 if len(errors) else 0


def boosting_history(model: GBTRegressionModel, train: DataFrame, valid: DataFrame) -> list[tuple[float, float]]:
    """RMSE on training and validation rows after each tree, each in one pass over its rows."""
    errors = [[math.sqrt(e) for e in model.evaluateEachIteration(rows, "squared")] for rows in (train, valid)]
    return list(zip(*errors, strict=True))


def cut_at_best(model: GBTRegressionModel, train: DataFrame, valid: DataFrame, patience: int = 100) -> TreeSum:
    """The trees of a fitted squared-loss model up to the best iteration, with the whole curve."""
    curve = boosting_history(model, train, valid)
    kept = kept_by_patience([v for _, v in curve], patience)
    arrays = [tree_arrays(t, w) for t, w in zip(model.trees[:kept], model.treeWeights[:kept], strict=True)]
    cut = TreeSum()
    return cut._set(trees=json.dumps(arrays), curve=json.dumps(curve), featuresCol=model.getFeaturesCol(), predictionCol=model.getPredictionCol())


def poisson_deviance(y: Column, mu: Column) -> Column:
    """Twice the log-likelihood a row loses against a perfect prediction."""
    return 2 * (F.when(y > 0, y * F.ln(y / mu)).otherwise(0.0) - (y - mu))


class _PoissonParams(Params):
    trees = Param(Params._dummy(), "trees", "largest number of trees", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "depth of a tree", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of a leaf's step that is taken", TypeConverters.toFloat)
    rows = Param(Params._dummy(), "rows", "share of rows a tree is grown on", TypeConverters.toFloat)
    minRows = Param(Params._dummy(), "minRows", "least rows of a leaf", TypeConverters.toInt)
    patience = Param(Params._dummy(), "patience", "trees without a better validation error before growing ends", TypeConverters.toInt)
    validationCol = Param(Params._dummy(), "validationCol", "flag of validation rows; empty for none", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "count to predict", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)


class PoissonBoosting(Estimator, _PoissonParams, DefaultParamsReadable, DefaultParamsWritable):
    """Gradient boosting of counts on the log scale.

    A tree is grown on the working response y - exp(margin). Its leaves are
    then estimated anew as log(sum of y / sum of exp(margin)), an aggregate of
    at most 2^depth rows. Rows with their margin are written after every tree,
    which cuts the lineage, and both deviances are observed by that write.
    """

    @keyword_only
    def __init__(self, *, trees=500, depth=6, rate=0.05, rows=1.0, minRows=5, patience=100, validationCol="", labelCol="demand", featuresCol="features", seed=42):
        super().__init__()
        self._setDefault(trees=500, depth=6, rate=0.05, rows=1.0, minRows=5, patience=100, validationCol="", labelCol="demand", featuresCol="features", seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TreeSum:
        get = {p.name: self.getOrDefault(p) for p in self.params}
        valid = F.col(get["validationCol"]) if get["validationCol"] else F.lit(False)
        rows = dataset.select(F.col(get["featuresCol"]).alias("features"), F.col(get["labelCol"]).cast("double").alias("y"), F.coalesce(valid, F.lit(False)).alias("valid"))
        mean = rows.where("not valid").agg(F.avg("y")).first()[0]
        model = TreeSum()._set(link="log", featuresCol=get["featuresCol"], base=math.log(mean) if mean else LEAST_STEP)
        if not mean:
            return model
        base = model.getOrDefault(model.base)
        rows = settle(rows.withColumn("margin", F.lit(base)), "boost")
        arrays, curve = [], []
        for n in range(get["trees"]):
            response = rows.withColumn("_r", F.col("y") - F.exp("margin"))
            grown = response.where("not valid")
            grown = grown.sample(get["rows"], get["seed"] + n) if get["rows"] < 1 else grown
            tree = DecisionTreeRegressor(labelCol="_r", maxDepth=get["depth"], minInstancesPerNode=get["minRows"], seed=get["seed"] + n, leafCol="_leaf").fit(grown.select("features", "_r"))
            nodes = tree_arrays(tree)
            placed = tree.transform(rows)
            sums = placed.where("not valid").groupBy("_leaf").agg(F.sum("y").alias("y"), F.sum(F.exp("margin")).alias("mu")).collect()
            steps = [0.0] * (max(nodes["leaf"]) + 1)
            for leaf in sums:
                steps[int(leaf["_leaf"])] = get["rate"] * max(math.log(leaf["y"] / leaf["mu"]) if leaf["y"] > 0 else LEAST_STEP, LEAST_STEP)
            nodes["value"] = [steps[leaf] if leaf >= 0 else 0.0 for leaf in nodes["leaf"]]
            moved = F.col("margin") + F.get(F.array(*[F.lit(s) for s in steps]), F.col("_leaf").cast("int"))
            seen = Observation()
            loss = poisson_deviance(F.col("y"), F.exp("margin"))
            after = placed.select("features", "y", "valid", moved.alias("margin")).observe(seen, F.avg(F.when(~F.col("valid"), loss)).alias("train"), F.avg(F.when(F.col("valid"), loss)).alias("valid"))
            before, rows = rows, settle(after, "boost")
            discard(before)
            arrays.append(nodes)
            curve.append((seen.get["train"], seen.get["valid"]))
            errors = [t if v is None else v for t, v in curve]
            if n + 1 - kept_by_patience(errors, len(errors)) >= get["patience"]:
                break
        discard(rows)
        kept = kept_by_patience([t if v is None else v for t, v in curve], get["patience"])
        return model._set(trees=json.dumps(arrays[:kept]), curve=json.dumps(curve))
