"""Forests whose bags are known: every row's weight in every tree follows from the row's keys.

A weight is a Poisson draw, as a bootstrap's is, taken from a hash. So the rows that a tree never saw are
known wherever the forest goes, and their votes give the out-of-bag score without a second data set.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn import fixed
from cairn.functions.values import hash_bucket, percent
from cairn.session import spread, staged

DEEPEST = 30  # Spark's deepest tree, standing for "no limit"

#: A row's hash is a number below this prime; a tree multiplies and shifts it by two powers of a generator.
PRIME, GENERATOR = 2 ** 31 - 1, 48271
#: Where the draws 1, 2, ... of a Poisson distribution of mean 1 begin, on the scale of the prime.
STEPS = [math.floor(PRIME * math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1))) for k in range(8)]


def row_hash(keys: list[Column]) -> Column:
    """A number from 0 to ``PRIME - 1``, fixed by the keys."""
    return (hash_bucket(keys, PRIME) - 1).cast("bigint")


def tree_factors(tree: int, seed: int) -> tuple[int, int]:
    return tuple(pow(GENERATOR, 2 * (tree + 1) + 1000 * seed + k, PRIME) for k in (0, 1))


def bag_weight(row: Column, tree: int, seed: int = 17) -> Column:
    """How often a tree's bag holds the row with this hash; 0 means that the tree never sees it."""
    times, plus = tree_factors(tree, seed)
    place = (row * F.lit(times) + F.lit(plus)) % F.lit(PRIME)
    return reduce(lambda a, b: a + b, [(place >= F.lit(step)).cast("int") for step in STEPS])


def train_bagged(matrix: DataFrame, features: list[str], keys: Iterable[str], label: str = "label",
                 trees: int = fixed.FOREST_TREES, depth: int | None = fixed.FOREST_DEPTH, subset: str = "sqrt",
                 seed: int = 17, bins: int = 32, parallelism: int = 8, path: str | None = None) -> PipelineModel:
    """Fit a forest tree by tree on the bags that ``keys`` decide. NULL features are an error.

    The rows are assembled and written once; each tree reads those of its own bag. ``parallelism`` trees
    grow at a time. The model's stages are the assembler and the trees, and it may be kept at ``path``.
    """
    spark = matrix.sparkSession
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    hashed = matrix.select(*features, label, row_hash([F.col(k) for k in keys]).alias("_row"))
    rows = staged(spread(assembler.transform(hashed).select("features", label, "_row")), "bags")

    def grow(tree: int) -> DecisionTreeClassificationModel:
        bag = rows.withColumn("_weight", bag_weight(F.col("_row"), tree, seed).cast("double")).where("_weight > 0")
        forest = RandomForestClassifier(
            labelCol=label, featuresCol="features", weightCol="_weight", numTrees=1, bootstrap=False, impurity="gini",
            maxDepth=DEEPEST if depth is None else depth, featureSubsetStrategy=subset, seed=seed + tree, maxBins=bins)
        return forest.fit(bag).trees[0]

    with ThreadPool(min(parallelism, trees)) as pool:
        grown = pool.map(inheritable_thread_target(spark)(grow), range(trees))
    model = PipelineModel([assembler, *(_voting(t, k) for k, t in enumerate(grown))])
    if path:
        model.write().overwrite().save(path)
    return model


def _voting(tree: DecisionTreeClassificationModel, number: int) -> DecisionTreeClassificationModel:
    return (tree.setFeaturesCol("features").setProbabilityCol(f"_tree{number}")
            .setRawPredictionCol("").setPredictionCol(""))


def _votes(model: PipelineModel, matrix: DataFrame) -> DataFrame:
    """Add the array of all trees' probabilities of the positive class."""
    # A tree whose bag has one class only knows no second one.
    each = [F.coalesce(F.get(vector_to_array(f"_tree{k}"), F.lit(1)), F.lit(0.0)) for k in range(len(model.stages) - 1)]
    return model.transform(matrix).select(*matrix.columns, F.array(*each).alias("_votes"))


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)


def score_bagged(model: PipelineModel, matrix: DataFrame) -> DataFrame:
    """Add ``prediction`` and ``percent``, as a forest's ``score`` does."""
    voted = _votes(model, matrix).withColumn("_vote", _mean(F.col("_votes")))
    return voted.withColumns({"prediction": (F.col("_vote") > 0.5).cast("double"), "percent": percent(F.col("_vote"))}).drop(
        "_votes", "_vote")


def out_of_bag(model: PipelineModel, matrix: DataFrame, keys: Iterable[str], seed: int = 17) -> DataFrame:
    """Add ``n_out``, the trees that never saw the row, and their mean ``vote`` and ``prediction``.

    ``keys`` and ``seed`` are those of the training. A row that every tree saw has no vote.
    """
    row, trees = F.col("_row"), len(model.stages) - 1
    hashed = matrix.withColumn("_row", row_hash([F.col(k) for k in keys]))
    bags = F.array(*(bag_weight(row, t, seed) for t in range(trees)))
    voted = _votes(model, hashed).withColumn("_out", F.filter(
        F.zip_with("_votes", bags, lambda v, w: F.when(w == 0, v)), lambda v: v.isNotNull()))
    named = voted.withColumns({"n_out": F.size("_out"), "vote": F.when(F.size("_out") > 0, _mean(F.col("_out")))})
    return named.withColumn("prediction", (F.col("vote") > 0.5).cast("double")).drop("_row", "_votes", "_out")


def importances(model: PipelineModel, features: list[str]) -> list[tuple[str, float]]:
    """``(feature, percent)``, largest first: each tree's importances add up to one and count alike."""
    grown = [tree.featureImportances.toArray() for tree in model.stages[1:]]
    whole = sum(sum(one) for one in grown) or 1.0
    shares = [(name, float(100 * sum(one[k] for one in grown) / whole)) for k, name in enumerate(features)]
    return sorted(shares, key=lambda r: (-r[1], r[0]))


def oob_score(out: DataFrame, label: str = "label") -> DataFrame:
    """One row: the share of rows that the trees which never saw them predict right, and how many have a vote."""
    return out.where("n_out > 0").agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("oob_score"),
                                      F.count(F.lit(1)).alias("rows"))
