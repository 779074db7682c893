"""Random-forest training, evaluation and scoring with Spark ML."""

from __future__ import annotations

import math
import re
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn import fixed
from cairn.functions.values import hash_bucket, percent
from cairn.operators.bagging import DEEPEST
from cairn.session import scratch_folder, spread, staged

# Counts of rows in trees that one task of a fit should keep, four bytes each.
COUNTS_PER_TASK = 40_000_000

# Cells between a model's thresholds whose answers are put in a table.
MOST_CELLS = 100_000


def is_holdout(keys: list[Column]) -> Column:
    """A fifth of the rows, fixed by their keys."""
    return hash_bucket(keys, 5) == 1


def fold(keys: list[Column], folds: int = 10) -> Column:
    """Fold number 1..folds, fixed by the keys."""
    return hash_bucket(keys, folds)


def training_fold(keys: list[Column]) -> Column:
    """Fold 0..7 of a training row.

    Buckets of five and ten come from one hash, so the holdout takes ten-folds 1 and 6 whole and
    training rows only ever see the other eight; these are numbered without gaps.
    """
    ten = fold(keys, 10)
    return F.when(ten.isin(1, 6), F.lit(None)).when(ten < 6, ten - 2).otherwise(ten - 3).cast("int")


def _forest(label: str, trees: int, depth: int | None, seed: int, bins: int = 32) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", numTrees=trees,
        maxDepth=DEEPEST if depth is None else depth, impurity="gini",
        featureSubsetStrategy="sqrt", bootstrap=True, seed=seed, maxBins=bins)


def dealt(rows: DataFrame, trees: int) -> DataFrame:
    """Rows in as many partitions as their bags ask for.

    While a forest is fitted, Spark keeps each row with a count for every tree, many times what the row takes
    in its file. A few rows stay as they are, so their bags stay the same.
    """
    needed = -(-rows.count() * trees // COUNTS_PER_TASK)
    if needed <= 1:
        return rows
    return rows.repartition(max(needed, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _stages(features: list[str], label: str, trees: int, depth: int | None, seed: int,
            invalid: str, bins: int = 32) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="features", handleInvalid=invalid),
        _forest(label, trees, depth, seed, bins)])


def train(matrix: DataFrame, features: list[str], label: str = "label",
          trees: int = fixed.FOREST_TREES, depth: int | None = fixed.FOREST_DEPTH,
          seed: int = 17, invalid: str = "error", bins: int = 32, path: str | None = None
          ) -> PipelineModel:
    """Fit a forest. NULL features are an error unless ``invalid`` is 'skip'.

    Continuous features are split at ``bins`` quantiles at most. The model is kept at ``path``, or in
    the scratch folder.
    The model is stored and read back: a freshly fitted one drags its training summary, and with
    it the session, into every scoring task.
    """
    fitted = _stages(features, label, trees, depth, seed, invalid, bins).fit(
        dealt(matrix.select(*features, label), trees))
    return load_model(save_model(fitted, path or scratch_folder(matrix.sparkSession, "forest")))


def score(model: PipelineModel, matrix: DataFrame, many: bool = False) -> DataFrame:
    """Add ``prediction`` and ``percent``, the positive class's probability of each row.

    For ``many`` rows the model is asked once for each cell that its thresholds cut out, where these are few.
    """
    if many:
        found = _score_by_cell(model, matrix)
        if found is not None:
            return found
    drop = ["features", "rawPrediction", "probability"]
    return (model.transform(matrix)
            .withColumn("percent", percent(vector_to_array("probability")[1])).drop(*drop))


def _thresholds(model: RandomForestClassificationModel) -> list[list[float]] | None:
    """Sorted distinct thresholds of each feature; None where a split is no threshold."""
    text = model.toDebugString
    if " in {" in text:
        return None
    found = set(re.findall(r"\(feature (\d+) <= ([^)]+)\)", text))
    return [sorted({float(t) for k, t in found if int(k) == feature}) for feature in range(model.numFeatures)]


def _score_by_cell(model: PipelineModel, matrix: DataFrame) -> DataFrame | None:
    """``score`` by a table of the model's own answers; None where that would be too large.

    Trees only ask on which side of a threshold a value lies, so all rows between the same thresholds
    have one answer.
    """
    assembler, trees = model.stages[0], model.stages[-1]
    columns, invalid = assembler.getInputCols(), assembler.getOrDefault("handleInvalid")
    if invalid not in ("error", "skip") or trees.numFeatures != len(columns):
        return None
    cuts = _thresholds(trees)
    if cuts is None or math.prod(len(c) + 1 for c in cuts) > MOST_CELLS:
        return None
    cells, steps, shown = 1, [], []
    for name, own in zip(columns, cuts, strict=True):
        # The last value stands for all beyond the last threshold.
        values = [*own, math.nextafter(own[-1], math.inf)] if own else [0.0]
        shown.append(F.get(F.expr(f"array({', '.join(f'double({v!r})' for v in values)})"),
                           (F.floor(F.col("_cell") / cells) % len(values)).cast("int")).alias(name))
        steps.append((np.array(own), cells))
        cells *= len(values)
    table = score(model, matrix.sparkSession.range(cells).select(F.col("id").alias("_cell")).select("_cell", *shown))
    table = staged(table.select(F.col("_cell").cast("int").alias("_cell"), "prediction", "percent"), "answers")

    @F.arrow_udf("int")
    def cell(*values: pa.Array) -> pa.Array:
        code = np.zeros(len(values[0]), np.int32)
        for own, (cuts, times) in zip(values, steps, strict=True):
            numbers = own.to_numpy(zero_copy_only=False)
            if np.isnan(numbers).any():
                raise ValueError("a feature has no value")
            code += times * np.searchsorted(cuts, numbers).astype(np.int32)
        return pa.array(code)

    rows = matrix
    if invalid == "skip":
        rows = matrix.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns]))
    rows = rows.withColumn("_cell", cell.asNondeterministic()(*[F.col(c).cast("double") for c in columns]))
    return rows.join(table, "_cell").select(*matrix.columns, "prediction", "percent")


def accuracy(predicted: DataFrame, prediction: str = "prediction", label: str = "label"
             ) -> DataFrame:
    """One row: the share of rows predicted right, and how many rows there were."""
    return predicted.agg(
        F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("rows"))


def importances(spark: SparkSession, model: PipelineModel, features: list[str]) -> DataFrame:
    """Feature importances in percent, largest first. One row per feature."""
    weights = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(name, float(100 * w)) for name, w in zip(features, weights)],
        T.StructType.fromDDL("feature STRING, importance DOUBLE")
    ).orderBy(F.desc("importance"), "feature")


def forest_nodes(model: RandomForestClassificationModel) -> pd.DataFrame:
    """``tree, id, left, right, feature, threshold, share`` of all nodes, by tree and id, from the stored model.

    ``share`` is the positive class's part of the training rows that reached the node; leaves have no
    feature (-1). The model is held by the driver in any case.
    """
    path = save_model(model, scratch_folder(SparkSession.active(), "grown"))
    node, split = "nodeData", "nodeData.split"
    stats = F.col(f"{node}.impurityStats")
    whole = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    rows = SparkSession.active().read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), f"{node}.id", F.col(f"{node}.leftChild").alias("left"),
        F.col(f"{node}.rightChild").alias("right"), F.col(f"{split}.featureIndex").alias("feature"),
        F.coalesce(F.get(f"{split}.leftCategoriesOrThreshold", F.lit(0)), F.lit(0.0)).alias("threshold"),
        (F.coalesce(F.get(stats, F.lit(1)), F.lit(0.0)) / whole).alias("share"))
    return rows.toPandas().sort_values(["tree", "id"], ignore_index=True)


def setting_predictions(nodes: pd.DataFrame, sizes: list[int], depths: list[int]):
    """A vectorised function of feature arrays: the class that each setting predicts, sizes within depths.

    A setting is the forest's first trees, cut at a depth. Every tree is walked once for all settings.
    """
    trees = [t[["left", "right", "feature", "threshold", "share"]].to_numpy().T for _, t in nodes.groupby("tree")]

    @F.pandas_udf("array<double>")
    def predict(features: pd.Series) -> pd.Series:
        x = np.stack(features.to_numpy()) if len(features) else np.zeros((0, 1))
        at_row, total = np.arange(len(x)), np.zeros((len(depths), len(x)))
        found = np.zeros((len(x), len(depths), len(sizes)))
        for number, (left, right, feature, threshold, share) in enumerate(trees[:max(sizes)], start=1):
            node, ends = np.zeros(len(x), int), {}
            for level in range(max(depths) + 1):
                ends[level] = share[node]
                inner = feature[node] >= 0
                if not inner.any():
                    break
                low = x[at_row, np.maximum(feature[node], 0).astype(int)] <= threshold[node]
                node = np.where(inner, np.where(low, left[node], right[node]), node).astype(int)
            for k, depth in enumerate(depths):
                total[k] += ends[min(depth, max(ends))]
            for k in (k for k, n in enumerate(sizes) if n == number):
                found[:, :, k] = (total > number - total).T
        return pd.Series(list(found.reshape(len(x), -1)))

    return predict


def setting_accuracy(model: RandomForestClassificationModel, rows: DataFrame, sizes: list[int], depths: list[int],
                     label: str = "label") -> dict[tuple[int, int], float]:
    """``(size, depth)`` -> accuracy, for the forest's first trees cut at a depth; one pass over the rows."""
    predict = setting_predictions(forest_nodes(model), sizes, depths)
    settings = [(n, d) for d in depths for n in sizes]
    told = rows.select(label, predict(vector_to_array("features")).alias("told"))
    right = [F.avg((F.get("told", F.lit(k)) == F.col(label)).cast("double")).alias(f"s{k}") for k in range(len(settings))]
    return dict(zip(settings, told.agg(*right).first(), strict=True))


def grid_search(matrix: DataFrame, features: list[str], fold_column: str, label: str = "label",
                trees: list[int] = fixed.GRID_TREES, depths: list[int | None] = fixed.GRID_DEPTHS,
                seed: int = 17, parallelism: int = 4) -> tuple[PipelineModel, DataFrame]:
    """Search tree counts and depths by leave-one-fold-out accuracy; refit the best.

    Settings share their trees: for each fold one forest of the largest size and depth is grown. A smaller
    forest is its first trees, and a shallower tree is a deeper one cut, as a tree grows from its root
    whatever its depth will be. Returns the refitted model and one row per setting; the best one has the
    highest accuracy, then the fewest trees, then the least depth.
    """
    spark = matrix.sparkSession
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    rows = staged(spread(assembler.transform(matrix).select("features", label, fold_column)), "grid")
    folds = rows.agg(F.max(fold_column)).first()[0] + 1
    deep = [DEEPEST if d is None else d for d in depths]

    def search(number: int) -> dict[tuple[int, int], float]:
        grown = _forest(label, max(trees), max(deep), seed).fit(
            dealt(rows.where(F.col(fold_column) != number), max(trees)))
        return setting_accuracy(grown, rows.where(F.col(fold_column) == number), trees, deep, label)

    with ThreadPool(parallelism) as pool:
        found = pool.map(inheritable_thread_target(spark)(search), range(folds))
    table = [(n, d, sum(one[n, d] for one in found) / folds) for n in trees for d in deep]
    best = min(table, key=lambda r: (-r[2], r[0], r[1]))
    model = train(matrix, features, label, trees=best[0], depth=best[1], seed=seed)
    frame = spark.createDataFrame(table, T.StructType.fromDDL("trees INT, depth INT, accuracy DOUBLE"))
    return model, frame.orderBy(F.desc("accuracy"), "trees", "depth")


def save_model(model: PipelineModel | RandomForestClassificationModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
