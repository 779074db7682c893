"""Train, evaluate and keep the success model; score all entities with default inputs."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn import fixed
from cairn.operators import bagging, features, forest
from cairn.session import spread, staged


def model_matrix(rows: DataFrame, keys: list[str], target: str, positive: str = "Y",
                 schema: dict = fixed.FEATURES) -> DataFrame:
    """Keys, features, label, holdout flag and training fold in one projection."""
    names = list(features.feature_columns(schema))
    labelled = rows.select("*", features.label(F.col(target) == positive).alias("_label"))
    cols = [F.col(k) for k in keys]
    return (features.feature_matrix(labelled, schema, keys=[*keys, "_label"])
            .select(*keys, *names, F.col("_label").alias("label"),
                    forest.is_holdout(cols).alias("holdout"),
                    forest.training_fold(cols).alias("fold")))


def train_evaluate(matrix: DataFrame, schema: dict = fixed.FEATURES,
                   trees: int = fixed.FOREST_TREES, depth: int | None = fixed.FOREST_DEPTH,
                   invalid: str = "error", model_path: str | None = None
                   ) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training rows and measure accuracy on both parts.

    ``train_out_of_bag`` reports the out-of-bag score, too.
    """
    names = list(features.feature_columns(schema))
    if invalid == "skip":
        matrix = features.complete_rows(matrix, schema)
    # The forest passes over its rows many times and the report once more.
    matrix = staged(spread(matrix), "matrix")
    model = forest.train(matrix.where(~F.col("holdout")), names, trees=trees, depth=depth,
                         invalid=invalid, path=model_path)
    scored = forest.score(model, matrix)
    report = (scored.groupBy("holdout")
              .agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))
                   .alias("accuracy"), F.count(F.lit(1)).alias("rows")))
    return model, report


def train_out_of_bag(matrix: DataFrame, keys: list[str], schema: dict = fixed.FEATURES,
                     trees: int = fixed.FOREST_TREES, depth: int | None = fixed.FOREST_DEPTH, subset: str = "sqrt",
                     parallelism: int = 8, model_path: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training rows in known bags; report the out-of-bag score and the held-out accuracy.

    ``keys`` tell rows apart: rows of equal keys are in the same bags. Returns the model, which
    ``bagging.score_bagged`` applies, and ``part, accuracy, rows``.
    """
    matrix = staged(spread(matrix), "matrix")
    inner, outer = matrix.where(~F.col("holdout")), matrix.where("holdout")
    model = bagging.train_bagged(inner, list(features.feature_columns(schema)), keys, trees=trees, depth=depth,
                                 subset=subset, parallelism=parallelism, path=model_path)
    unseen = bagging.oob_score(bagging.out_of_bag(model, inner, keys)).select(
        F.lit("out_of_bag").alias("part"), F.col("oob_score").alias("accuracy"), "rows")
    held = forest.accuracy(bagging.score_bagged(model, outer)).select(F.lit("holdout").alias("part"), "accuracy", "rows")
    return model, unseen.unionByName(held)


def _scored(matrix: DataFrame, entity_key: str, model: PipelineModel, schema: dict) -> DataFrame:
    """An entity that lacks a value the model needs has a NULL percent."""
    return forest.score(model, features.filled_rows(matrix, schema)).select(
        entity_key, F.when(F.col("_complete"), F.col("percent")).alias("percent"))


def score_defaults(entities: DataFrame, entity_key: str, model: PipelineModel,
                   schema: dict = fixed.FEATURES, defaults: dict = fixed.REQUEST_DEFAULTS
                   ) -> DataFrame:
    """Score every entity as if asked with nothing but defaults: constants, so no join."""
    filled = entities.withColumns({c: F.lit(v).cast(k) for c, (k, v) in defaults.items()})
    matrix = features.feature_matrix(filled, schema, keys=[entity_key])
    return _scored(matrix, entity_key, model, schema)


def score_one(entities: DataFrame, entity_key: str, model: PipelineModel, request: dict,
              schema: dict = fixed.FEATURES, defaults: dict = fixed.REQUEST_DEFAULTS,
              entity_features: tuple[str, ...] = ("himal", "height")) -> DataFrame:
    """Score every entity for one request: its values overlaid on the default matrix."""
    filled = entities.withColumns({c: F.lit(v).cast(k) for c, (k, v) in defaults.items()})
    matrix = features.feature_matrix(filled, schema, keys=[entity_key])
    record = {c: request.get(c, v) for c, (_, v) in defaults.items()}
    matrix = features.overlay(matrix, record, schema, ignore=entity_features)
    return _scored(matrix, entity_key, model, schema)
