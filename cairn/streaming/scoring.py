"""Scoring requests against every entity, as a batch or as a stream.

Requests are JSON bodies. Each is checked, filled with defaults and paired with every entity;
the pairs are what the caller asked for. Requests meet chunks of entities by the chunk's number, so
Spark broadcasts the chunks while they are small and spreads them otherwise.
"""

from __future__ import annotations

import hashlib

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cairn import fixed
from cairn.operators.features import feature_matrix, filled_rows
from cairn.operators.forest import score
from cairn.session import spread
from cairn.sources.versions import read_all, write_version


def parse_requests(requests: DataFrame, body: str = "body",
                   defaults: dict = fixed.REQUEST_DEFAULTS) -> DataFrame:
    """Add one typed column per request field and ``reason``, NULL for a good request.

    A missing key takes its default. A key that is there with a value of the wrong type is a
    reason for rejection, never a default.
    """
    parsed = requests.withColumn("_v", F.try_parse_json(F.col(body)))
    is_object = F.coalesce(F.schema_of_variant(F.col("_v")).startswith("OBJECT"), F.lit(False))

    def raw(name: str) -> Column:
        return F.try_variant_get(F.col("_v"), f"$.{name}", "variant")

    def typed(name: str, kind: str) -> Column:
        value = F.try_variant_get(F.col("_v"), f"$.{name}", kind)
        # A JSON null is text to a text field, as str(None) is.
        return F.coalesce(value, F.lit("None")) if kind == "string" else value

    wrong = [F.when(raw(name).isNotNull() & typed(name, kind).isNull(), f"bad {name}")
             for name, (kind, _) in defaults.items()]
    return parsed.select(
        *requests.columns,
        *[F.when(raw(name).isNull(), F.lit(default).cast(kind)).otherwise(typed(name, kind))
          .alias(name) for name, (kind, default) in defaults.items()],
        F.when(~is_object, "not a JSON object").otherwise(F.coalesce(*wrong)).alias("reason"),
    )


def rejected(parsed: DataFrame, key: str) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select(key, "reason")


def request_grid(parsed: DataFrame, entities: DataFrame, key: str, chunk: int = 256) -> DataFrame:
    """Every good request paired with every entity.

    Entities are packed into chunks of about ``chunk`` rows. A request meets each chunk once, by the
    chunk's number, and the chunk's rows come out of it within the task, so neither side is copied
    more than the chunks ask for, however many partitions the cluster uses.
    """
    chunks = max(1, -(-entities.count() // chunk))
    names = entities.columns
    packed = (entities.groupBy(F.pmod(F.xxhash64(*names), F.lit(chunks)).cast("int").alias("_chunk"))
              .agg(F.collect_list(F.struct(*names)).alias("_rows")))
    asked = (parsed.where(F.col("reason").isNull()).drop("reason")
             .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    return (asked.join(packed, "_chunk").drop("_chunk")
            .select("*", F.inline("_rows")).drop("_rows"))


def score_requests(requests: DataFrame, entities: DataFrame, model: PipelineModel, key: str,
                   entity_key: str, schema: dict = fixed.FEATURES,
                   defaults: dict = fixed.REQUEST_DEFAULTS, body: str = "body") -> DataFrame:
    """``key, entity_key, percent`` for every good request and every entity, batch or stream.

    An entity that lacks a value the model needs stays in the answer, with a NULL percent.
    """
    grid = request_grid(parse_requests(requests, body, defaults), entities, key)
    matrix = feature_matrix(grid, schema, keys=[key, entity_key])
    return (score(model, filled_rows(matrix, schema), many=True)
            .select(key, entity_key, F.when(F.col("_complete"), F.col("percent")).alias("percent")))


def score_stream(requests: DataFrame, out_path: str, checkpoint: str, entities: DataFrame,
                 model: PipelineModel, key: str, entity_key: str,
                 defaults: dict = fixed.REQUEST_DEFAULTS, body: str = "body", **options) -> StreamingQuery:
    """Answer a stream of requests until the files at hand are done: scores, and a reason for each bad one.

    Every batch is one version of ``out_path`` with the tables ``scores`` and ``rejects``, committed
    together under the batch's number; ``answered`` reads them. A restarted query repeats the batch
    it was in: what was not committed is written anew, what was is left, so nothing is missing or there
    twice. A checkpoint folder stands for one run of the stream; another one's batches come on top.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def answer(batch: DataFrame, number: int) -> None:
        # Few bytes of requests ask for many rows.
        batch = spread(batch).persist()
        try:
            write_version(out_path, {
                "scores": score_requests(batch, entities, model, key, entity_key, defaults=defaults, body=body, **options),
                "rejects": rejected(parse_requests(batch, body, defaults), key),
            }, version=f"{run}-{number:012d}", ordinal=number)
        finally:
            batch.unpersist()

    return (requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def answered(spark: SparkSession, out_path: str, table: str) -> DataFrame | None:
    """The ``scores`` or ``rejects`` of all committed batches; None before the first one."""
    return read_all(spark, out_path, table)
