"""Features, forests and request scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn import fixed
from cairn.operators import bagging, features, forest
from cairn.plans import training
from cairn.queries import query
from cairn.queries.words import _bucket_sql
from cairn.session import scratch_folder, spread, staged, staged_at
from cairn.streaming import scoring

SCHEMA = {
    "price": {"column": "o_totalprice"},
    "priority": {"type": "categorical", "column": "o_orderpriority",
                 "values": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]},
    "open": {"type": "indicator", "column": "o_orderstatus", "value": "O"},
    "balance": {"column": "c_acctbal"},
    "segment": {"type": "categorical", "column": "c_mktsegment",
                "values": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]},
}


def _orders(t):
    return t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))


def _equals(column: str, values: list[str], feature: str) -> str:
    return ", ".join(f"""CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS "{feature}_{v.lower()}\""""
                     for v in values)


_DUMMIES = (_equals("o_orderpriority", SCHEMA["priority"]["values"], "priority")
            + ", CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS open")


@query("feature_matrix", f"""
    SELECT o_orderkey, o_totalprice AS price, {_DUMMIES}, c_acctbal AS balance,
           {_equals("c_mktsegment", SCHEMA["segment"]["values"], "segment")},
           CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS label
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def feature_matrix(t):
    rows = _orders(t).withColumn("label", features.label(F.col("o_orderstatus") == "F"))
    return features.feature_matrix(rows, SCHEMA, keys=["o_orderkey", "label"])


@query("feature_overlay", f"""
    SELECT o_orderkey, 1000.0::DOUBLE AS price,
           {", ".join(f'{int(v == "2-HIGH")} AS "priority_{v.lower()}"'
                      for v in SCHEMA["priority"]["values"])}, 0 AS open, c_acctbal AS balance,
           {_equals("c_mktsegment", SCHEMA["segment"]["values"], "segment")}
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def feature_overlay(t):
    matrix = features.feature_matrix(_orders(t), SCHEMA, keys=["o_orderkey"])
    return features.overlay(
        matrix, {"o_totalprice": 1000, "o_orderpriority": "2-HIGH", "o_orderstatus": "P"},
        SCHEMA, ignore={"balance", "segment"})


# Events as requests: their properties are the body; some kinds come without, or spoiled.
DEFAULTS = {"k": ("int", 7), "mode": ("string", "N")}


def _requests(t):
    kind = F.col("event_type")
    return t("events").select("event_id", F.when(kind == "error", "no json")
                              .when(kind == "view", "{}").when(kind == "click", '{"k": "x"}')
                              .when(kind == "signup", '{"k": "12", "mode": "Y", "more": 1}')
                              .otherwise(F.col("props")).alias("body"))


_GRID = """
    SELECT event_id, n_nationkey, CASE event_type WHEN 'view' THEN 7 WHEN 'signup' THEN 12
           ELSE CAST(json_extract_string(props, '$.k') AS INT) END AS k,
           CASE event_type WHEN 'signup' THEN 'Y' ELSE 'N' END AS mode
    FROM events JOIN nation ON event_type IN ('view', 'signup', 'purchase')"""


@query("score_grid", _GRID)
def score_grid(t):
    parsed = scoring.parse_requests(_requests(t), defaults=DEFAULTS)
    return scoring.request_grid(parsed, t("nation").select("n_nationkey"), "event_id").select(
        "event_id", "n_nationkey", "k", "mode")


@query("request_rejects", """
    SELECT event_id, CASE event_type WHEN 'error' THEN 'not a JSON object' ELSE 'bad k' END AS reason
    FROM events WHERE event_type IN ('error', 'click')""")
def request_rejects(t):
    return scoring.rejected(scoring.parse_requests(_requests(t), defaults=DEFAULTS), "event_id")


@query("stream_request_grid", _GRID)
def stream_request_grid(t):
    spark = t("events").sparkSession
    folder = scratch_folder(spark, "requests")
    stream = spark.readStream.schema(staged_at(_requests(t), folder).schema).parquet(folder)
    grid = scoring.request_grid(scoring.parse_requests(stream, defaults=DEFAULTS),
                                t("nation").select("n_nationkey"), "event_id")
    out = scratch_folder(spark, "grid")
    (grid.select("event_id", "n_nationkey", "k", "mode").writeStream.format("parquet")
     .option("path", out).option("checkpointLocation", scratch_folder(spark, "progress"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out)


# A forest that tells finished orders from price, priority and customer.
MODEL_SCHEMA = {name: spec for name, spec in SCHEMA.items() if name != "open"}
MODEL_FEATURES = list(features.feature_columns(MODEL_SCHEMA))


def _matrix(t):
    return training.model_matrix(_orders(t), ["o_orderkey"], "o_orderstatus", "F", MODEL_SCHEMA)


@query("rf_train_score")
def rf_train_score(t):
    matrix = _matrix(t)
    path = scratch_folder(matrix.sparkSession, "model")
    training.train_evaluate(matrix, MODEL_SCHEMA, model_path=path)
    return forest.score(forest.load_model(path), matrix).select("o_orderkey", "percent")


@query("rf_holdout_accuracy")
def rf_holdout_accuracy(t):
    _, report = training.train_evaluate(_matrix(t), MODEL_SCHEMA)
    return report


@query("rf_importance")
def rf_importance(t):
    matrix = _matrix(t)
    model = forest.train(staged(spread(matrix.where(~F.col("holdout"))), "matrix"), MODEL_FEATURES)
    return forest.importances(matrix.sparkSession, model, MODEL_FEATURES)


@query("grid_search")
def grid_search(t):
    # All settings of the full grid on all document labels.
    rows = t("documents").join(t("labels"), "doc_id").select(
        "doc_id", "n_chars", "lang", F.when(F.col("quality") == 1, "Y").alias("good"))
    schema = {"length": {"column": "n_chars"},
              "lang": {"type": "categorical", "column": "lang", "values": ["en", "de", "es"]}}
    matrix = staged(spread(training.model_matrix(rows, ["doc_id"], "good", "Y", schema)
                           .where(~F.col("holdout"))), "matrix")
    _, table = forest.grid_search(matrix, list(features.feature_columns(schema)), "fold")
    return table


REQUEST_SCHEMA = {
    "price": {"column": "o_totalprice"},
    "priority": {"type": "indicator", "column": "priority", "value": "2-HIGH"},
    "balance": {"column": "c_acctbal"},
}
REQUEST_DEFAULTS = {"o_totalprice": ("double", 1000.0), "priority": ("string", "5-LOW")}


@query("stream_scoring")
def stream_scoring(t):
    rows = _orders(t).withColumn("priority", F.col("o_orderpriority"))
    matrix = training.model_matrix(rows, ["o_orderkey"], "o_orderstatus", "F", REQUEST_SCHEMA)
    model = forest.train(staged(spread(matrix.where(~F.col("holdout"))), "matrix"),
                         list(features.feature_columns(REQUEST_SCHEMA)))
    # Every order asks for all nations, with its own price and priority.
    return _streamed(t, F.to_json(F.struct("o_totalprice", F.col("o_orderpriority").alias("priority"))), model,
                     REQUEST_SCHEMA, REQUEST_DEFAULTS)


def _streamed(t, body, model, schema, defaults, table="scores"):
    """All orders as a stream of requests against the nations' mean balances."""
    spark = t("orders").sparkSession
    folder = scratch_folder(spark, "bodies")
    bodies = staged_at(t("orders").select("o_orderkey", body.alias("body")), folder)
    entities = t("customer").groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("c_acctbal"))
    out = scratch_folder(spark, "scores")
    scoring.score_stream(spark.readStream.schema(bodies.schema).parquet(folder), out,
                         scratch_folder(spark, "progress"), staged(entities, "entities"), model,
                         "o_orderkey", "c_nationkey", schema=schema, defaults=defaults).awaitTermination()
    return scoring.answered(spark, out, table)


# One feature that tells the label alone: every split is pure, so SQL knows each answer of the forest.
CLEAR_SCHEMA = {"urgent": {"type": "indicator", "column": "o_orderpriority", "value": "1-URGENT"}}
CLEAR_DEFAULTS = {"o_orderpriority": ("string", "1-URGENT")}


def _clear_matrix(t):
    rows = t("orders").withColumn("target", F.when(F.col("o_orderpriority") == "1-URGENT", "Y"))
    return staged(spread(training.model_matrix(rows, ["o_orderkey"], "target", "Y", CLEAR_SCHEMA)), "matrix")


def _clear_model(t):
    return forest.train(_clear_matrix(t).where(~F.col("holdout")), ["urgent"], trees=10)


@query("forest_clear_scores", """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 100.0 ELSE 0.0 END AS percent FROM orders""")
def forest_clear_scores(t):
    matrix = _clear_matrix(t)
    path = scratch_folder(matrix.sparkSession, "model")
    training.train_evaluate(matrix, CLEAR_SCHEMA, trees=10, model_path=path)
    scored = forest.score(forest.load_model(path), matrix)
    return scored.select("o_orderkey", F.col("percent").cast("double").alias("percent"))


@query("forest_clear_accuracy", f"""
    SELECT {_bucket_sql("o_orderkey::VARCHAR", 5)} = 1 AS holdout, 1.0::DOUBLE AS accuracy, count(*) AS rows
    FROM orders GROUP BY 1""")
def forest_clear_accuracy(t):
    return training.train_evaluate(_clear_matrix(t), CLEAR_SCHEMA, trees=10)[1]


@query("forest_clear_importance", "SELECT 'urgent' AS feature, 100.0::DOUBLE AS importance")
def forest_clear_importance(t):
    return forest.importances(t("orders").sparkSession, _clear_model(t), ["urgent"])


@query("forest_clear_grid", f"""
    SELECT trees::INT AS trees, coalesce(depth, {forest.DEEPEST})::INT AS depth, 1.0::DOUBLE AS accuracy
    FROM (SELECT unnest({fixed.GRID_TREES}) AS trees), (SELECT unnest({str(fixed.GRID_DEPTHS).replace("None", "NULL")}) AS depth)""")
def forest_clear_grid(t):
    return forest.grid_search(_clear_matrix(t).where(~F.col("holdout")), ["urgent"], "fold")[1]


# Two features and a label that is mostly their conjunction. A tree of depth two splits at "urgent" and
# then at "open"; leaves that would answer alike are one. So there are three leaves, none of them pure.
BAGGED_TREES = 12
BAGGED_SCHEMA = {"urgent": {"type": "indicator", "column": "o_orderpriority", "value": "1-URGENT"},
                 "open": {"type": "indicator", "column": "state", "value": "open"}}
_ODD = "(o_orderkey * 7919 + o_custkey) % 5 = 0"
_MIXED = f"(o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F') <> ({_ODD})"


def _bags_sql() -> str:
    """Rows, their trees and weights, and each tree's answer for the row's leaf."""
    factors = ", ".join(f"({k}, {a}, {b})" for k in range(BAGGED_TREES) for a, b in [bagging.tree_factors(k, 17)])
    draws = " + ".join(f"(place >= {step})::INT" for step in bagging.STEPS)
    return f"""
    r AS (SELECT o_orderkey, ({_MIXED})::INT AS label, {_bucket_sql("o_orderkey::VARCHAR", 5)} = 1 AS holdout,
                 CASE WHEN o_orderpriority <> '1-URGENT' THEN 0 WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS leaf,
                 {_bucket_sql("o_orderkey::VARCHAR", bagging.PRIME)} - 1 AS h FROM orders),
    p AS (SELECT r.*, tree, (h::BIGINT * times + plus) % {bagging.PRIME} AS place FROM r, (VALUES {factors}) f(tree, times, plus)),
    w AS (SELECT *, {draws} AS weight FROM p),
    l AS (SELECT tree, leaf, sum(weight * label) / sum(weight) AS answer FROM w WHERE NOT holdout GROUP BY tree, leaf),
    v AS (SELECT w.*, answer FROM w JOIN l USING (tree, leaf))"""


def _mixed_matrix(t):
    rows = t("orders").select("o_orderkey", "o_orderpriority", F.when(F.expr(_MIXED), "Y").alias("target"),
                              F.when(F.col("o_orderstatus") != "F", "open").alias("state"))
    return staged(training.model_matrix(rows, ["o_orderkey"], "target", "Y", BAGGED_SCHEMA), "mixed")


def _bagged(t):
    matrix = _mixed_matrix(t)
    model, report = training.train_out_of_bag(matrix, ["o_orderkey"], BAGGED_SCHEMA, trees=BAGGED_TREES, depth=2, subset="all")
    return matrix, model, report


@query("bag_left_out", f"""
    WITH {_bags_sql()}
    SELECT o_orderkey, count(*) FILTER (weight = 0) AS n_out, sum(weight)::BIGINT AS drawn FROM w WHERE NOT holdout GROUP BY 1""")
def bag_left_out(t):
    row = F.col("row")
    weights = [bagging.bag_weight(row, k) for k in range(BAGGED_TREES)]
    rows = _mixed_matrix(t).where(~F.col("holdout")).withColumn("row", bagging.row_hash([F.col("o_orderkey")]))
    bags = rows.select("o_orderkey", F.array(*weights).alias("bags"))
    return bags.select("o_orderkey", F.size(F.filter("bags", lambda w: w == 0)).cast("bigint").alias("n_out"),
                       F.aggregate("bags", F.lit(0).cast("bigint"), lambda a, w: a + w).alias("drawn"))


@query("oob_votes", f"""
    WITH {_bags_sql()}
    SELECT o_orderkey, (count(*) FILTER (weight = 0))::INT AS n_out, round(avg(answer) FILTER (weight = 0), 6) AS vote
    FROM v WHERE NOT holdout GROUP BY 1""")
def oob_votes(t):
    matrix, model, _ = _bagged(t)
    out = bagging.out_of_bag(model, matrix.where(~F.col("holdout")), ["o_orderkey"])
    return out.select("o_orderkey", "n_out", F.round("vote", 6).alias("vote"))


@query("oob_score", f"""
    WITH {_bags_sql()},
    o AS (SELECT label, avg(answer) FILTER (weight = 0) AS vote FROM v WHERE NOT holdout GROUP BY o_orderkey, label),
    h AS (SELECT label, avg(answer) AS vote FROM v WHERE holdout GROUP BY o_orderkey, label)
    SELECT 'out_of_bag' AS part, avg(((vote > 0.5)::INT = label)::INT) AS accuracy, count(*) AS rows FROM o WHERE vote IS NOT NULL
    UNION ALL SELECT 'holdout', avg(((vote > 0.5)::INT = label)::INT), count(*) FROM h""")
def oob_score(t):
    return _bagged(t)[2]


@query("bagged_scores", f"""
    WITH {_bags_sql()} SELECT o_orderkey, round_even(100 * avg(answer), 2) AS percent FROM v GROUP BY 1""")
def bagged_scores(t):
    matrix, model, _ = _bagged(t)
    return bagging.score_bagged(model, matrix).select("o_orderkey", F.col("percent").cast("double").alias("percent"))


@query("bagged_importance", f"""
    WITH {_bags_sql()},
    n AS (SELECT tree, sum(weight) FILTER (leaf = 0) AS w0, sum(weight * label) FILTER (leaf = 0) AS y0,
                 sum(weight) FILTER (leaf = 1) AS w1, sum(weight * label) FILTER (leaf = 1) AS y1,
                 sum(weight) FILTER (leaf = 2) AS w2, sum(weight * label) FILTER (leaf = 2) AS y2
          FROM w WHERE NOT holdout GROUP BY tree),
    i AS (SELECT tree, 2 * (y0 / w0) * (w0 - y0) AS g0, 2 * (y1 / w1) * (w1 - y1) AS g1, 2 * (y2 / w2) * (w2 - y2) AS g2,
                 2 * ((y1 + y2) / (w1 + w2)) * (w1 + w2 - y1 - y2) AS g12,
                 2 * ((y0 + y1 + y2) / (w0 + w1 + w2)) * (w0 + w1 + w2 - y0 - y1 - y2) AS g012 FROM n),
    s AS (SELECT (g012 - g0 - g12) / (g012 - g0 - g1 - g2) AS urgent FROM i)
    SELECT 'urgent' AS feature, round(100 * avg(urgent), 6) AS importance FROM s
    UNION ALL SELECT 'open', round(100 * avg(1 - urgent), 6) FROM s""")
def bagged_importance(t):
    _, model, _ = _bagged(t)
    found = bagging.importances(model, list(features.feature_columns(BAGGED_SCHEMA)))
    return t("orders").sparkSession.createDataFrame(found, "feature STRING, importance DOUBLE").withColumn(
        "importance", F.round("importance", 6))


@query("score_defaults", "SELECT n_nationkey, 100.0::DOUBLE AS percent FROM nation")
def score_defaults(t):
    scored = training.score_defaults(t("nation"), "n_nationkey", _clear_model(t), CLEAR_SCHEMA, CLEAR_DEFAULTS)
    return scored.select("n_nationkey", F.col("percent").cast("double").alias("percent"))


@query("score_one", "SELECT n_nationkey, 0.0::DOUBLE AS percent FROM nation")
def score_one(t):
    scored = training.score_one(t("nation"), "n_nationkey", _clear_model(t), {"o_orderpriority": "5-LOW"},
                                CLEAR_SCHEMA, CLEAR_DEFAULTS, entity_features=())
    return scored.select("n_nationkey", F.col("percent").cast("double").alias("percent"))


@query("stream_clear_scoring", """
    SELECT o_orderkey, c_nationkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 100.0 ELSE 0.0 END AS percent
    FROM orders, (SELECT DISTINCT c_nationkey FROM customer)""")
def stream_clear_scoring(t):
    scored = _streamed(t, F.to_json(F.struct("o_orderpriority")), _clear_model(t), CLEAR_SCHEMA, CLEAR_DEFAULTS)
    return scored.withColumn("percent", F.col("percent").cast("double"))


def _spoiled():
    """Orders whose request is no JSON, no object, or has a key of a wrong type."""
    status = F.col("o_orderstatus")
    return (F.when(status == "P", "no json").when((status == "F") & (F.col("o_orderkey") % 2 == 0), "[1]")
            .when(status == "F", F.to_json(F.struct(F.array("o_orderkey").alias("o_totalprice"))))
            .otherwise(F.to_json(F.struct("o_totalprice", "o_orderpriority"))))


MIXED_DEFAULTS = CLEAR_DEFAULTS | {"o_totalprice": ("double", 1.0)}


@query("stream_rejects", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR o_orderkey % 2 = 0 THEN 'not a JSON object'
                            ELSE 'bad o_totalprice' END AS reason
    FROM orders WHERE o_orderstatus IN ('P', 'F')""")
def stream_rejects(t):
    return _streamed(t, _spoiled(), _clear_model(t), CLEAR_SCHEMA, MIXED_DEFAULTS, "rejects")


@query("stream_good_scores", """
    SELECT o_orderkey, c_nationkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 100.0 ELSE 0.0 END AS percent
    FROM orders, (SELECT DISTINCT c_nationkey FROM customer) WHERE o_orderstatus NOT IN ('P', 'F')""")
def stream_good_scores(t):
    scored = _streamed(t, _spoiled(), _clear_model(t), CLEAR_SCHEMA, MIXED_DEFAULTS)
    return scored.withColumn("percent", F.col("percent").cast("double"))
