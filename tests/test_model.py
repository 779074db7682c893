"""Features, forests and request scoring."""

import json
import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cairn import fixed
from cairn.operators import bagging, features, forest
from cairn.plans import training
from cairn.session import scratch_folder
from cairn.streaming import scoring

MEMBER = ("expedition_id STRING, member_id STRING, expedition_year INT, season STRING, "
          "commercial_route STRING, total_members INT, total_hired INT, age INT, sex STRING, "
          "o2_used STRING, height INT, himal STRING, successful_summit STRING")


@pytest.fixture(scope="module")
def attempts(spark):
    rows = []
    for i in range(1200):
        o2 = "Y" if i % 2 else "N"
        # Oxygen decides, apart from every eleventh attempt.
        top = (o2 == "Y") != (i % 11 == 0)
        rows.append((f"E{i // 6}", f"{i % 6:02d}", 1970 + i % 50, ["Spring", "Autumn", None][i % 3],
                     "YN"[i % 5 == 0], 3 + i % 9, i % 4, 20 + i % 40, "FM"[i % 7 != 0], o2,
                     6000 + 10 * (i % 250), ["KHUMBU", "BARUN", None, "ELSEWHERE"][i % 4],
                     "Y" if top else "N"))
    return spark.createDataFrame(rows, MEMBER)


def test_feature_matrix(spark, attempts):
    matrix = features.feature_matrix(attempts, keys=["expedition_id", "member_id"])
    names = list(features.feature_columns())
    assert len(names) == 42 and matrix.columns == ["expedition_id", "member_id", *names]
    assert names[:4] == ["expedition_year", "season_spring", "season_summer", "season_winter"]
    r = matrix.where("expedition_id = 'E0' AND member_id = '01'").first()
    assert (r.season_spring, r.himal_barun, r.female, r.o2_used, r.age) == (0, 1, 0, 1, 21.0)
    empty = matrix.where("expedition_id = 'E0' AND member_id = '02'").first()
    assert sum(empty[n] for n in names if n.startswith(("season", "himal"))) == 0
    other = features.feature_matrix(attempts, ignore={"season"}, other=True)
    assert "himal_other" in other.columns and "season_spring" not in other.columns
    assert matrix._jdf.queryExecution().toString().count("Join") == 0


def test_train_evaluate_persist(spark, attempts):
    matrix = training.model_matrix(attempts, ["expedition_id", "member_id"], "successful_summit")
    path = scratch_folder(spark, "model")
    model, report = training.train_evaluate(matrix, trees=20, model_path=path)
    accuracy = {r.holdout: r for r in report.collect()}
    assert accuracy[True].accuracy > 0.85 and accuracy[False].accuracy > 0.85
    assert accuracy[True].rows + accuracy[False].rows == 1200
    again = forest.score(forest.load_model(path), matrix).select("percent").collect()
    assert again == forest.score(model, matrix).select("percent").collect()
    names = list(features.feature_columns())
    table = forest.importances(spark, model, names).collect()
    assert table[0].feature == "o2_used" and sum(r.importance for r in table) == pytest.approx(100)
    folds = {r.fold for r in matrix.where(~F.col("holdout")).select("fold").distinct().collect()}
    assert folds == set(range(8))


def test_many_rows_are_scored_by_the_models_own_answers(spark, monkeypatch):
    rows = [(k, float(k * 7919 % 1000), k % 2, float(k % 13), float((k * 7919 % 1000 > 400) != (k % 7 == 0))) for k in range(800)]
    matrix = spark.createDataFrame(rows, "id INT, a DOUBLE, b INT, c DOUBLE, label DOUBLE")
    model = forest.train(matrix, ["a", "b", "c"], trees=20)
    cuts = forest._thresholds(model.stages[-1])
    edges = [(1000 + k, v, k % 2, float(k % 13), 0.0) for k, cut in enumerate(cuts[0])
             for v in (cut, math.nextafter(cut, math.inf), math.nextafter(cut, -math.inf), math.inf, -math.inf)]
    asked = matrix.union(spark.createDataFrame(edges, matrix.schema)).drop("label")
    by_cell, by_row = forest.score(model, asked, many=True), forest.score(model, asked)
    assert by_cell.columns == by_row.columns and sorted(by_cell.collect()) == sorted(by_row.collect())
    # The trees are walked for the table alone, not for the rows.
    assert "UDF(features" not in by_cell._jdf.queryExecution().analyzed().toString()
    with pytest.raises(Exception, match="no value"):
        forest.score(model, spark.createDataFrame([(1, None, 0, 0.0, 0.0)], matrix.schema), many=True).collect()
    monkeypatch.setattr(forest, "MOST_CELLS", 10)
    assert sorted(forest.score(model, asked, many=True).collect()) == sorted(by_row.collect())


def test_nulls_are_an_error_or_skipped(spark, attempts):
    holed = attempts.withColumn("age", F.when(F.col("age") != 25, F.col("age")))
    matrix = training.model_matrix(holed, ["expedition_id", "member_id"], "successful_summit")
    with pytest.raises(Exception):
        training.train_evaluate(matrix, trees=2)[1].collect()
    _, report = training.train_evaluate(matrix, trees=2, invalid="skip")
    assert sum(r.rows for r in report.collect()) == 1170


def test_grid_search_covers_every_setting(spark, attempts):
    matrix = training.model_matrix(attempts.where("age < 30"), ["expedition_id", "member_id"],
                                   "successful_summit")
    train = matrix.where(~F.col("holdout"))
    best, table = forest.grid_search(train, ["o2_used", "age"], "fold", trees=[3, 5], depths=[None, 2])
    rows = table.collect()
    assert {(r.trees, r.depth) for r in rows} == {(3, 30), (3, 2), (5, 30), (5, 2)}
    assert rows[0].accuracy == max(r.accuracy for r in rows)
    assert (best.stages[-1].getNumTrees, best.stages[-1].getMaxDepth()) == (rows[0].trees, rows[0].depth)


def test_settings_vote_as_separate_forests_of_the_same_trees(spark, attempts):
    matrix = training.model_matrix(attempts, ["expedition_id", "member_id"], "successful_summit")
    rows = VectorAssembler(inputCols=["o2_used", "age", "height"], outputCol="features").transform(matrix).select("features", "label")
    model = forest._forest("label", 7, 6, 3).fit(rows)
    got = forest.setting_accuracy(model, rows, [1, 4, 7], [2, 6])
    label = [bool(r.label) for r in rows.collect()]

    def accuracy(votes):
        yes = [sum(v) for v in zip(*votes, strict=True)]
        return sum((y > len(votes) - y) == x for y, x in zip(yes, label, strict=True)) / len(label)

    each = [[r.probability[1] for r in tree.setProbabilityCol("probability").transform(rows).collect()] for tree in model.trees]
    for n in (1, 4, 7):
        assert got[n, 6] == pytest.approx(accuracy(each[:n]))
    assert got[7, 6] == pytest.approx(forest.accuracy(model.transform(rows)).first().accuracy)

    # Cut at depth two, walked node by node.
    nodes = forest.forest_nodes(model)
    points = [list(r.features) for r in rows.collect()]
    trees = [t.set_index("id").to_dict("index") for _, t in nodes.groupby("tree")]

    def walk(tree, x):
        node = tree[0]
        for _ in range(2):
            if node["feature"] >= 0:
                node = tree[node["left"] if x[int(node["feature"])] <= node["threshold"] else node["right"]]
        return node["share"]

    for n in (1, 4, 7):
        assert got[n, 2] == pytest.approx(accuracy([[walk(t, x) for x in points] for t in trees[:n]]))


def test_bags_are_poisson_draws(spark):
    rows = spark.range(20000).withColumn("row", bagging.row_hash([F.col("id")]))
    weights = rows.select(*(bagging.bag_weight(F.col("row"), k).alias(f"w{k}") for k in range(3))).toPandas()
    for k in range(3):
        share = weights[f"w{k}"].value_counts(normalize=True)
        assert [share[j] for j in range(4)] == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=0.015)
    assert abs(weights["w0"].corr(weights["w1"])) < 0.03
    assert (bagging.STEPS[0] / bagging.PRIME, bagging.STEPS[1] / bagging.PRIME) == pytest.approx((math.exp(-1), 2 * math.exp(-1)))


def test_out_of_bag_votes_count_only_trees_that_never_saw_the_row(spark, attempts):
    keys = ["expedition_id", "member_id"]
    matrix = training.model_matrix(attempts, keys, "successful_summit")
    names = ["o2_used", "age", "female", "height"]
    path = scratch_folder(spark, "bagged")
    model = bagging.train_bagged(matrix, names, keys, trees=6, depth=4, path=path)
    out = {(r.expedition_id, r.member_id): r for r in bagging.out_of_bag(model, matrix, keys).collect()}
    assembler, *trees = model.stages
    row = bagging.row_hash([F.col(k) for k in keys])
    right = voted = 0
    votes = {}
    for k, tree in enumerate(trees):
        seen = tree.transform(assembler.transform(matrix)).withColumn("w", bagging.bag_weight(row, k))
        for r in seen.collect():
            if r.w == 0:
                votes.setdefault((r.expedition_id, r.member_id), []).append(float(r[f"_tree{k}"][1]))
    assert len(out) == 1200 and sum(r.n_out == 0 for r in out.values()) == 1200 - len(votes)
    for key, r in out.items():
        mine = votes.get(key, [])
        assert r.n_out == len(mine) and (r.vote is None) == (not mine)
        if mine:
            assert r.vote == pytest.approx(sum(mine) / len(mine))
            voted += 1
            right += (r.vote > 0.5) == (r.label == 1.0)
    score = bagging.oob_score(bagging.out_of_bag(model, matrix, keys)).first()
    assert (score.rows, score.oob_score) == (voted, pytest.approx(right / voted)) and score.oob_score > 0.85
    again = bagging.score_bagged(PipelineModel.load(path), matrix).select(*keys, "percent")
    assert again.exceptAll(bagging.score_bagged(model, matrix).select(*keys, "percent")).isEmpty()


def test_a_bag_of_one_class(spark):
    rows = spark.createDataFrame([(k, float(k), 0.0) for k in range(40)] + [(40, 40.0, 1.0)], "id int, x double, label double")
    model = bagging.train_bagged(rows, ["x"], ["id"], trees=4, depth=2)
    out = bagging.out_of_bag(model, rows, ["id"])
    assert out.count() == 41 and out.where("vote IS NOT NULL AND (vote < 0 OR vote > 1)").isEmpty()


def bodies():
    return [("default", {}), ("typed", {"age": "40", "sex": "F", "o2_used": "Y", "extra": [1]}),
            ("truncated", {"age": 40.7}), ("bad", {"age": "old"}), ("null", {"total_hired": None}),
            ("nulltext", {"season": None})]


def requests(spark):
    rows = [(k, json.dumps(b)) for k, b in bodies()] + [("broken", "{oops"), ("list", "[1]"), ("none", None)]
    return spark.createDataFrame(rows, "key STRING, body STRING")


def test_request_parsing(spark):
    got = {r.key: r for r in scoring.parse_requests(requests(spark)).collect()}
    assert got["default"].reason is None and got["default"].age == 37 and got["default"].season == "Autumn"
    assert (got["typed"].age, got["typed"].sex, got["typed"].total_members) == (40, "F", 5)
    assert got["truncated"].age == 40 and got["truncated"].reason is None
    assert got["nulltext"].season == "None"
    rejects = {r.key: r.reason for r in scoring.rejected(scoring.parse_requests(requests(spark)), "key").collect()}
    assert rejects == {"bad": "bad age", "null": "bad total_hired", "broken": "not a JSON object",
                       "list": "not a JSON object", "none": "not a JSON object"}


def test_stream_batch_and_single_scores_agree(spark, attempts):
    matrix = training.model_matrix(attempts, ["expedition_id", "member_id"], "successful_summit")
    names = list(features.feature_columns())
    model = forest.train(matrix, names, trees=5)
    peaks = spark.createDataFrame([("EVER", 8849, "KHUMBU"), ("BARU", 7100, "BARUN"), ("NONE", 6500, None),
                                   ("GONE", None, "KHUMBU")], "peak_id STRING, height INT, himal STRING")
    asked = requests(spark)
    batch = scoring.score_requests(asked, peaks, model, "key", "peak_id")
    rows = {(r.key, r.peak_id): r.percent for r in batch.collect()}
    # An entity without a height stays in the answer and has no percent.
    assert len(rows) == 4 * 4 and all(p is None if peak == "GONE" else 0 <= p <= 100 for (_, peak), p in rows.items())
    plan = batch._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

    folder = scratch_folder(spark, "requests")
    asked.repartition(3).write.parquet(folder)
    out = scratch_folder(spark, "scores")
    stream = spark.readStream.schema(asked.schema).parquet(folder)
    scoring.score_stream(stream, out, scratch_folder(spark, "progress"), peaks, model, "key", "peak_id"
                         ).awaitTermination()
    streamed = {(r.key, r.peak_id): r.percent for r in scoring.answered(spark, out, "scores").collect()}
    assert streamed == rows

    defaults = {r.peak_id: r.percent for r in training.score_defaults(peaks, "peak_id", model).collect()}
    assert defaults == {p: v for (k, p), v in rows.items() if k == "default"}
    one = {r.peak_id: r.percent for r in training.score_one(
        peaks, "peak_id", model, {"age": 40, "sex": "F", "o2_used": "Y"}).collect()}
    assert one == {p: v for (k, p), v in rows.items() if k == "typed"}


def test_accuracy_and_defaults_cover_the_schema(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0)], "prediction DOUBLE, label DOUBLE")
    assert tuple(forest.accuracy(df).first()) == (0.5, 2)
    asked = {s["column"] for s in fixed.FEATURES.values()}
    assert asked - set(fixed.REQUEST_DEFAULTS) == {"height", "himal"}


def test_registered_grid_search_is_the_full_grid(spark, monkeypatch):
    from cairn.queries import QUERIES, load_all

    load_all()
    seen = {}
    monkeypatch.setattr(forest, "grid_search", lambda *given, **named: seen.update(named) or (None, given[0]))
    QUERIES["grid_search"](spark, "/root/testdata/sf0.001")
    assert "trees" not in seen and "depths" not in seen
    assert len(fixed.GRID_TREES) * len(fixed.GRID_DEPTHS) == 32


def test_stream_answers_all_requests_once_after_crashes(spark, attempts, monkeypatch):
    matrix = training.model_matrix(attempts, ["expedition_id", "member_id"], "successful_summit")
    model = forest.train(matrix, list(features.feature_columns()), trees=3)
    peaks = spark.createDataFrame([("EVER", 8849, "KHUMBU"), ("BARU", 7100, "BARUN")], "peak_id STRING, height INT, himal STRING")
    asked = requests(spark)
    folder, out, progress = (scratch_folder(spark, x) for x in ("requests", "answers", "progress"))
    asked.repartition(5).write.parquet(folder)
    write, failing = scoring.write_version, {"before": 2, "after": 3}

    def crash(root, tables, **named):
        number = named["ordinal"]
        if failing["before"] == number:
            failing["before"] = None
            tables["scores"].write.parquet(f"{root}/data/{named['version']}/scores")  # cut short before its commit
            raise RuntimeError("lost before the commit")
        done = write(root, tables, **named)
        if failing["after"] == number:
            failing["after"] = None
            raise RuntimeError("lost after the commit")
        return done

    monkeypatch.setattr(scoring, "write_version", crash)
    assert scoring.answered(spark, out, "scores") is None
    runs = 0
    while True:
        stream = spark.readStream.schema(asked.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        query = scoring.score_stream(stream, out, progress, peaks, model, "key", "peak_id")
        runs += 1
        try:
            query.awaitTermination()
            break
        except Exception as problem:
            assert "lost" in str(problem)
    assert runs == 3
    batch = scoring.score_requests(asked, peaks, model, "key", "peak_id")
    assert sorted(map(tuple, scoring.answered(spark, out, "scores").collect())) == sorted(map(tuple, batch.collect()))
    rejects = scoring.rejected(scoring.parse_requests(asked), "key")
    assert sorted(map(tuple, scoring.answered(spark, out, "rejects").collect())) == sorted(map(tuple, rejects.collect()))


def test_rows_of_a_forest_are_dealt_by_what_their_bags_take(spark, monkeypatch):
    seen, stages = [], forest._stages

    class Watched:
        def __init__(self, pipeline):
            self.pipeline = pipeline

        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return self.pipeline.fit(rows)

    monkeypatch.setattr(forest, "_stages", lambda *a: Watched(stages(*a)))
    matrix = spark.range(400, numPartitions=1).select(F.col("id").cast("double").alias("x"),
                                                      (F.col("id") % 2).cast("double").alias("label"))
    forest.train(matrix, ["x"], trees=50, depth=2)
    monkeypatch.setattr(forest, "COUNTS_PER_TASK", 1000, raising=False)
    forest.train(matrix, ["x"], trees=50, depth=2)
    assert seen == [1, 20]
