"""Duplicate handling, key checks and relational blocks."""

from pyspark.sql import functions as F

from cairn.operators import quality, relational as rel


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def dup(spark):
    return spark.createDataFrame(
        [("A", 1910, "old"), ("A", 2010, "new"), ("B", 2000, "t1"), ("B", 2000, "t2"),
         ("C", None, "n1"), ("C", None, "n2"), ("D", None, "x"), ("D", 5, "y"), (None, 1, "k"),
         (None, 2, "l")], "k STRING, y INT, v STRING")


def test_keep_latest_keeps_ties_and_partitions_the_input(spark):
    df = dup(spark)
    kept = quality.keep_latest(df, ["k"], "y")
    assert {r.v for r in kept.collect()} == {"new", "t1", "t2", "n1", "n2", "y", "l"}
    lost = quality.superseded(df, ["k"], "y")
    assert rows(lost) == sorted([("A", 1910, 2010), ("D", None, 5), (None, 1, 2)], key=repr)
    counts = quality.duplicate_counts(df, ["k"], "y").first()
    assert (counts.kept, counts.total) == (7, 10) == (kept.count(), kept.count() + lost.count())


def test_keep_latest_on_the_key_itself_keeps_all(spark):
    df = spark.createDataFrame([("A",), ("A",)], "k STRING")
    assert quality.keep_latest(df, ["k"], "k").count() == 2
    assert quality.superseded(df, ["k"], "k").count() == 0


def test_keep_latest_with_one_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("y"))
    kept = quality.keep_latest(df, ["k"], "y")
    assert kept.count() == 20_001
    assert kept.where("k = 0").first().y == 29_997


def test_the_join_finds_the_maxima_where_they_were_summed_up(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = quality.keep_latest(dup(spark), ["k"], "y")
        plan = kept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") == 2 and len(kept.collect()) == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_last_wins_on_ties_and_maps(spark):
    rows_ = [(1, 5, "b", {"x": 1}), (1, 5, "a", {"x": 2}), (1, None, "z", None), (None, None, "n", None), (None, None, "m", {"q": 0})]
    df = spark.createDataFrame(rows_, "k INT, o INT, v STRING, m MAP<STRING, INT>")
    assert rows(quality.last_wins(df, ["k"], "o").select("k", "o", "v")) == sorted([(1, 5, "b"), (None, None, "n")], key=repr)
    assert rows(quality.last_wins(df.drop("m"), ["k"], "o")) == sorted([(1, 5, "b"), (None, None, "n")], key=repr)
    assert quality.last_wins(df, ["k"], "o").where("v = 'b'").first().m == {"x": 1}


def test_key_violations(spark):
    got = quality.key_violations(dup(spark), ["k"])
    assert {(r.k, r.problem) for r in got.collect()} == {
        ("A", "repeated key"), ("B", "repeated key"), ("C", "repeated key"), ("D", "repeated key"),
        (None, "null key")}


def test_last_wins_and_cardinality(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 2), (2, "c", 1)], "k INT, v STRING, o INT")
    assert rows(quality.last_wins(df, ["k"], "o")) == [(1, "b", 2), (2, "c", 1)]
    assert rows(quality.unexpected_counts(df, ["k"])) == [(1, 2)]


def test_three_valued_filters(spark):
    df = spark.createDataFrame(
        [(0, 0), (0, 5), (0, None), (1, 0), (1, None), (None, 0), (None, 5)], "a INT, b INT")
    assert rows(df.where(rel.not_both_zero("a", "b"))) == sorted(
        [(0, 5), (1, 0), (1, None), (None, 5)], key=repr)
    assert rows(df.where(rel.all_zero("a", "b"))) == [(0, 0)]
    assert [r[0] for r in df.select(rel.yes_no(F.col("a") == 1)).collect()] == list("NNNYYNN")


def test_lookup_override_and_leaves(spark):
    df = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id INT, code INT")
    codes = spark.createDataFrame([(10, "ten")], "code INT, name STRING")
    assert rows(rel.decode(df, {"code": (codes, "code", "name")})) == [
        (1, 10, "ten"), (2, 99, None), (3, None, None)]
    assert rows(rel.lookup(df, codes, {"code": "code"}, {"n": "name"}, required=True)) == [(1, 10, "ten")]
    assert rows(rel.orphans(df, codes, {"code": "code"})) == [(2, 99), (3, None)]
    found = spark.createDataFrame([(1, "f"), (2, "f")], "id INT, t STRING")
    over = spark.createDataFrame([(2, "o"), (7, "o")], "id INT, t STRING")
    assert rows(rel.merge_overrides(found, over, "id")) == [(1, "f"), (2, "o"), (7, "o")]
    tree = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b")], "id STRING, p STRING")
    assert rows(rel.leaves(tree, "id", "p")) == [("c", "b")]


def test_range_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(F.col("id").alias("expedition_year"), F.lit("x").alias("other")
                            ).write.parquet(path)
    from cairn.sources.tables import rows_since
    plan = rows_since(spark.read.parquet(path), "expedition_year", 50).select(
        "expedition_year")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(expedition_year,50)" in plan
    assert "ReadSchema: struct<expedition_year:bigint>" in plan


def test_last_wins_without_ordinals(spark):
    rows = [(1, None, "a"), (1, None, "b"), (2, 5, "c"), (2, None, "d"), (3, None, None)]
    got = quality.last_wins(spark.createDataFrame(rows, "k INT, n INT, v STRING"), ["k"], "n")
    assert sorted(tuple(r) for r in got.collect()) == [(1, None, "b"), (2, 5, "c"), (3, None, None)]
