"""Rows without a list of ids."""

import random

import pytest

from cairn.llm import rows


@pytest.mark.parametrize("longs", [1 << 19, 2])
def test_without_listed_ids(spark, odd, none, monkeypatch, longs):
    monkeypatch.setattr(rows, "LONGS", longs)
    rnd = random.Random(1)
    listed = rnd.sample(range(-5000, 5000), 3000)
    ids = spark.createDataFrame([(x,) for x in listed] + [(None,), (listed[0],)], "doc_id bigint")
    many = spark.range(-5000, 5000).selectExpr("id AS doc_id", "cast(id AS string) AS __may", "id AS __long")
    kept = rows.without(many, ids, "doc_id")
    assert kept.columns == many.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(range(-5000, 5000)) - set(listed))
    want = [tuple(r) for r in odd.collect() if r["doc_id"] is None or r["doc_id"] not in listed]
    assert sorted(map(tuple, rows.without(odd, ids, "doc_id").collect()), key=repr) == sorted(want, key=repr)
    assert rows.without(none, ids, "doc_id").collect() == []
    assert rows.without(odd, ids.where("false"), "doc_id").count() == odd.count()


def test_texts_that_stay_are_not_shuffled(spark):
    docs = spark.range(1000).selectExpr("id AS doc_id", "repeat('x', 10) AS text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = rows.without(docs, spark.range(10).selectExpr("id * 90 AS doc_id"), "doc_id")
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert kept.count() == 990
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange for the rows that may be listed, one for the list.
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("Exchange hashpartitioning(doc_id") == 1
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("SortMergeJoin") == 1
