"""The pipeline, stage by stage, on documents with known answers."""

import pytest

import corpus_pipeline as pipeline
from cairn.session import staged

ENGLISH = "the river runs through the old town and the people walk along its banks every day of the year "
GERMAN = "der fluss fliesst durch die alte stadt und die leute gehen jeden tag des jahres an seinem ufer entlang "


def numbered(text, k, n=4):
    return " ".join(f"{w}{k if j % 7 == 0 else ''}" for j, w in enumerate((text * n).split()))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = [(k, numbered(ENGLISH, f"a{k}"), "en") for k in range(20)]
    docs += [(100 + k, numbered(GERMAN, f"b{k}"), "de") for k in range(20)]
    docs += [(200, docs[0][1], "en"), (201, docs[1][1].upper(), None), (202, docs[2][1] + " more", "en"),
             (300, None, "en"), (301, "", "en"), (302, "123 ... 456", "en"), (303, "\u0001\u0002" * 40 + "ж", None),
             (400, numbered(ENGLISH, "c", 2) + " quite a special passage that only one benchmark item holds in full " + numbered(ENGLISH, "d", 2), "en"),
             (401, numbered(GERMAN, "e") + " password=supersecret123 " + numbered(GERMAN, "f", 1), "de"),
             (None, numbered(ENGLISH, "g"), None), (3, docs[3][1], "en")]
    rows = [(d, t, lang, "s", None if t is None else len(t), "mine", "own") for d, t, lang in docs]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string, "
                                "lang_pred string").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "a special passage that only one benchmark item holds in full"), (2, None), (3, "zebra " * 20)],
                          "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def ids(df):
    return sorted(r["doc_id"] for r in df.where("doc_id IS NOT NULL").select("doc_id").collect())


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, folder), name)
        seen[name] = docs
        if name != "tokens":
            assert docs.columns == columns
    first = [*range(20), *range(100, 120)]
    assert ids(seen["language"]) == sorted([*first, 3, 200, 201, 202, 400, 401])
    assert seen["language"].where("doc_id = 201").first()["lang"] == "en"
    assert ids(seen["near_duplicates"]) == [*first, 400, 401]
    assert ids(seen["decontamination"]) == [*first, 401]
    masked = seen["secrets"].where("doc_id = 401").first()
    assert "supersecret" not in masked["text"] and "[secret]" in masked["text"] and masked["n_chars"] == len(masked["text"])
    assert {tuple(r) for r in seen["secrets"].where("doc_id < 200").collect()} == {
        tuple(r) for r in seen["decontamination"].where("doc_id < 200").collect()}
    last = seen["tokens"]
    assert last.columns == [*columns, "n_tokens", "ids"] and all(len(r["ids"]) == r["n_tokens"] > 0 for r in last.collect())
    assert all(docs.where("doc_id IS NULL").count() == 1 for docs in seen.values())


def test_run_equals_its_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, folder), "again")
    assert sorted(pipeline.run(spark, folder).collect(), key=str) == sorted(docs.collect(), key=str)


def test_empty_tables(spark, folder):
    none = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for name, stage in pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0, name
