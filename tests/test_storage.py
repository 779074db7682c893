"""Files, typed loads and the warehouse."""

import csv
import io
import os
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from cairn import fixed
from cairn.operators import quality
from cairn.plans import warehouse
from cairn.session import scratch_folder, scratch_scope, staged
from cairn.sources import delimited, elements, layouts, tables, versions


def test_roundtrip_of_awkward_text(spark, tmp_path):
    rows = [(1, ' pad|bar "quoted" ', "x"), (2, "line\nbreak", None), (3, "", "é"), (4, '"', "a\\b"),
            (5, "plain", 'ends"')]
    df = spark.createDataFrame(rows, "id INT, a STRING, b STRING")
    path, n = delimited.write_delimited(df, str(tmp_path / "t"))
    assert n == 5
    back = {int(r.id): (r.a, r.b) for r in delimited.read_delimited(spark, path).collect()}
    assert back == {i: (a or None, b) for i, a, b in rows}
    # The standard library reads the same text the same way.
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    parsed = [r for r in csv.reader(io.StringIO(text), delimiter="|") if r and r[0] != "id"]
    assert {int(r[0]): (r[1], r[2]) for r in parsed} == {i: (a, b or "") for i, a, b in rows}


def test_carriage_returns_and_header_binding(spark, tmp_path):
    path = tmp_path / "s.txt"
    path.write_bytes("SEASONNAME|SEASON|EXTRA|STARTDAY\r\nUnknown|0|z|\r\nSpring |1|z|61\r\nBad|x|z|7\r\n".encode())
    schema = tables.registry()["hdb_season"]
    typed, rejects = delimited.type_columns(delimited.read_delimited(spark, str(path)), schema)
    assert [tuple(r) for r in typed.collect()] == [(0, "Unknown", None), (1, "Spring ", 61),
                                                   (None, "Bad", 7)]
    assert [(r.bad_fields, r.seasonname) for r in rejects.collect()] == [(["season=x"], "Bad")]


def test_registry_covers_all_tables_with_keys():
    reg = tables.registry()
    assert len(reg) == 14 and set(fixed.TABLE_KEYS) == set(reg)
    assert all(set(k) <= set(reg[t].names) for t, k in fixed.TABLE_KEYS.items())
    assert (len(reg["hdb_expedition"]), len(reg["hdb_member"]), len(reg["hdb_peak"])) == (66, 78, 25)


def test_materialise_once(spark, tmp_path):
    path = str(tmp_path / "m")
    first = spark.range(3)
    assert tables.materialise(first, path).count() == 3
    assert tables.materialise(spark.range(9), path).count() == 3
    assert tables.materialise(spark.range(9), path, force=True).count() == 9


def test_an_interrupted_write_is_repeated(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.range(5).write.parquet(f"{path}/data/cut-short/rows")  # no commit
    assert versions.read_latest(spark, path, "rows") is None
    assert tables.materialise(spark.range(3), path).count() == 3
    broken = spark.range(4).withColumn("id", F.raise_error(F.lit("stop")).cast("bigint"))
    with pytest.raises(Exception, match="stop"):
        tables.materialise(broken, path, force=True)
    assert tables.materialise(spark.range(9), path).count() == 3


def test_two_writers_leave_one_whole_version_and_old_ones_go(spark, tmp_path):
    path = str(tmp_path / "m")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: versions.write_version(path, {"a": spark.range(k), "b": spark.range(10 * k)}), (1, 2, 3, 4)))
    seen = versions.read_latest(spark, path, "a").count()
    assert versions.read_latest(spark, path, "b").count() == 10 * seen
    assert len(versions.commits(spark, path)) == 4 and versions.read_all(spark, path, "a").count() == 10
    versions.write_version(path, {"a": spark.range(7)})
    assert versions.read_latest(spark, path, "a").count() == 7 and versions.read_latest(spark, path, "b").count() == 10 * seen
    assert len(versions.drop_versions(spark, path, keep=1)) == 4
    assert versions.read_latest(spark, path, "b") is None and versions.read_latest(spark, path, "a").count() == 7
    assert sorted(os.listdir(f"{path}/data")) == sorted(os.listdir(f"{path}/manifest")) == [versions.commits(spark, path)[0]["version"]]


def test_a_named_version_is_written_once(spark, tmp_path):
    path = str(tmp_path / "m")
    first = versions.write_version(path, {"a": spark.range(2)}, version="batch-1", ordinal=1)
    assert first["tables"]["a"]["rows"] == 2
    assert versions.write_version(path, {"a": spark.range(9)}, version="batch-1", ordinal=1) is None
    assert versions.read_all(spark, path, "a").count() == 2


def test_staged_tables_go_with_their_scope(spark, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    with scratch_scope(spark):
        staged(spark.range(4), "inner").write.parquet(str(tmp_path / "out"))
        assert set(os.listdir(root)) > before
    assert set(os.listdir(root)) == before
    kept = staged(spark.range(4), "outer")
    assert kept.count() == 4


def test_scratch_folder_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert a != b and a.startswith(root)


EXP = ("expid STRING, peakid STRING, year INT, season INT, claimed INT, disputed INT, nohired INT, "
       "tothired INT, o2unkwn INT, comrte INT, totmembers INT")


def test_warehouse_views(spark, tmp_path):
    good = ("P1", 1990, 1, 0, 0, 1, 0, 0, 1, 9)
    cases = {"ok": good, "claimed": ("P1", 1990, 1, 1, 0, 1, 0, 0, 1, 9),
             "nullflag": ("P1", 1990, 1, None, 0, 1, 0, 0, 1, 9),
             "unreliable": ("P1", 1990, 1, 0, 0, 0, 0, 0, 1, 9),
             "hired5": ("P1", 1990, 1, 0, 0, 0, 5, 0, 0, 9),
             "hirednull": ("P1", 1990, 1, 0, 0, 0, None, 0, None, 9),
             "nohired1null": ("P1", 1990, 9, 0, 0, 1, None, 0, None, 9),
             "nopeak": ("P9", 1990, 1, 0, 0, 1, 0, 0, 1, 9),
             "old": ("P1", 1960, 0, 0, 0, 1, 0, 0, 1, 9)}
    exp = spark.createDataFrame([(k, *v) for k, v in cases.items()], EXP)
    # A superseded duplicate of one expedition is dropped on the way in.
    exp = exp.unionByName(spark.createDataFrame([("ok", "P1", 1890, 1, 0, 0, 1, 0, 0, 1, 1)], EXP))
    member = spark.createDataFrame(
        [(e, "01", "F", 30, 0, 0, 0, 0, 0, 1, 1, 1990) for e in cases]
        + [("ok", "02", "M", None, 0, 0, 0, 0, 0, None, None, 1990),
           ("ok", "03", "M", 20, 1, 0, 0, 0, 0, 1, 1, 1990),
           ("ok", "04", "M", 20, 0, None, 0, 0, 0, 1, 1, 1990)],
        "expid STRING, membid STRING, sex STRING, calcage INT, hired INT, sherpa INT, tibetan INT, "
        "mclaimed INT, mdisputed INT, mo2used INT, msmtterm INT, myear INT")
    counts = warehouse.ingest({"hdb_expedition": exp, "hdb_member": member}, str(tmp_path / "text"))
    assert counts == {"hdb_expedition": 9, "hdb_member": 12}
    for name, rows, cols in [
            ("ref_peak", [("P1", "KHUMBU", 8000)], "peak_id STRING, himal STRING, height INT"),
            ("hdb_season", [(0, "Unknown"), (1, "Spring")], "season INT, seasonname STRING")]:
        delimited.write_delimited(spark.createDataFrame(rows, cols), str(tmp_path / "text" / name))
    names = ["hdb_expedition", "hdb_member", "ref_peak", "hdb_season"]
    loaded = warehouse.load_warehouse(spark, {n: str(tmp_path / "text" / n) for n in names},
                                      str(tmp_path / "tables"))
    assert loaded == {"hdb_expedition": 9, "hdb_member": 12, "ref_peak": 1, "hdb_season": 2}
    view = {r.expedition_id: r for r in spark.table("model_expedition").collect()}
    assert set(view) == {"ok", "hired5", "nohired1null", "old"}
    assert (view["ok"].commercial_route, view["hired5"].commercial_route) == ("Y", "N")
    assert (view["ok"].season, view["nohired1null"].season, view["old"].season) == (
        "Spring", None, "Unknown")
    base = warehouse.training_rows(spark)
    got = {(r.expedition_id, r.member_id): r for r in base.collect()}
    assert set(got) == {("ok", "01"), ("ok", "02"), ("hired5", "01"), ("nohired1null", "01")}
    assert (got["ok", "01"].o2_used, got["ok", "01"].successful_summit) == ("Y", "Y")
    assert (got["ok", "02"].o2_used, got["ok", "02"].successful_summit) == ("N", "N")
    assert got["ok", "01"].himal == "KHUMBU" and got["ok", "01"].height == 8000


def test_clean_table_exports_flags(spark):
    df = spark.createDataFrame([("R1", "01", "1990", True), ("R1", "01", "1991", False)],
                               "EXPID STRING, REFID STRING, RYEAR STRING, FLAG BOOLEAN")
    kept, lost = warehouse.clean_table(df, "hdb_reference")
    assert kept.columns == ["expid", "refid", "ryear", "flag"]
    assert [tuple(r) for r in kept.collect()] == [("R1", "01", "1991", 0)]
    assert [tuple(r) for r in lost.collect()] == [("R1", "01", "1990", "1991")]


def test_empty_tables_have_their_layout(spark, tmp_path):
    made = tables.create_empty(spark, str(tmp_path / "e"))
    assert len(made) == 14
    assert spark.table("hdb_peak").count() == 0 and "pkname2" in spark.table("hdb_peak").columns


def test_lone_columns_keep_their_rows(spark, tmp_path):
    rows = [("a",), ("",), (None,), ("b",)]
    path, n = delimited.write_delimited(spark.createDataFrame(rows, "a STRING"), str(tmp_path / "lone"))
    got = sorted(str(r.a) for r in delimited.read_delimited(spark, path).collect())
    assert n == 4 and got == ["None", "None", "a", "b"]


def test_columns_are_bound_by_the_header(spark, tmp_path):
    (tmp_path / "t.txt").write_text("b|a|c\n1|x|\n2|y|z\n")
    got = delimited.read_delimited(spark, str(tmp_path / "t.txt"), columns=["a", "b"])
    assert got.columns == ["a", "b"] and sorted(map(tuple, got.collect())) == [("x", "1"), ("y", "2")]


def test_line_breaks_are_found(spark, tmp_path):
    (tmp_path / "one.txt").write_text('a|b\n"x ""y"""|1\n')
    (tmp_path / "two.txt").write_text('a|b\n"x\ny"|1\n')
    assert not delimited.has_line_breaks(spark, str(tmp_path / "one.txt"))
    assert delimited.has_line_breaks(spark, str(tmp_path / "two.txt"))
    assert delimited.read_delimited(spark, str(tmp_path / "two.txt")).first().a == "x\ny"


def test_catalogue_keeps_rejects(spark, tmp_path):
    (tmp_path / "t.txt").write_text("id|n\n1|2\n2|two\n3|\n")
    counts = tables.load_catalogue(spark, {"few": str(tmp_path / "t.txt")}, str(tmp_path / "out"),
                                   {"few": tables.layout("id INT, n INT")})
    assert counts == {"few": 3}
    assert [(r.id, list(r.bad_fields)) for r in spark.table("rejects_few").collect()] == [("2", ["n=two"])]


def test_lines_without_ordinal_keep_their_content(spark, tmp_path):
    lines = ['{"type": "node", "id": %d, "lon": %d.0, "lat": 1.0}' % (k % 7, k) for k in range(40)]
    (tmp_path / "e.json").write_text("\n".join(lines))
    read = elements.read_element_lines(spark, str(tmp_path / "e.json"))
    got = quality.last_wins(read.select("id", "lon", "lat", "ordinal"), ["id"], "ordinal").collect()
    assert {r.id: r.lon for r in got} == {k % 7: float(k) for k in range(40)}


# Layouts ----------------------------------------------------------------------------------------

def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_laid_out_facts_meet_without_an_exchange(spark, tmp_path):
    from cairn.queries import QUERIES, load_all, read
    from cairn.queries.tables import laid_out_attempts

    load_all()
    folder = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "40k")  # facts are too large for it, the others are not
    try:
        view = laid_out_attempts(lambda name: read(spark, folder, name), str(tmp_path / "facts"))
        plan = executed(view)
        assert "SortMergeJoin [expedition_id" in plan and "Exchange hashpartitioning" not in plan
        assert plan.count("Bucketed: true") == 2 and "PartitionFilters: [isnotnull(year" in plan
        recent = spark.table(re.search(r"laid_expedition_\w+", plan)[0]).where("year >= 1998")
        files = {r["f"] for r in recent.select(F.input_file_name().alias("f")).distinct().collect()}
        assert files and all(int(re.search(r"/year=(\d+)/", f)[1]) >= 1998 for f in files)
        plain = QUERIES["base_view"](spark, folder)
        assert "Exchange hashpartitioning" in executed(plain)
        assert view.exceptAll(plain).isEmpty() and plain.exceptAll(view).isEmpty() and view.count() > 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_layout_is_found_by_its_catalogue(spark, tmp_path):
    root = str(tmp_path / "fact")
    with pytest.raises(FileNotFoundError):
        layouts.open_layout(spark, root, "no_fact")
    rows = spark.range(1000).selectExpr("id AS k", "cast(id % 3 AS string) AS part", "id * 2 AS v")
    first = layouts.write_layout(rows, root, "k", 4, ["part"])
    assert (first["rows"], first["buckets"], first["partitions"]) == (1000, 4, ["part"]) and layouts.is_even(first)
    opened = layouts.open_layout(spark, root, "some_fact")
    assert opened.columns == ["k", "v", "part"] and opened.where("part = '1'").count() == 333
    spark.range(5).write.parquet(f"{root}/data/cut-short")  # no entry
    layouts.write_layout(rows.where("k < 10"), root, "k", 4, ["part"], files=3)
    assert layouts.open_layout(spark, root, "some_fact").count() == 10
    assert len(layouts.entries(spark, root)) == 2
    empty = layouts.write_layout(rows.where("false"), root, "k", 4)
    assert empty["rows"] == 0 and layouts.open_layout(spark, root, "some_fact").count() == 0


def test_an_uneven_key_is_opened_without_buckets(spark, tmp_path):
    root = str(tmp_path / "hot")
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS v")
    entry = layouts.write_layout(rows, root, "k", 32, files=4)
    assert entry["most"] >= 1000 and not layouts.is_even(entry)
    hot = layouts.open_layout(spark, root, "hot_fact")
    assert "Bucketed: true" not in executed(hot.groupBy("k").count())
    assert "Bucketed: true" in executed(layouts.open_layout(spark, root, "hot_fact", bucketed=True).groupBy("k").count())
    assert hot.count() == 3000
