"""Records cut in byte ranges against the standard library and the reader that takes a whole file."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from cairn.queries import QUERIES, load_all
from cairn.session import scratch_folder
from cairn.sources import delimited, records

load_all()


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def awkward(rnd, n):
    """Fields with line breaks, quotes, separators, spaces, long ones and empty ones."""
    parts = ["a", "é", "|", '"', '""', "\n", "\r\n", "\n\n", " ", "word ", "x" * 50, '"\n"', "|\n|", ""]
    rows = []
    for k in range(n):
        size = rnd.choice([0, 1, 3, 8, 8, 300 if k % 40 == 0 else 5])
        rows.append((str(k), "".join(rnd.choice(parts) for _ in range(size)), rnd.choice(["", "z", " p ", "l\nm"])))
    return rows


def write(path, rows, end="\r\n", header=("id", "text", "note")):
    text = io.StringIO()
    csv.writer(text, delimiter="|", lineterminator=end).writerows([header, *rows])
    path.write_bytes(text.getvalue().encode())
    return text.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_equal_the_standard_library(spark, tmp_path, small_ranges, end):
    rnd = random.Random(len(end))
    want, folder = [], tmp_path / "t"
    folder.mkdir()
    for k, n in enumerate((700, 3, 1, 400, 0)):
        rows = awkward(rnd, n)
        text = write(folder / f"{k}.txt", rows, end)
        parsed = [tuple(r) for r in csv.reader(io.StringIO(text, newline=""), delimiter="|")][1:]
        assert parsed == rows
        want += rows
    got = delimited.read_ranges(spark, str(folder))
    assert got.rdd.getNumPartitions() > 20
    empty_is_null = [tuple(x or None for x in r) for r in want]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(empty_is_null, key=repr)
    assert delimited.has_large_files(spark, str(folder)) and delimited.has_line_breaks(spark, str(folder))
    chosen = delimited.read_delimited(spark, str(folder), columns=["note", "id"])
    assert sorted(map(tuple, chosen.collect()), key=repr) == sorted(((r[2], r[0]) for r in empty_is_null), key=repr)


def test_a_record_longer_than_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f'line {k} "quoted" | more' for k in range(2000))
    rows = [("1", long, "x"), ("2", "y", long), ("3", "", "")]
    path = tmp_path / "long.txt"
    write(path, rows, "\n")
    got = {r.id: (r.text, r.note) for r in delimited.read_ranges(spark, str(path)).collect()}
    assert got == {"1": (long, "x"), "2": ("y", long), "3": (None, None)}


def test_a_header_with_line_breaks_over_ranges(spark, tmp_path, small_ranges):
    name = "first\n" * 900 + "last"
    path = tmp_path / "head.txt"
    write(path, [("1", "a\nb", ""), ("2", "c", "")], "\n", header=("id", name, "note"))
    got = delimited.read_ranges(spark, str(path))
    assert got.columns == ["id", name, "note"]
    assert sorted((r[0], r[1]) for r in got.collect()) == [("1", "a\nb"), ("2", "c")]


def test_stray_and_unclosed_quotes(spark, tmp_path, small_ranges):
    path = tmp_path / "odd.txt"
    body = "".join(f'{k}|5" pipe and 6" pipe|"a\nb"\n' for k in range(300))
    path.write_text("id|text|note\n\n" + body + '900|x|"never closed\n901|y|z\n')
    got = {r.id: (r.text, r.note) for r in delimited.read_ranges(spark, str(path)).collect()}
    same = {r.id: (r.text, r.note) for r in delimited.read_delimited(spark, str(path), multiline=True).collect()}
    assert {k: v for k, v in got.items() if k != "900"} == {str(k): ('5" pipe and 6" pipe', "a\nb") for k in range(300)}
    assert set(got) == set(same) and got["900"][1].startswith("never closed\n901|y|z")


def test_states_of_ranges_compose(spark):
    rnd = random.Random(2)
    kinds = [(False, False), (True, True), (False, True), (True, False)]
    maps = [(f, s, *rnd.choice(kinds if f else kinds[2:])) for f in range(4) for s in range(0, 600, 10)]

    class Ranges:
        """Stands for lines that have these maps."""

        def mapInArrow(self, _, schema):
            return spark.createDataFrame(maps, schema)

    got = {(r["file"], r["start"]): (r["inside"], r["open"]) for r in records.range_states(Ranges(), "|", '"').collect()}
    for f in range(4):
        state = False
        for _, s, outside, inside in sorted(m for m in maps if m[0] == f):
            after = inside if state else outside
            assert got[f, s] == (state, after)
            state = after


def test_one_large_file_is_many_tasks(spark, small_ranges):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path, n = delimited.write_delimited(docs.coalesce(1), scratch_folder(spark, "one-file"))
    got = delimited.read_delimited(spark, path)
    assert n == docs.count() == got.count()
    assert got.rdd.getNumPartitions() > 100
    wanted = docs.select(*(F.col(c).cast("string").alias(c) for c in docs.columns))
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_no_task_writes_all_documents(spark, tmp_path, small_ranges):
    docs = spark.createDataFrame([(k, f"a|{k}\n" * 40, 80) for k in range(400)], "doc_id INT, text STRING, n_chars INT")
    docs.repartition(8).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["dsv_ranges"](spark, str(tmp_path))
    assert len(got.inputFiles()) >= 8
    assert sorted(map(tuple, got.collect())) == sorted((str(k), f"a|{k}\n" * 40, "80") for k in range(400))


@pytest.mark.parametrize("line, start, end", [
    ("a|b", False, False), ('a|"b', False, True), ('a|"b""', False, True), ('a|"b"', False, False), ('c""d', True, True),
    ('c"', True, False), ('c"|"d', True, True), ('5" x', False, False), ('a"|b', True, False), ('"', False, True),
    ('""', False, False), ('""', True, True), ('"""', False, True), ('"""', True, False), ("", True, True)])
def test_scanner(line, start, end):
    assert records.scanner("|", '"')(line, start) is end
