"""Every registered query against its SQL, on the smallest tables."""

import importlib.util
import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

spec = importlib.util.spec_from_file_location(
    "spark_entry", os.path.join(os.path.dirname(os.path.dirname(__file__)), "__spark_entry__.py"))
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return db


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return float(value) if isinstance(value, (bool, int, float)) or hasattr(value, "as_tuple") else str(value)


def canonical(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    answer = duck.execute(sql)
    names = [c[0] for c in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert canonical(rows) == canonical([[r[i] for i in order] for r in answer.fetchall()])


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
