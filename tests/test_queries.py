"""Every registered query against its SQL on the smallest test tables."""

import datetime
import decimal
import importlib.util
import math
import os
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

from civicloom.queries import QUERIES

FOLDER = os.environ.get("CIVICLOOM_TEST_DIR", "/root/testdata/sf0.001")
TABLES = """region nation customer supplier part orders lineitem events documents embeddings
            pages benchmark labels conversations""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def results(spark):
    def run(name):
        df = QUERIES[name](spark, FOLDER)
        return df.columns, [tuple(r) for r in df.collect()]

    with ThreadPoolExecutor(6) as pool:
        waiting = {name: pool.submit(run, name) for name in QUERIES}
        yield waiting


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(name, results, oracle):
    columns, rows = results[name].result()
    answer = oracle.execute(QUERIES[name].sql)
    names = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(names)
    assert table(columns, rows) == table(names, answer.fetchall())


def test_driver_entry(spark):
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
