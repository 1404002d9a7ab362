"""Every query with an oracle against DuckDB, on whole tables of the smallest size."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from mailsift.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as from '{SF_DIR}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, 0 if v is None else v) for v in r))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    found = entry.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    expected = duck.sql(f"select {', '.join(columns)} from ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(duck.sql(entry.oracle_sql()[name]).columns) == columns
    assert expected
    assert ordered(tuple(r) for r in found.select(*columns).collect()) == ordered(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(entry.oracle_sql())))
def test_estimator_query_predicts_every_page(spark, duck, name):
    found = entry.queries()[name](spark, SF_DIR)
    (pages,) = duck.sql("select count(*) from pages").fetchall()[0]
    rows = found.collect()
    assert len(rows) == pages == len({r.doc_id for r in rows})
    first, last = (0, 4) if name == "svm_ovr" else (0, 3)
    assert all(first <= r.prediction <= last for r in rows)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "class_id", "word", "weight"]
    assert df.limit(1).count() == 1
