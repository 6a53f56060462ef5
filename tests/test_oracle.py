"""Every query with SQL gives the same rows as an independent engine on the same files."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def sql_engine(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, sql_engine, name):
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = [tuple(row[c] for c in columns) for row in df.collect()]
    relation = sql_engine.execute(oracle_sql()[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in relation.fetchall()]
    assert found
    assert ordered(found) == ordered(expected)


def test_every_sql_text_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    rows = entry(spark).collect()
    assert sorted(r["label"] for r in rows) == [0.0, 1.0]
    assert sum(r["predicted_0"] + r["predicted_1"] for r in rows) > 0
