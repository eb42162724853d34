"""Every registered query against its SQL counterpart."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from lawtree.plans.oracles import ORACLES
from lawtree.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "decimal(38,18)": "DECIMAL(38,18)",
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    cursor = db.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    types = dict(r[:2] for r in db.execute("DESCRIBE " + ORACLES[name]).fetchall())
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == types
    cursor = db.execute(ORACLES[name])
    want = Counter(tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall())
    got = Counter(tuple(r) for r in df.select(columns).collect())
    assert got == want and got


def test_entry(spark):
    assert entry.entry(spark).count() == 17
