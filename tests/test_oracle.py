"""Every query against its SQL, on the smallest given tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from tallyline.plans import oracle, registry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
NAMES = sorted(registry.all_queries())


@pytest.fixture(scope="module")
def db(data_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data_dir}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, db, data_dir, name):
    df = registry.all_queries()[name](spark, data_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = oracle.all_sql().get(name)
    if sql is None:
        assert name == "explain_pruning" and got[1]
        return
    cursor = db.execute(sql)
    want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "transaction_id" and df.count() == 1528


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
