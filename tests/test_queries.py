"""Every registered query against its SQL counterpart, over the whole small tables."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as E
import tradeweave_oracle

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_same_keys():
    assert set(tradeweave_oracle.oracle()) <= set(E.queries()) & set(E.oracle_sql())


@pytest.mark.parametrize("name", list(tradeweave_oracle.oracle()))
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    got = canon([tuple(r) for r in df.collect()], df.columns)
    assert got == canon(cur.fetchall(), cols)
    assert got


def test_entry_has_rows(spark):
    assert E.entry(spark).columns
