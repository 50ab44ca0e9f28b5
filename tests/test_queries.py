"""Every query with SQL equals that SQL in DuckDB on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from quayside.plans import registry

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf, oracle, name):
    df = registry.queries()[name](spark, sf)
    result = oracle.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = sorted(repr(tuple(plain(row[columns.index(c)]) for c in order)) for row in result.fetchall())
    got = sorted(repr(tuple(plain(row[c]) for c in order)) for row in df.collect())
    assert got == want
