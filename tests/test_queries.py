"""Every registered query of the core library against its SQL in DuckDB."""

import datetime
import decimal

import duckdb
import pytest

from vellum import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


def plain(x):
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, float):
        return round(x, 6)
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    return x


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, con, name):
    df = queries.QUERIES[name](spark, sf)
    if name not in queries.ORACLE_SQL:
        assert df.count() > 0
        return
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=key)
    assert got == sorted((tuple(map(plain, r)) for r in want.fetchall()), key=key)
