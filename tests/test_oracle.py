"""Every registered panel query against its DuckDB text on the smallest sample."""

import datetime
import decimal
import math

import duckdb
import pytest

from plumbline.plans import depth_queries, landed_queries, more_queries  # noqa: F401
from plumbline.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    return "nan" if isinstance(x, float) and math.isnan(x) else x


def keyed(rows):
    return sorted(([plain(v) for v in r] for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = keyed([[r[c] for c in columns] for r in df.collect()])
    found = db.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    expected = keyed([[r[names.index(c)] for c in columns] for r in found.fetchall()])
    assert len(got) == len(expected)
    for a, b in zip(got, expected, strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=2e-6), (a, b)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
