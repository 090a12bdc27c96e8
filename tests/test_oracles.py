"""Every query with oracle SQL, held against DuckDB on the smallest tables."""

from decimal import Decimal

import duckdb
import pytest

from grantlens.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = registry.queries(), registry.oracles()


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return c


def plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(float(v), 6) if isinstance(v, float | Decimal) else v
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    got = plain(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == plain(columns, result.fetchall())


def test_queries_without_oracle_have_rows(spark, small):
    for name in set(QUERIES) - set(ORACLES):
        assert QUERIES[name](spark, small).count() > 0
