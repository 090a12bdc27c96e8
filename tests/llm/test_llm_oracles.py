"""Queries with oracle SQL against DuckDB."""

import duckdb
import pytest

from grantlens.llm.oracles import ORACLES
from grantlens.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, small, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = QUERIES[name](spark, small)
    result = c.execute(ORACLES[name])
    columns = [x[0] for x in result.description]
    assert columns == df.columns
    assert sorted(map(tuple, df.collect())) == sorted(result.fetchall())
