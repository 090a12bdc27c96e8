"""The driver's contract."""

import __spark_entry__ as e


def test_names():
    queries, oracles = e.queries(), e.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) >= 60
    assert all(callable(f) for f in queries.values())
    if e.corpus_pipeline is not None:
        assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {q.split("_")[0] for q in queries if q.startswith("op") and q[2:3].isdigit() or q == "pipeline"}


def test_entry(spark, small):
    assert e.entry(spark).schema == e.entry(spark).schema
    assert e.entry(spark).limit(1).count() == 1
