"""Joins with a dimension sort and merge: what its Parquet files weigh says little of its rows."""

from grantlens.operators import matching
from grantlens.plans import q_names


def planned(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_exact_look_ups_are_not_broadcast(spark, small):
    assert "Broadcast" not in planned(matching.exact(q_names.asked(spark, small), q_names.dimension(spark, small)))


def test_what_the_cascade_left_open_is_not_broadcast(spark, small):
    assert "Broadcast" not in planned(q_names.cascade_resolve(spark, small))


def test_accuracy_joins_parts_without_a_broadcast(spark, small):
    assert "Broadcast" not in planned(q_names.accuracy_by_source(spark, small))
