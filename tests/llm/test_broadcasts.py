"""What grows with the input is never broadcast, however small its Parquet files look to the planner."""

import random

from fixtures import frame

from grantlens.llm import simhash, stages


def planned(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_looked_up_halves_are_not_broadcast(spark):
    rng = random.Random(3)
    prints = spark.createDataFrame([(rng.getrandbits(63),) for _ in range(200)], "fp long")
    assert "Broadcast" not in planned(simhash.links(prints))


def test_near_duplicates_are_named_without_broadcasts(spark):
    assert "Broadcast" not in planned(simhash.near_duplicates(frame(spark)))
    assert "Broadcast" not in planned(stages.near_duplicate_stage(spark, frame(spark), ""))
