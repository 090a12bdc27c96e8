"""Answers as a store: what a model was asked once, under one version of its prompt, is never asked again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text

#: Names that are asked about, and whose answers are stored, at a time: what a crash can lose.
ROUND = 100_000


def _stored(spark, folder: str, schema: str) -> DataFrame:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def answered(names: DataFrame, name: str, ask: Callable[[DataFrame], DataFrame], answer: str, version: str, folder: str, most: int = ROUND) -> tuple[DataFrame, int]:
    """(key and the answer's columns for each distinct normalised name, how many were asked now).

    The store holds a row for each key and prompt version. Keys that it lacks are asked in rounds of about `most`, dealt by
    a hash, and a round's answers are appended before the next begins; so a run that dies is taken up where its last whole
    round ended. ask: a function of a DataFrame (key, name), of which a row a key comes back with the answer's columns;
    a key that it leaves out is asked again the next time. Null and empty names have no answer.
    """
    spark = names.sparkSession
    schema = f"key string, version string, {answer}"
    columns = [c.split()[0] for c in answer.split(", ")]
    wanted = names.select(text.norm(F.col(name)).alias("key"), F.col(name).alias("name")).filter("key <> ''").groupBy("key").agg(F.min("name").alias("name"))

    def known() -> DataFrame:
        return _stored(spark, folder, schema).filter(F.col("version") == version)

    def lacking() -> DataFrame:
        return wanted.join(known().select(F.col("key").alias("_k")), F.col("key") == F.col("_k"), "left_anti")

    open_ = lacking().count()
    rounds = -(-open_ // most)
    for nth in range(rounds):
        # by the key alone: what earlier rounds stored doesn't deal the rest anew
        some = lacking().filter(F.pmod(F.xxhash64("key"), F.lit(rounds)) == nth)
        ask(some).select("key", F.lit(version).alias("version"), *columns).write.mode("append").parquet(folder)
    # two runs at once may have stored one key twice
    found = known().groupBy("key").agg(F.min(F.struct(*columns)).alias("a")).select("key", "a.*")
    return found.join(wanted.select(F.col("key").alias("_k")), F.col("key") == F.col("_k"), "left_semi"), open_
