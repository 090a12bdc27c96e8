"""Incremental ingestion as a stream of files: a checkpoint in place of a skip-list, idempotent batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_files(spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "parquet", most: int | None = None) -> DataFrame:
    reader = spark.readStream.format(kind).schema(schema)
    if most:
        reader = reader.option("maxFilesPerTrigger", most)
    return reader.load(path)


def ingest_once(stream: DataFrame, target: str, checkpoint: str, key: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Runs over all that is new and stops. A batch keeps one row a key, drops keys the target has, and writes under its own
    number, so a batch that is run again replaces itself."""
    spark = stream.sparkSession

    def put(batch: DataFrame, number: int) -> None:
        new = transform(batch).dropDuplicates([key])
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(target)
        if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            seen = spark.read.parquet(target).filter(F.col("batch") != number).select(F.col(key).alias("_seen"))
            new = new.join(seen, F.col(key) == F.col("_seen"), "left_anti")
        new.write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def rates(stream: DataFrame, ts: str, window: str, late: str, by: str) -> DataFrame:
    """Counts by event-time window and kind, for monitoring a log; rows later than `late` drop out."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window), by).agg(F.count("*").alias("n"))
