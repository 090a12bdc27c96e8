"""Cutting lineage through the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is named, a local run gets a temporary one; on a cluster that would be
    no shared place."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if sc.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="grantlens-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def own_folder(spark: SparkSession) -> str:
    """The application's own folder in the shared one."""
    return f"{shared_folder(spark)}/run-{spark.sparkContext.applicationId}"


def merged(df: DataFrame) -> DataFrame:
    """df as a side of a join that sorts and merges, whatever the planner takes its size for.

    Before a run sizes are guessed from the bytes of Parquet files, which are few where names repeat, and rows that come of an
    explode count as nothing. A side that grows with the dimension would be broadcast, through the driver, for that.
    """
    return df.hint("merge")


def cut(df: DataFrame) -> DataFrame:
    """df written as Parquet in the application's folder and read back: lineage ends here, sizes are known to the planner,
    and columns are pruned."""
    path = f"{own_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Removes all that cut() wrote in this application. What was read from there can't be read after."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
