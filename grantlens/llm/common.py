"""Helpers shared by the training-data operators: the shared scratch folder, Arrow batch sizes, prefix sums."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes that one Arrow batch may hold, about; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Batches are bounded by their bytes, not only their rows, so that a Python worker's memory stays bounded with long texts.

    The bound is the session's, as plans are made late; a lower one stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(name).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, or the context's checkpoint folder.

    Where neither is named, a local run gets a temporary folder of its own; on a cluster that would be no shared place.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="grantlens-"))
    return sc.getCheckpointDir().rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read back: lineage ends here and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """df as saved() has it, dealt by keys into as many files as a shuffle has parts: joins on keys don't shuffle it again.

    The table has a name in the session's catalog, as only such tables have buckets; its files are in the shared folder.
    """
    spark, known = df.sparkSession, f"grantlens_{name}_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(parts, *keys).option("path", f"{shared_dir(spark)}/{known}").saveAsTable(known)
    return spark.table(known)


def merged(df: DataFrame) -> DataFrame:
    """df as a side of a join that sorts and merges, whatever the planner takes its size for.

    Before a run sizes are guessed from the bytes of Parquet files, and rows that come of an explode count as nothing. A
    side that grows with the input would be broadcast, through the driver, long after it has outgrown it.
    """
    return df.hint("merge")


def table_at(spark: SparkSession, folder: str, schema: str) -> DataFrame | None:
    """The Parquet table in a folder, or None where there is none yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(schema).parquet(folder)


def ranged(df: DataFrame, keys: list[str], out: str, name: str) -> DataFrame:
    """df as a table sorted into ranges of keys (nulls first), with out: the number of a row's range, which no density of keys makes uneven."""
    parts = df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys]).withColumn(out, F.spark_partition_id())
    return saved(parts, name)


def prefix_sums(df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: Column, out: str) -> DataFrame:
    """Adds out: the sum of value over the rows before this one, by keys, in the order of bucket and then order.

    Two levels, so that no task sorts all rows of a key: rows are summed within (keys, bucket), and only one row a
    bucket goes through the window over keys. Null keys and buckets are groups of their own (null buckets first).
    Adds n_before too: the number of rows before this one in its (keys, bucket).
    """
    by = [*keys, bucket]
    totals = df.groupBy(*by).agg(F.sum(value).alias("_total"))
    ahead = Window.partitionBy(*keys).orderBy(F.col(bucket).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_start"))
    starts = starts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], "_start")
    w = Window.partitionBy(*by).orderBy(*order)
    rows = df.withColumn("n_before", F.row_number().over(w) - 1).withColumn("_own", F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)) - value)
    on = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)]
    return rows.join(starts, on).withColumn(out, F.col("_start") + F.col("_own")).drop("_start", "_own", *[f"_k{i}" for i in range(len(by))])


def boxed(docs: DataFrame) -> DataFrame:
    """docs with box_ before all names: whatever they are, they can't clash with an operator's own columns."""
    return docs.toDF(*[f"box_{c}" for c in docs.columns])


def unboxed(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """docs' columns out of boxed rows, with changed ones; n_chars, where there is one, follows a changed text."""
    if "text" in changed and "n_chars" in docs.columns:
        changed["n_chars"] = F.length(changed["text"])
    return rows.select(*[(changed[f.name].cast(f.dataType) if f.name in changed else F.col(f"`box_{f.name}`")).alias(f.name) for f in docs.schema])
