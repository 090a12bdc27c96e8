"""The processed log as a bucketed, sorted table: what is new is dealt to the log's buckets, and the log stays where it lies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import cut


class BucketedLog:
    """A log by key, in `buckets` parts by a hash of the key, each sorted. name: of the table; folder: where it lies, shared by all executors."""

    def __init__(self, spark: SparkSession, name: str, folder: str, key: str, buckets: int) -> None:
        self.spark, self.name, self.folder, self.key, self.buckets = spark, name, folder, key, buckets

    def append(self, rows: DataFrame) -> None:
        """Adds rows. They are dealt to the buckets first, so a task writes one file of each bucket and no more."""
        dealt = rows.repartition(self.buckets, self.key)
        dealt.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key).option("path", self.folder).mode("append").saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def unprocessed(self, rows: DataFrame) -> DataFrame:
        """Rows whose key the log lacks: a merge of the buckets with the new rows, which alone are shuffled. Null keys are new."""
        done = self.read().select(F.col(self.key).alias("_done")).hint("merge")
        return rows.repartition(self.buckets, self.key).join(done, F.col(self.key) == F.col("_done"), "left_anti")

    def merge(self, rows: DataFrame, position: str) -> DataFrame:
        """Appends the first row, by position, of each key that the log lacks, and returns them."""
        new = self.unprocessed(rows)
        rest = [c for c in new.columns if c != self.key]
        first = new.groupBy(self.key).agg(F.min_by(F.struct(*rest), F.col(position)).alias("_row")).select(self.key, "_row.*").select(*new.columns)
        first = cut(first)  # what is new now is no longer new once it is appended
        self.append(first)
        return first
