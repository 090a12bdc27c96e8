"""Global row numbers and first-seen rows without a single sorting task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions that one bucket spans.
SPAN = 1 << 16


def numbered(df: DataFrame, position: str, out: str) -> DataFrame:
    """Adds out: 1, 2, ... by position (a long, any gaps). Only one row a bucket of SPAN positions meets in one task."""
    rows = df.withColumn("_bucket", F.floor(F.col(position) / SPAN))
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_size"))
    ahead = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_bucket").orderBy(position))
    return rows.withColumn("_own", own).join(starts, "_bucket").withColumn(out, F.col("_start") + F.col("_own")).drop("_bucket", "_own", "_start")


def first_rows(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """The row of least position of each key: an argmin aggregate, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(position)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key; Spark keeps no more than n a key and task before the shuffle."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).filter(F.col("_nth") <= n).drop("_nth")
