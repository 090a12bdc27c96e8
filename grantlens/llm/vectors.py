"""Vectors as integers: which rows take part, and their components as exact whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Components are taken in steps of one in so many.
SCALE = 1024


def whole(vectors: DataFrame, limit: float, shift: int = 0, label: bool = False) -> DataFrame:
    """vec_id, x (array<long>: floor(SCALE * component) + shift), and label if asked for, of the rows that take part.

    Vectors that are null, empty, of another length than most, or that hold null, non-finite or larger components than
    limit (where whole numbers would no longer be exact) take no part. Null ids do.
    """
    tag = [F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")] if label else []
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), *tag, F.col("embedding").cast("array<double>").alias("v")).filter("v IS NOT NULL AND size(v) > 0")
    rows = rows.filter(F.expr(f"NOT exists(v, c -> c IS NULL OR isnan(c) OR abs(c) > {float(limit)!r}D)"))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.filter(F.size("v") == (most["n"] if most else 0))
    return rows.withColumn("x", F.expr(f"transform(v, c -> CAST(floor(c * {SCALE}D) AS BIGINT) + {shift}L)")).drop("v")


def matrix(column: pa.Array) -> np.ndarray:
    """A list column, all of one length and none null, as a table of its own."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
