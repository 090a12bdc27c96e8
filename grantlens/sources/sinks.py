"""Sinks: stamped Parquet as the native store, text tables for upload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import bool_text


def as_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns as text, in order: booleans True or False, null empty."""
    out = []
    for f in schema:
        if f.name not in df.columns:
            out.append(F.lit("").alias(f.name))
        else:
            kind = df.schema[f.name].dataType
            c = bool_text(F.col(f.name)) if isinstance(kind, T.BooleanType) else F.col(f.name).cast("string")
            out.append(F.coalesce(c, F.lit("")).alias(f.name))
    return df.select(*out)


def write_increment(df: DataFrame, schema: T.StructType, path: str, stamp: str) -> None:
    """A text increment under stamp=..., written again if a run is repeated. Each file begins with a byte order mark, as part
    of its first header, for spreadsheets."""
    out = as_text(df, schema)
    out.toDF("\ufeff" + out.columns[0], *out.columns[1:]).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(f"{path}/stamp={stamp}")


def write_stage(df: DataFrame, path: str, stamp: str) -> None:
    """A stage's result in the native store."""
    df.write.mode("overwrite").parquet(f"{path}/stamp={stamp}")


def append_log(df: DataFrame, schema: T.StructType, path: str) -> None:
    as_text(df, schema).write.mode("append").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """One sorted file, for people; the report is one row a group, not a row a record."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
