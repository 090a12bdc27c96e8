"""The master index of filings, and what is left of it to fetch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.numbering import first_rows, top_rows

FORMS = ("990", "990pf")
TAX_FIELDS = ("taxyear", "taxperiodenddate", "taxperiod")
SUBMITTED_FIELDS = ("submittedon", "returnts", "datesigned", "indexedon")


def bare(name: str) -> str:
    """A header as [a-z0-9]."""
    return "".join(c for c in name.lower() if c.isascii() and c.isalnum())


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A CSV index (.gz too), all text, headers as [a-z0-9]. A .gz file isn't splittable, so rows are dealt out anew."""
    df = spark.read.csv(path, header=True, inferSchema=False, nullValue="\0", emptyValue="", encoding="UTF-8")
    df = df.toDF(*[bare(c) for c in df.columns])
    return df.repartition(spark.sparkContext.defaultParallelism) if path.endswith(".gz") else df


def latest_snapshot(files: DataFrame) -> DataFrame:
    """The one key to use, of key and modified: those of all years first, then the latest date in the name, then the latest change."""
    date = F.regexp_extract("key", r"(\d{4}-?\d{2}-?\d{2})", 1)
    rank = F.struct(F.col("key").contains("all_years").alias("whole"), F.regexp_replace(date, "-", "").alias("date"), F.col("modified"))
    return files.filter(F.lower("key").rlike(r"\.csv(\.gz)?$")).agg(F.max_by("key", rank).alias("key"))


def resolve(files: DataFrame, base: str, index_file: str | None = None, index_key: str | None = None) -> str:
    """The index to read: the named file, which must exist; else the named key under base; else the latest one of files (key, modified)."""
    if index_file:
        spark = files.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(index_file)
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            raise FileNotFoundError(index_file)
        return index_file
    key = index_key or latest_snapshot(files).first()["key"]  # one row
    if key is None:
        raise FileNotFoundError(f"no index under {base}")
    return f"{base.rstrip('/')}/{key}"


def in_scope(c: Column, forms: Sequence[str] = FORMS) -> Column:
    """A form type in scope, whatever its case and punctuation."""
    return F.coalesce(text.header_norm(c).isin(*forms), F.lit(False))


def object_key(url: Column, object_id: Column, marker: str, prefix: str, suffix: str) -> Column:
    """The URL's tail after marker; else a key built from the object id; else null."""
    at = F.instr(url, marker)
    tail = F.when(at > 0, F.substring(url, at + F.lit(len(marker)), F.length(url)))
    return F.coalesce(tail, F.when(~object_id.isin("", "null", "NULL"), F.concat(F.lit(prefix), object_id, F.lit(suffix))))


def first_seen(df: DataFrame, key: str, position: str) -> DataFrame:
    """One row a key, the first by position."""
    return first_rows(df, [key], position)


def capped(df: DataFrame, kind: str, position: str, n: int) -> DataFrame:
    """The first n rows of each kind."""
    return top_rows(df, [kind], [F.col(position)], n)


def unprocessed(df: DataFrame, log: DataFrame, key: str, log_key: str | None = None) -> DataFrame:
    """Rows whose key the log lacks."""
    done = log.select(F.col(log_key or key).alias("_done")).distinct()
    return df.join(done, F.col(key) == F.col("_done"), "left_anti")


def years(df: DataFrame, year: str, include: Sequence[str] | None = None, exclude: Sequence[str] | None = None) -> DataFrame:
    """Rows of the included years, or of all but the excluded ones; a null year is never included and never excluded."""
    if include is not None:
        df = df.filter(F.col(year).isin(*include))
    if exclude is not None:
        df = df.filter(F.col(year).isNull() | ~F.col(year).isin(*exclude))
    return df


def work_list(index: DataFrame, log: DataFrame, least: int, most: int, marker: str, prefix: str, suffix: str, position: str = "pos", fields: Sequence[str] = TAX_FIELDS, cap: int | None = None) -> DataFrame:
    """What to fetch: form scope, then cap, key, first of an object id, skip-list, year: in this order, as caps depend on it."""
    rows = index.filter(in_scope(F.col("formtype")))
    if cap is not None:
        rows = capped(rows, "formtype", position, cap)
    rows = rows.withColumn("key", object_key(F.col("url"), F.col("objectid"), marker, prefix, suffix)).filter("key IS NOT NULL")
    named = rows.filter("objectid IS NOT NULL")
    rows = first_seen(named, "objectid", position).unionByName(rows.filter("objectid IS NULL"))
    rows = rows.withColumn("file", F.element_at(F.split("key", "/"), -1))
    rows = unprocessed(rows, log, "file", "xml_file")
    found = [F.col(f) for f in fields if f in index.columns]
    return rows.withColumn("filing_year", text.filing_year([text.first_filled(f) for f in found], least, most))
