"""Text tables: every column a string, sentinels like NA kept, leading zeros kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema(names: str) -> T.StructType:
    return T.StructType([T.StructField(n.strip(), T.StringType()) for n in names.split(",")])


# The tables' columns, in order.
PARSED = schema("form_type, xml_file, filer_name, filer_ein, return_year, grantee, recipient_ein, grantee_addr1, grantee_addr2, grantee_city, grantee_state, grantee_zip, grantee_country, grantee_addr_type, grant_amount, grant_purpose")
MATCHED = T.StructType([*PARSED, *schema("ipeds_unitid, canonical_id")])
GRANTS = schema("xml_file, grantee, grantee_addr1, grantee_addr2, grantee_city, grantee_state, grantee_zip, grantee_country, grantee_addr_type, grant_amount, grant_purpose, canonical_id, tag, uid")
DIM = schema("canonical_id, grantee_normalized, state, country, entity_class, city")
LOG = schema("xml_file, timestamp, form_type, filer_name, filer_ein, filer_support_org, return_year")
LOG_UPLOAD = schema("xml_file, timestamp, form_type, filer_name, filer_ein, return_year, funder_support_org")
AUDIT = schema("grantee, grantee_city, grantee_state, grantee_zip, grantee_country, disposition, is_new_mint, canonical_id, canonical_name, canonical_city, ipeds_unitid, entity_class, n_grants, total_amount, correct_ipeds_unitid, notes")
MANIFEST = schema("xml_path, form_type")


def read_text_table(spark: SparkSession, path: str, expected: T.StructType | None = None) -> DataFrame:
    """A CSV of strings by header. Columns that expected names and the file lacks are empty; others stay out."""
    df = spark.read.csv(path, header=True, inferSchema=False, nullValue="\0", emptyValue="", multiLine=True, escape='"')
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    if expected is None:
        return df
    return df.select(*[(F.coalesce(F.col(f.name), F.lit("")) if f.name in df.columns else F.lit("")).alias(f.name) for f in expected])


def read_skip_list(spark: SparkSession, path: str) -> DataFrame:
    """xml_file: the base names in the first column of a log; header spellings drop out; a missing file is empty."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "xml_file string")
    rows = spark.read.csv(path, header=False, inferSchema=False).select(F.trim(F.element_at(F.split(F.regexp_replace("_c0", "^﻿", ""), "/"), -1)).alias("xml_file"))
    headers = ["xml_file", "file", "filename", "xml file"]
    return rows.filter((F.col("xml_file") != "") & ~F.lower("xml_file").isin(*headers)).distinct()


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """xml_path, form_type of returns that were fetched before."""
    return read_text_table(spark, path, MANIFEST).filter("xml_path <> ''").distinct()


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """filer_ein, return_year already emitted."""
    return read_text_table(spark, path, schema("filer_ein, return_year")).distinct()


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """filer_ein to leave out: the column of that name, else the first."""
    df = read_text_table(spark, path)
    name = next((c for c in df.columns if "".join(x for x in c.lower() if x.isalnum()) in ("filerein", "ein")), df.columns[0])
    return df.select(F.trim(F.col(name)).alias("filer_ein")).filter("filer_ein <> ''").distinct()
