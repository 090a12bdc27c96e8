"""Queries over the star schema: audits, samples, reports, uploads, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.lineage import shared_folder
from ..operators import dedupe, matching, reporting, verdicts
from ..sources import sinks, tables
from ..streaming import ingest
from .common import registry, table
from .q_names import asked, plain_dimension

QUERIES, query = registry()


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy names resolved to entities, each customer-year's last order kept, money by entity and year."""
    found = matching.exact(asked(spark, sf_dir), plain_dimension(spark, sf_dir)).select(F.col("qid").alias("l_partkey"), "canonical_id")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    last = dedupe.latest_filing_grants(lines, "o_custkey", "year", "o_orderkey").join(found, "l_partkey", "left")
    rows = last.withColumn("canonical_id", F.coalesce("canonical_id", F.lit("unresolved")))
    return reporting.totals(rows, ["canonical_id", "year"], "l_extendedprice").orderBy(F.desc("total"), "canonical_id", "year")


@query("""WITH a AS (SELECT o_orderpriority, o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN 0 WHEN o_orderkey % 10 = 1 THEN NULL ELSE o_totalprice END AS amount FROM orders)
SELECT o_orderpriority, o_orderstatus, count(*) AS n_grants, round(coalesce(sum(amount), 0), 2) AS total_amount FROM a GROUP BY ALL""")
def audit_rollup(spark, sf_dir):
    """Counts and tolerant sums of money texts: $1,234.50, blank, garbage."""
    amount = F.when(F.col("o_orderkey") % 10 == 0, "").when(F.col("o_orderkey") % 10 == 1, "n/a").otherwise(F.concat(F.lit("$ "), F.format_number("o_totalprice", 2)))
    rows = table(spark, sf_dir, "orders").withColumn("amount", amount)
    return reporting.audit(rows, ["o_orderpriority", "o_orderstatus"], "amount")


DISPOSED = "SELECT *, CASE WHEN doc_id % 11 = 0 THEN 'NA' WHEN doc_id % 11 = 1 THEN 'NCI' WHEN doc_id % 11 = 2 THEN 'review' WHEN lang = 'fr' THEN 'new_mint' ELSE 'matched' END AS disposition FROM documents"


@query(f"SELECT source, count(*) FILTER (disposition = 'new_mint') AS n_new_mint, count(*) FILTER (disposition = 'review') AS n_review, count(*) FILTER (disposition = 'matched') AS n_matched, count(*) FILTER (disposition = 'NCI') AS n_nci, count(*) FILTER (disposition = 'NA') AS n_na FROM ({DISPOSED}) GROUP BY source")
def disposition_pivot(spark, sf_dir):
    key = F.col("doc_id") % 11
    ident = F.when(key == 0, "NA").when(key == 1, "NCI").when(key == 2, "").otherwise(F.col("doc_id").cast("string"))
    rows = table(spark, sf_dir, "documents").select("source", reporting.disposition(ident, F.col("lang") == "fr").alias("disposition"))
    return reporting.disposition_pivot(rows, "source", "disposition", reporting.RANK)


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as grants of a customer to a part."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))  # noqa: E741
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))


STAR = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"


@query(f"SELECT o_custkey, p_name, year(o_orderdate) AS year, count(*) AS n, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total FROM {STAR} GROUP BY ALL")
def funder_by_institution_year(spark, sf_dir):
    return reporting.totals(star(spark, sf_dir), ["o_custkey", "p_name", "year"], "amount").withColumn("total", F.col("total").cast("double"))


@query(f"SELECT p_type, year(o_orderdate) AS year, count(*) AS n, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total FROM {STAR} GROUP BY ROLLUP (p_type, year(o_orderdate))")
def type_year_rollup(spark, sf_dir):
    return reporting.totals(star(spark, sf_dir), ["p_type", "year"], "amount", rollup=True).withColumn("total", F.col("total").cast("double"))


@query(f"SELECT p_type, year(o_orderdate) AS year, count(*) AS n, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total FROM {STAR} GROUP BY CUBE (p_type, year(o_orderdate))")
def type_year_cube(spark, sf_dir):
    return reporting.totals(star(spark, sf_dir), ["p_type", "year"], "amount", cube=True).withColumn("total", F.col("total").cast("double"))


@query("SELECT o_orderkey, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F' GROUP BY o_orderkey")
def double_count_filter(spark, sf_dir):
    log = table(spark, sf_dir, "orders").select("o_orderkey", text.bool_text(F.col("o_orderstatus") == "F").alias("funder_support_org"))
    rows = reporting.without_double_counts(table(spark, sf_dir, "lineitem").withColumn("file", F.col("l_orderkey")), log.withColumnRenamed("o_orderkey", "file"), "file", "funder_support_org")
    return rows.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def coverage_audit(spark, sf_dir):
    """Customers expected to have a large order, and without one."""
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return reporting.coverage_gaps(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), large, "c_custkey")


@query("SELECT lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), doc_id) <= 20")
def stratified_sample(spark, sf_dir):
    """Twenty documents a language, in the order of their ids' digests."""
    return reporting.stratified_sample(table(spark, sf_dir, "documents").select("lang", "doc_id"), "lang", [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")], 20)


@query("""WITH p AS (SELECT regexp_extract(p_name, '^\\w+') || ' ' || p_type AS pattern, p_retailprice FROM part) SELECT pattern, count(*) AS n, round(sum(p_retailprice), 2) AS total FROM p GROUP BY pattern""")
def pattern_queue(spark, sf_dir):
    pattern = F.concat_ws(" ", F.substring_index("p_name", " ", 1), F.col("p_type"))
    return verdicts.pattern_queue(table(spark, sf_dir, "part"), pattern, "p_retailprice").withColumn("total", F.round("total", 2))


@query("""SELECT l_orderkey || '_public.xml' AS xml_file, p_name AS grantee, '' AS grantee_addr1, '' AS grantee_addr2, '' AS grantee_city, p_brand AS grantee_state, '' AS grantee_zip, '' AS grantee_country, '' AS grantee_addr_type, l_quantity::INT::VARCHAR AS grant_amount, l_linestatus AS grant_purpose,
CASE WHEN p_type = 'PROMO' THEN '' ELSE 'P' || min(p_partkey) OVER (PARTITION BY p_name) END AS canonical_id, CASE l_linestatus WHEN 'O' THEN 'stem' ELSE 'other' END AS tag, '' AS uid FROM lineitem JOIN part ON l_partkey = p_partkey""")
def upload_projection(spark, sf_dir):
    """Grants with both maps joined back, as text in the upload's columns."""
    part = table(spark, sf_dir, "part")
    first = part.groupBy("p_name").agg(F.min("p_partkey").alias("p"))
    ids = part.filter("p_type <> 'PROMO'").select("p_name", "p_brand", "p_type").distinct().join(first, "p_name")
    ids = ids.select(text.qnorm(F.col("p_name")).alias("k0"), F.upper("p_brand").alias("k1"), F.col("p_type").alias("k2"), F.concat(F.lit("P"), F.col("p").cast("string")).alias("value"))
    rows = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select(F.concat(F.col("l_orderkey").cast("string"), F.lit("_public.xml")).alias("xml_file"), F.col("p_name").alias("grantee"), F.col("p_brand").alias("grantee_state"), F.col("l_quantity").cast("int").alias("grant_amount"), F.col("l_linestatus").alias("grant_purpose"), "p_type")
    rows = reporting.mapped_back(rows, ids, [("name", text.qnorm(F.col("grantee"))), ("state", F.upper("grantee_state")), ("type", F.col("p_type"))], "canonical_id", "")
    tags = spark.createDataFrame([("o", "stem")], "k0 string, value string")
    rows = reporting.mapped_back(rows, tags, [("purpose", text.qnorm(F.col("grant_purpose")))], "tag", "other")
    return sinks.as_text(rows, tables.GRANTS)


@query("SELECT event_id, event_type FROM events")
def stream_ingest_dedupe(spark, sf_dir):
    """Events as a stream of files, into a table with one row a key; a second run adds nothing."""
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    events.write.parquet(f"{base}/in/a")
    for _ in range(2):
        ingest.ingest_once(ingest.stream_files(spark, f"{base}/in/*", events.schema, most=4), f"{base}/out", f"{base}/state", "event_id")
    return spark.read.parquet(f"{base}/out").select("event_id", "event_type")
