"""Queries on filings: the index, XML returns, refilings, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..operators import dedupe
from ..sources import index, returns
from . import stages
from .common import registry, table

QUERIES, query = registry()


# ---- index ----------------------------------------------------------------------------------------------------
@query("SELECT event_id, event_type IN ('click', 'signup') AS in_scope, coalesce(nullif(nullif(event_type, 'error'), ''), json_extract_string(props, '$.k')) AS label FROM events")
def index_scope_filter(spark, sf_dir):
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("NULL")
    return table(spark, sf_dir, "events").select("event_id", index.in_scope(F.initcap("event_type"), ("click", "signup")).alias("in_scope"), text.first_filled(kind, F.get_json_object("props", "$.k")).alias("label"))


@query("""SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 1996 AND 1998 THEN year(o_orderdate)::VARCHAR WHEN o_orderkey % 3 = 0 THEN '1997' ELSE 'unknown' END AS filing_year FROM orders""")
def plausible_year(spark, sf_dir):
    fallback = F.when(F.col("o_orderkey") % 3 == 0, "1997-13-99").otherwise("7202")
    return table(spark, sf_dir, "orders").select("o_orderkey", text.filing_year([F.date_format("o_orderdate", "yyyy-MM-dd"), fallback], 1996, 1998).alias("filing_year"))


@query("SELECT page_id, CASE WHEN strpos(url, '.example.com/') > 0 THEN substr(url, strpos(url, '.example.com/') + 13) WHEN page_id % 4 <> 0 THEN 'pages/' || page_id || '_public.xml' END AS key FROM pages")
def url_object_key(spark, sf_dir):
    object_id = F.when(F.col("page_id") % 4 != 0, F.col("page_id").cast("string")).otherwise("NULL")
    return table(spark, sf_dir, "pages").select("page_id", index.object_key(F.col("url"), object_id, ".example.com/", "pages/", "_public.xml").alias("key"))


@query("""WITH f AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'all_years_' ELSE 'index_' END || strftime(ts, '%Y-%m-%d') || '_' || event_id || CASE WHEN event_id % 3 = 0 THEN '.csv' WHEN event_id % 3 = 1 THEN '.csv.gz' ELSE '.txt' END AS key, ts, event_id FROM events)
SELECT arg_max(key, (key LIKE '%all_years%', regexp_extract(key, '\\d{4}-\\d{2}-\\d{2}'), ts)) AS key FROM f WHERE key NOT LIKE '%.txt'""")
def latest_snapshot(spark, sf_dir):
    key = F.concat(F.when(F.col("event_id") % 2 == 0, "all_years_").otherwise("index_"), F.date_format("ts", "yyyy-MM-dd"), F.lit("_"), F.col("event_id").cast("string"), F.when(F.col("event_id") % 3 == 0, ".csv").when(F.col("event_id") % 3 == 1, ".csv.gz").otherwise(".txt"))
    return index.latest_snapshot(table(spark, sf_dir, "events").select(key.alias("key"), F.col("ts").alias("modified")))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skiplist_anti(spark, sf_dir):
    return index.unprocessed(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents GROUP BY text")
def first_seen_distinct(spark, sf_dir):
    return index.first_seen(table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("text_md5")), "text_md5", "doc_id")


@query("SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 25")
def cap_per_type(spark, sf_dir):
    return index.capped(table(spark, sf_dir, "events"), "event_type", "event_id", 25).select("event_type", "event_id")


#: CRC-32 bit by bit, as DuckDB has no crc32.
SQL_CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({c}, ''), lambda ch: ascii(ch)::BIGINT)), lambda acc, b: list_reduce(list_concat([xor(acc, b)], range(8)), lambda x, i: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"


@query(f"SELECT doc_id, ({SQL_CRC.format(c='doc_id::VARCHAR')} % 16)::BIGINT AS shard FROM documents")
def crc_shard(spark, sf_dir):
    """Shards by CRC-32 of an id."""
    return table(spark, sf_dir, "documents").select("doc_id", text.shard(F.col("doc_id").cast("string"), 16).alias("shard"))


@query("""SELECT o_orderkey, CASE WHEN year(o_orderdate) IN (1996, 1999) THEN 'own' ELSE 'rest' END AS bucket FROM orders""")
def year_include_exclude(spark, sf_dir):
    """A shard's own years, and the catch-all shard of all others: disjoint and complete."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("y"))
    own = index.years(o, "y", include=["1996", "1999"]).select("o_orderkey", F.lit("own").alias("bucket"))
    return own.unionByName(index.years(o, "y", exclude=["1996", "1999"]).select("o_orderkey", F.lit("rest").alias("bucket")))


# ---- refilings ------------------------------------------------------------------------------------------------
def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as filings: a customer's of a year."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("form_type"), F.when(F.col("o_custkey") % 50 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("filer_ein"), F.year("o_orderdate").alias("return_year"),
        F.col("o_orderdate").alias("return_ts"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("submission_id"), F.col("o_orderkey").alias("pos"),
    )


@query("""SELECT o_orderkey AS pos FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority, CASE WHEN o_custkey % 50 = 0 THEN '#' || o_orderkey ELSE o_custkey::VARCHAR END, year(o_orderdate) ORDER BY o_orderdate DESC, lpad(o_orderkey::VARCHAR, 9, '0') DESC, o_orderkey) = 1""")
def refile_latest(spark, sf_dir):
    return dedupe.latest_refiling(filings(spark, sf_dir)).select("pos")


def line_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"), F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("xml_file"))
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_suppkey")  # noqa: E741
    tie = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "y", "xml_file", "l_linenumber", "l_partkey", "l_extendedprice", tie.alias("tie"))


LINES = "g AS (SELECT o_custkey, year(o_orderdate) AS y, strftime(o_orderdate, '%Y%m%d') || lpad(o_orderkey::VARCHAR, 9, '0') AS xml_file, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


@query(f"WITH {LINES} SELECT o_custkey, y, xml_file, l_linenumber, l_partkey FROM g QUALIFY row_number() OVER (PARTITION BY o_custkey, y ORDER BY xml_file DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1")
def dedupe_row_number_literal(spark, sf_dir):
    return dedupe.one_row_per_filer_year(line_grants(spark, sf_dir), "o_custkey", "y", "xml_file", "tie").select("o_custkey", "y", "xml_file", "l_linenumber", "l_partkey")


@query(f"WITH {LINES} SELECT o_custkey, y, xml_file, l_linenumber, l_partkey, l_extendedprice FROM g QUALIFY xml_file = max(xml_file) OVER (PARTITION BY o_custkey, y)")
def latest_filing_grants(spark, sf_dir):
    return dedupe.latest_filing_grants(line_grants(spark, sf_dir), "o_custkey", "y", "xml_file").drop("tie")


@query("""WITH s AS (SELECT event_id, event_type, value, event_id % 3 AS shard FROM events), m AS (SELECT event_id, event_type, value FROM events WHERE user_id % 4 = 0)
SELECT event_id, event_type, round(value, 6) AS value FROM m UNION ALL SELECT event_id, event_type, round(value + (shard + 1), 6) FROM s WHERE event_id NOT IN (SELECT event_id FROM m)""")
def shard_merge(spark, sf_dir):
    """Shards of a log, one repeated, merged into a master."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "user_id")
    master = e.filter("user_id % 4 = 0").select("event_id", "event_type", "value", F.lit(0).alias("pos"))
    shard = lambda n, pos: e.filter(f"event_id % 3 = {n}").select("event_id", "event_type", (F.col("value") + (n + 1)).alias("value"), F.lit(pos).alias("pos"))
    return dedupe.merge_shards(master, [shard(0, 1), shard(1, 2), shard(1, 3), shard(2, 4)], "event_id", "pos").select("event_id", "event_type", F.round("value", 6).alias("value"))


@query("SELECT s_suppkey, CASE WHEN s_nationkey % 5 = 0 THEN 'changed' ELSE s_name END AS s_name FROM supplier UNION ALL SELECT s_suppkey + 1000000, 'new' FROM supplier WHERE s_nationkey % 5 = 0")
def dim_upsert(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    changed = s.filter("s_nationkey % 5 = 0")
    changes = changed.select("s_suppkey", F.lit("changed").alias("s_name")).unionByName(changed.select((F.col("s_suppkey") + 1000000).alias("s_suppkey"), F.lit("new").alias("s_name")))
    return dedupe.upsert(s.select("s_suppkey", "s_name"), changes, "s_suppkey")


@query("""WITH RECURSIVE y AS (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1), o AS (SELECT *, row_number() OVER (ORDER BY n DESC, y) AS i FROM y),
f AS (SELECT 0::BIGINT AS i, [0::BIGINT, 0, 0] AS load, NULL::BIGINT AS y, NULL::BIGINT AS n, NULL::INT AS bucket UNION ALL SELECT o.i, list_transform(f.load, lambda v, j: CASE WHEN j = list_position(f.load, list_min(f.load)) THEN v + o.n ELSE v END), o.y, o.n, list_position(f.load, list_min(f.load)) - 1 FROM f JOIN o ON o.i = f.i + 1)
SELECT y::INT AS y, n, bucket FROM f WHERE i > 0""")
def lpt_partition(spark, sf_dir):
    years = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    return dedupe.balanced_shards(years, "y", "n", 3)


# ---- XML ------------------------------------------------------------------------------------------------------
def customer_returns(spark: SparkSession, sf_dir: str, variants: bool = False, broken: bool = False, prefix: str = "") -> DataFrame:
    """Orders as XML returns: path, value. variants: element names, and how deep fields lie, by key parity; broken: every
    seventh is cut off; prefix: of every element's name.

    Lines are grouped as they are; their texts are made once a return has them all, so only fields are shuffled.
    """

    def tag(name: str, *body) -> list:
        return [F.lit(f"<{prefix}{name}>"), *body, F.lit(f"</{prefix}{name}>")]

    def group(old: bool):
        named = lambda new, other: other if old else new

        def text_of(x):
            home = F.concat(*tag("USAddress", *tag(named("CityNm", "City"), x["l_suppkey"].cast("string")), *tag("ZIPCd", F.lit("01234"))))
            abroad = F.concat(*tag("ForeignAddress", *tag("CountryCd", x["l_returnflag"])))
            inner = [
                *tag(named("RecipientBusinessName", "RecipientNameBusiness"), *tag(named("BusinessNameLine1Txt", "BusinessNameLine1"), F.lit("Part &amp; "), F.lpad(x["l_partkey"].cast("string"), 9, "0"))),
                F.when(x["l_suppkey"] % 3 == 0, home).when(x["l_suppkey"] % 3 == 1, abroad).otherwise(""),
                *tag(named("RecipientEIN", "EINOfRecipient"), F.lpad(x["l_suppkey"].cast("string"), 9, "0")),
                *tag(named("Amt", "AmountOfCashGrant"), x["l_quantity"].cast("decimal(12,2)").cast("string")),
                *tag(named("PurposeOfGrantTxt", "PurposeOfGrant"), x["l_linestatus"]),
            ]
            return F.concat(*tag("RecipientTable", *(tag("Detail", *tag("Part", *inner)) if old else inner)))

        return F.array_join(F.sort_array(F.transform("lines", text_of)), "")

    fields = F.struct("l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_linestatus")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(fields).alias("lines"))
    o = table(spark, sf_dir, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    groups = F.when(F.col("o_orderkey") % 2 == 1, group(True)).otherwise(group(False)) if variants else group(False)
    space = f':{prefix.rstrip(":")}' if prefix else ""
    head = [
        F.lit(f'<?xml version="1.0"?><{prefix}Return xmlns{space}="http://example.org/r"><{prefix}ReturnHeader>'),
        *tag("ReturnTs", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")),
        *tag("Filer", *tag("EIN", F.lpad(F.col("o_custkey").cast("string"), 9, "0")), *tag("BusinessName", F.lit(f"<{prefix}BusinessNameLine1Txt/>"), *tag("BusinessNameLine1", F.lit("Filer "), F.col("o_custkey").cast("string")))),
        *tag("TaxYr", F.year("o_orderdate").cast("string")), F.lit(f"</{prefix}ReturnHeader>"),
    ]
    data = tag("ReturnData", *tag("SchoolInd", F.when(F.col("o_orderstatus") == "F", "x").otherwise("")), groups)
    o = o.withColumn("value", F.concat(*head, *data, F.lit(f"</{prefix}Return>")))
    if broken:
        cut_off = F.when(F.col("o_orderkey") % 7 == 0, 9).otherwise(0)
        o = o.withColumn("value", F.substring(F.col("value"), F.lit(1), F.length("value") - cut_off))
    return o.select(F.concat(F.lit("/x/"), F.col("o_orderkey").cast("string"), F.lit("_public.xml")).alias("path"), "value")


XML_SQL = """SELECT o_orderkey || '_public.xml' AS xml_file, 'Filer ' || o_custkey AS filer_name, lpad(o_custkey::VARCHAR, 9, '0') AS filer_ein, year(o_orderdate)::VARCHAR AS return_year, o_orderstatus = 'F' AS filer_support_org, 'Part & ' || lpad(l_partkey::VARCHAR, 9, '0') AS grantee, lpad(l_suppkey::VARCHAR, 9, '0') AS recipient_ein,
 CASE WHEN l_suppkey % 3 = 0 THEN l_suppkey::VARCHAR ELSE '' END AS grantee_city, CASE WHEN l_suppkey % 3 = 0 THEN '01234' ELSE '' END AS grantee_zip, CASE l_suppkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN l_returnflag ELSE '' END AS grantee_country, CASE l_suppkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'Foreign' ELSE '' END AS grantee_addr_type,
 l_quantity::DECIMAL(12,2)::VARCHAR AS grant_amount, l_linestatus AS grant_purpose FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
XML_COLUMNS = ["xml_file", "filer_name", "filer_ein", "return_year", "filer_support_org", "grantee", "recipient_ein", "grantee_city", "grantee_zip", "grantee_country", "grantee_addr_type", "grant_amount", "grant_purpose"]


@query(XML_SQL)
def xml_roundtrip(spark, sf_dir):
    """Lines written as XML returns and read back."""
    return returns.grants(returns.filings(customer_returns(spark, sf_dir))).select(*XML_COLUMNS)


@query(XML_SQL)
def xml_variants(spark, sf_dir):
    """The same with older element names in every second return."""
    return returns.grants(returns.filings(customer_returns(spark, sf_dir, variants=True))).select(*XML_COLUMNS)


@query(XML_SQL)
def xml_prefixed(spark, sf_dir):
    """Every element under a namespace prefix."""
    return returns.grants(returns.filings(customer_returns(spark, sf_dir, prefix="r:"))).select(*XML_COLUMNS)


@query("SELECT o_orderkey || '_public.xml' AS xml_file, CASE WHEN o_orderkey % 7 = 0 THEN 'malformed' ELSE 'ok' END AS status, CASE WHEN o_orderkey % 7 = 0 THEN '0001-01-01 00:00:00' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS return_ts, o_orderkey::VARCHAR AS submission_id FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def xml_malformed_skipped(spark, sf_dir):
    return returns.filings(customer_returns(spark, sf_dir, broken=True), groups=False).select("xml_file", "status", F.date_format("return_ts", "yyyy-MM-dd HH:mm:ss").alias("return_ts"), "submission_id")


@query(XML_SQL + " WHERE o_orderstatus <> 'F'")
def xml_unflagged(spark, sf_dir):
    """Returns of flagged filers left out instead of marked."""
    return returns.grants(returns.filings(customer_returns(spark, sf_dir)), keep_flagged=False).select(*XML_COLUMNS)


@query("""WITH r AS (SELECT o_orderkey, o_orderstatus, o_orderkey % 7 = 0 AS bad, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 45) AS bearing FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
SELECT count(*) AS recorded, count(*) FILTER (NOT bad AND bearing) AS kept, count(*) FILTER (NOT bad AND NOT bearing) AS deleted, count(*) FILTER (bad) AS failed, count(*) FILTER (o_orderstatus = 'F' AND NOT bad) AS supporting_org FROM r""")
def run_counters(spark, sf_dir):
    """What became of the returns of a run, counted while their log is written. Of groups only amounts are looked up."""
    files = returns.filings(customer_returns(spark, sf_dir, broken=True), names={"group": fixed.AMOUNTS, "block": []})
    log = files.withColumn("grant_bearing", stages.bearing(lambda g: returns.amount(g).cast("double") >= 45))
    log = log.select("xml_file", "filer_name", "filer_ein", "filer_support_org", "return_year", "status", "grant_bearing")
    _, counts = stages.recorded(log)
    return spark.createDataFrame([counts], "recorded long, kept long, deleted long, failed long, supporting_org long")


@query("""SELECT o_orderkey || '_public.xml' AS xml_file FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
AND (o_custkey, year(o_orderdate)) NOT IN (SELECT (o_custkey, year(o_orderdate)) FROM orders WHERE o_orderpriority = '1-URGENT')""")
def exclusions_and_prior(spark, sf_dir):
    """Filings without excluded filers (a segment's customers) and without filer-years emitted before (those with an urgent order)."""
    ein = lambda c: F.lpad(F.col(c).cast("string"), 9, "0")
    gone = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(ein("c_custkey").alias("filer_ein"))
    prior = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(ein("o_custkey").alias("filer_ein"), F.year("o_orderdate").cast("string").alias("return_year"))
    return stages.wanted(returns.filings(customer_returns(spark, sf_dir), groups=False), prior, gone).select("xml_file")


@query("""SELECT '/x/' || o_orderkey || '_public.xml' AS path, CASE WHEN o_orderstatus = 'F' THEN '990PF' ELSE '990' END AS form_type FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) AND o_orderstatus <> 'P'""")
def manifest_scan(spark, sf_dir):
    """Only returns that a manifest lists; some that it lists are gone."""
    o = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    manifest = o.select(F.concat(F.lit("/x/"), F.col("o_orderkey").cast("string"), F.lit("_public.xml")).alias("xml_path"), F.when(F.col("o_orderstatus") == "F", "990PF").otherwise("990").alias("form_type"))
    gone = manifest.select(F.concat("xml_path", F.lit(".gone")).alias("xml_path"), "form_type")
    return returns.listed(customer_returns(spark, sf_dir), manifest.unionByName(gone)).select("path", "form_type")


@query("""WITH f AS (SELECT 'index_' || strftime(ts, '%Y-%m-%d') || '_' || event_id || '.csv' AS key, ts FROM events) SELECT 'key' AS mode, '/base/named.csv' AS path UNION ALL SELECT 'latest', '/base/' || arg_max(key, (regexp_extract(key, '\\d{4}-\\d{2}-\\d{2}'), ts)) FROM f""")
def index_resolution(spark, sf_dir):
    """The index by a named key, and the latest one where none is named; a named file is covered by a test."""
    key = F.concat(F.lit("index_"), F.date_format("ts", "yyyy-MM-dd"), F.lit("_"), F.col("event_id").cast("string"), F.lit(".csv"))
    files = table(spark, sf_dir, "events").select(key.alias("key"), F.col("ts").alias("modified"))
    return spark.createDataFrame([("key", index.resolve(files, "/base/", index_key="named.csv")), ("latest", index.resolve(files, "/base"))], "mode string, path string")


@query("""SELECT p_partkey, lower(p_name || CASE WHEN p_size % 2 = 0 THEN ' Foundation' ELSE '' END || ' ' || p_brand || ' ' || p_type) AS grantee_match, p_size % 2 = 0 AS grantee_support_org FROM part""")
def grantee_flags(spark, sf_dir):
    """The text that searches run on, and the flag of supporting organisations."""
    name = F.concat("p_name", F.when(F.col("p_size") % 2 == 0, " Foundation").otherwise(""))
    rows = table(spark, sf_dir, "part").select("p_partkey", name.alias("grantee"), F.col("p_brand").alias("grantee_addr1"), F.col("p_type").alias("grantee_addr2"))
    return stages.with_match_columns(rows).select("p_partkey", "grantee_match", "grantee_support_org")


@query("""SELECT c_custkey, CASE WHEN r_name = 'AMERICA' THEN n_name WHEN c_custkey % 2 = 0 THEN 'P' || n_nationkey ELSE '' END AS state, CASE WHEN r_name = 'AMERICA' THEN 'US' WHEN c_custkey % 2 = 0 THEN r_name ELSE '' END AS country, CASE WHEN r_name = 'AMERICA' THEN 'US' WHEN c_custkey % 2 = 0 THEN 'Foreign' ELSE '' END AS type
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def address_union(spark, sf_dir):
    """Domestic, foreign and missing address blocks."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    home = F.concat(F.lit("<AddressUS><State>"), F.col("n_name"), F.lit("</State></AddressUS>"))
    abroad = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("<AddressForeign><ProvinceOrState>P"), F.col("n_nationkey").cast("string"), F.lit("</ProvinceOrState><Country>"), F.col("r_name"), F.lit("</Country></AddressForeign>"))).otherwise("")
    block = F.concat(F.lit("<Return><Filer/><RecipientTable>"), F.when(F.col("r_name") == "AMERICA", F.concat(abroad, home)).otherwise(abroad), F.lit("</RecipientTable></Return>"))
    g = returns.parsed(c.select(F.col("c_custkey").cast("string").alias("path"), block.alias("value"))).select(F.col("path").cast("long").alias("c_custkey"), F.col("groups")[0]["blocks"].alias("blocks"))
    return g.select("c_custkey", returns.address(F.col("blocks")).alias("a")).select("c_custkey", "a.state", "a.country", "a.type")


@query("""SELECT event_id, strftime(CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) - INTERVAL 5 HOUR WHEN 2 THEN date_trunc('day', ts) ELSE TIMESTAMP '0001-01-01' END, '%Y-%m-%d %H:%M:%S') AS return_ts FROM events""")
def return_ts_parse(spark, sf_dir):
    """Times with a zone, with an offset, with a broken time of day, and garbage."""
    key = F.col("event_id") % 4
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    raw = F.when(key == 0, F.concat(iso, F.lit("Z"))).when(key == 1, F.concat(iso, F.lit("+05:00"))).when(key == 2, F.concat(F.substring(iso, 1, 10), F.lit("T99:99"))).otherwise("n/a")
    return table(spark, sf_dir, "events").select("event_id", F.date_format(text.timestamp_or_first(raw), "yyyy-MM-dd HH:mm:ss").alias("return_ts"))


@query("SELECT event_id, json_extract_string(props, '$.k')::INT % 5 = 0 OR event_type = 'error' AS flagged FROM events")
def filer_flags_any(spark, sf_dir):
    """Flags anywhere in a return; the first element of a tag counts."""
    k = F.get_json_object("props", "$.k").cast("int")
    value = F.concat(F.lit("<Return><a><HospitalInd>"), F.when(k % 5 == 0, " x ").otherwise("0"), F.lit("</HospitalInd><HospitalInd>X</HospitalInd></a>"), F.when(F.col("event_type") == "error", '<SchoolInd ref="1">X</SchoolInd>').otherwise("<SchoolInd/>"), F.lit("</Return>"))
    found = returns.parsed(table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("path"), value.alias("value")))
    return found.select(F.col("path").cast("long").alias("event_id"), returns.flagged(F.col("root")).alias("flagged"))
