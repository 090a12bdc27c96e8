"""Queries on what outlives a run: event-time state, a dimension's history, a store of answers, a bucketed log, text tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import shared_folder
from ..operators import history, ledger, provider, reporting
from ..sources import index, sinks, tables
from ..sources.log import BucketedLog
from ..streaming import ingest, windows
from .common import registry, table

QUERIES, query = registry()


# ---- event-time state -----------------------------------------------------------------------------------------
#: Events arrive in five deliveries of a week of January each; every seventh twelve hours late, every fiftieth nine days.
ARRIVAL = "ts + CASE WHEN event_id % 50 = 0 THEN INTERVAL 9 DAY WHEN event_id % 7 = 0 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END"
DELIVERIES = 5


@query(f"""WITH a AS (SELECT *, {ARRIVAL} AS arrives FROM events), d AS (SELECT *, CASE WHEN arrives >= TIMESTAMP '2024-01-29' THEN 4 ELSE (day(arrives) - 1) // 7 END AS delivery, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS start FROM a),
m AS (SELECT delivery, max(ts) AS latest FROM d GROUP BY delivery), w AS (SELECT x.delivery, max(y.latest) - INTERVAL 1 DAY AS mark FROM (SELECT DISTINCT delivery FROM d) x LEFT JOIN m y ON y.delivery < x.delivery GROUP BY x.delivery),
kept AS (SELECT d.* FROM d JOIN w ON d.delivery = w.delivery WHERE w.mark IS NULL OR start + INTERVAL 6 HOUR > w.mark)
SELECT start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM kept WHERE start + INTERVAL 6 HOUR <= (SELECT max(ts) FROM d) - INTERVAL 1 DAY GROUP BY start, event_type""")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by six hours and kind, from events that arrive out of order and late; the stream stops and restarts after each delivery."""
    base = f"{shared_folder(spark)}/windows-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("arrives", F.expr(ARRIVAL))
    delivery = F.when(F.col("arrives") >= F.lit("2024-01-29").cast("timestamp"), DELIVERIES - 1).otherwise(F.expr("(day(arrives) - 1) DIV 7").cast("int"))
    rows = events.select("ts", "event_type", "value", delivery.alias("delivery"))
    rows.write.partitionBy("delivery").parquet(f"{base}/all")
    for n in range(DELIVERIES):
        spark.read.schema(rows.schema).parquet(f"{base}/all").filter(F.col("delivery") == n).drop("delivery").write.parquet(f"{base}/in/{n}")
        stream = ingest.stream_files(spark, f"{base}/in/*", rows.drop("delivery").schema)
        windows.run(windows.windowed(stream, "ts", "6 hours", "1 day", ["event_type"], total=F.sum("value")), f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


# ---- history --------------------------------------------------------------------------------------------------
@query("""WITH c AS (SELECT o_custkey, o_orderdate, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1),
l AS (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS before FROM c), h AS (SELECT o_custkey, o_orderpriority AS priority, o_orderdate AS valid_from, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to FROM l WHERE before IS NULL OR before <> o_orderpriority),
f AS (SELECT o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
s AS (SELECT h.priority, count(*) AS shipped FROM f LEFT JOIN h ON f.o_custkey = h.o_custkey AND l_shipdate >= valid_from AND (valid_to IS NULL OR l_shipdate < valid_to) GROUP BY h.priority),
v AS (SELECT priority, count(*) AS intervals, count(*) FILTER (valid_to IS NULL) AS open FROM h GROUP BY priority)
SELECT s.priority, shipped, coalesce(intervals, 0) AS intervals, coalesce(open, 0) AS open FROM s LEFT JOIN v ON s.priority IS NOT DISTINCT FROM v.priority""")
def dim_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's priority is that of the latest order. The history is made in two rounds, each a version of its own; lines
    count under the priority that held when they were shipped."""
    orders = table(spark, sf_dir, "orders")
    changes = orders.select("o_custkey", F.col("o_orderpriority").alias("priority"), "o_orderdate", "o_orderkey")
    middle = orders.agg(F.expr("percentile_approx(o_orderdate, 0.5)")).first()[0]
    kept = history.Versions(spark, f"{shared_folder(spark)}/history-{uuid.uuid4().hex}")
    kept.write(spark.createDataFrame([], changes.select("o_custkey", "priority", F.col("o_orderdate").alias("valid_from"), F.col("o_orderdate").alias("valid_to")).schema))
    for some in (changes.filter(F.col("o_orderdate") < F.lit(middle)), changes.filter(F.col("o_orderdate") >= F.lit(middle))):
        kept.write(history.changed(kept.read(), some, ["o_custkey"], "o_orderdate", "o_orderkey"))
    made = kept.read()
    facts = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_shipdate")
    shipped = history.as_of(facts, made, ["o_custkey"], "l_shipdate").groupBy("priority").agg(F.count("*").alias("shipped"))
    counts = made.groupBy(F.col("priority").alias("p")).agg(F.count("*").alias("intervals"), F.count_if(F.col("valid_to").isNull()).alias("open"))
    return shipped.join(counts, F.col("priority").eqNullSafe(F.col("p")), "left").select("priority", "shipped", F.coalesce("intervals", F.lit(0)).alias("intervals"), F.coalesce("open", F.lit(0)).alias("open"))


# ---- store of answers -----------------------------------------------------------------------------------------
def _verdicts(items: list[dict]) -> list[dict]:
    """Stands in for a model: a rule on the name."""
    return [{"key": x["key"], "v_type": "foreign" if x["key"].startswith("OLD") else "us", "v_name": x["name"].title()} for x in items]


@query("""WITH k AS (SELECT upper(p_name || ' ' || p_brand) AS raw FROM part), n AS (SELECT DISTINCT trim(regexp_replace(regexp_replace(raw, '[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS key FROM k)
SELECT key, CASE WHEN key LIKE 'OLD%' THEN 'foreign' ELSE 'us' END AS v_type, (SELECT count(*) FROM n) AS asked_first, 0 AS asked_again, (SELECT count(*) FROM n) AS asked_under_new_prompt FROM n""")
def verdict_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of all parts, asked about once; a second run asks nothing, another prompt asks anew."""
    folder = f"{shared_folder(spark)}/verdicts-{uuid.uuid4().hex}"
    names = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_brand").alias("name"))
    ask = lambda rows: provider.ask(rows, _verdicts, "key string, v_type string, v_name string")
    run = lambda version: ledger.answered(names, "name", ask, "v_type string, v_name string", version, folder)
    _, first = run("1")
    found, again = run("1")
    _, anew = run("2")
    return found.select("key", "v_type", F.lit(first).cast("long").alias("asked_first"), F.lit(again).cast("int").alias("asked_again"), F.lit(anew).cast("long").alias("asked_under_new_prompt"))


# ---- bucketed log ---------------------------------------------------------------------------------------------
@query("""WITH r AS (SELECT user_id || '_' || event_type AS xml_file, event_id, ts < TIMESTAMP '2024-01-16' AS early FROM events), a AS (SELECT xml_file, min(event_id) AS event_id FROM r WHERE early GROUP BY xml_file),
b AS (SELECT xml_file, min(event_id) AS event_id FROM r WHERE NOT early AND xml_file NOT IN (SELECT xml_file FROM a) GROUP BY xml_file) SELECT 'first' AS run, * FROM a UNION ALL SELECT 'second', * FROM b""")
def bucketed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a log by user and kind: each adds the first row of every key that the log lacks."""
    mark = uuid.uuid4().hex
    rows = table(spark, sf_dir, "events").select(F.concat_ws("_", F.col("user_id").cast("string"), "event_type").alias("xml_file"), "event_id", "ts")
    kept = BucketedLog(spark, f"log_{mark}", f"{shared_folder(spark)}/log-{mark}", "xml_file", 8)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    kept.append(spark.createDataFrame([], rows.drop("ts").schema))
    first = kept.merge(rows.filter(early).drop("ts"), "event_id")
    second = kept.merge(rows.filter(~early).drop("ts"), "event_id")
    return first.select(F.lit("first").alias("run"), "*").unionByName(second.select(F.lit("second").alias("run"), "*"))


# ---- text tables ----------------------------------------------------------------------------------------------
def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("""SELECT lpad(c_custkey::VARCHAR, 6, '0') AS canonical_id, CASE WHEN c_custkey % 5 = 0 THEN 'A "quoted", name' ELSE c_name END AS grantee_normalized, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'S' || c_nationkey END AS state, 'NA' AS country, c_mktsegment AS entity_class, '' AS city FROM customer""")
def text_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stamped increments of the dimension, one written twice, read back as text: zeros, quotes, sentinels and empties stay."""
    folder, c = _folder(spark, "increments"), table(spark, sf_dir, "customer")
    name = F.when(F.col("c_custkey") % 5 == 0, 'A "quoted", name').otherwise(F.col("c_name"))
    rows = c.select(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("canonical_id"), name.alias("grantee_normalized"), F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("S"), "c_nationkey")).alias("state"), F.lit("NA").alias("country"), F.col("c_mktsegment").alias("entity_class"))
    late = F.col("canonical_id") > "000100"
    for some, stamp in ((rows, "1"), (rows.filter(~late), "1"), (rows.filter(late), "2")):
        sinks.write_increment(some, tables.DIM, folder, stamp)
    parts = [tables.read_text_table(spark, f"{folder}/stamp={stamp}", tables.DIM) for stamp in ("1", "2")]
    return parts[0].unionByName(parts[1])


@query("""SELECT event_id::VARCHAR AS xml_file, '' AS timestamp, event_type AS form_type, '' AS filer_name, lpad(user_id::VARCHAR, 9, '0') AS filer_ein, CASE WHEN event_type = 'error' THEN 'True' ELSE 'False' END AS filer_support_org, '' AS return_year FROM events""")
def log_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of two runs, appended."""
    folder, e = _folder(spark, "log"), table(spark, sf_dir, "events")
    rows = e.select(F.col("event_id").cast("string").alias("xml_file"), F.col("event_type").alias("form_type"), F.lpad(F.col("user_id").cast("string"), 9, "0").alias("filer_ein"), (F.col("event_type") == "error").alias("filer_support_org"))
    for some in (rows.filter("form_type = 'error'"), rows.filter("form_type <> 'error'")):
        sinks.append_log(some, tables.LOG, folder)
    return spark.read.parquet(folder)


@query("SELECT lpad(event_id::VARCHAR, 9, '0') AS objectid, CASE WHEN event_type = 'error' THEN 'NULL' ELSE event_type END AS formtype, NULL::VARCHAR AS taxyear FROM events")
def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index with headers in mixed spellings: all text, nothing inferred, NULL is a word, an empty field is null."""
    folder, e = _folder(spark, "index"), table(spark, sf_dir, "events")
    rows = e.select(F.lpad(F.col("event_id").cast("string"), 9, "0").alias("Object ID"), F.when(F.col("event_type") == "error", "NULL").otherwise(F.col("event_type")).alias("FORM_TYPE"), F.lit("").alias("tax-year"))
    rows.write.option("header", True).option("emptyValue", "").csv(folder)
    return index.read_index(spark, folder).select("objectid", "formtype", "taxyear")


@query("""WITH a AS (SELECT c_mktsegment AS grantee, c_nationkey::VARCHAR AS grantee_state, CASE c_nationkey % 4 WHEN 0 THEN 'new_mint' WHEN 1 THEN 'review' WHEN 2 THEN 'matched' ELSE 'NA' END AS disposition, count(*) AS n_grants, round(sum(c_acctbal), 2) AS total_amount FROM customer GROUP BY 1, 2, 3)
SELECT row_number() OVER (ORDER BY list_position(['new_mint', 'review', 'matched', 'NCI', 'NA'], disposition), total_amount DESC, grantee, grantee_state) AS place, grantee, grantee_state, disposition, n_grants::VARCHAR AS n_grants FROM a""")
def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit by segment and nation, as the one sorted file that people read."""
    folder, c = _folder(spark, "audit"), table(spark, sf_dir, "customer")
    which = F.col("c_nationkey") % 4
    kind = F.when(which == 0, "new_mint").when(which == 1, "review").when(which == 2, "matched").otherwise("NA")
    rows = reporting.audit(c.select(F.col("c_mktsegment").alias("grantee"), F.col("c_nationkey").cast("string").alias("grantee_state"), kind.alias("disposition"), F.col("c_acctbal").cast("string").alias("amount")), ["grantee", "grantee_state", "disposition"], "amount")
    ordered = reporting.audit_order(rows.withColumn("pos", F.struct("grantee", "grantee_state")))
    sinks.write_report(sinks.as_text(ordered, tables.AUDIT), folder)
    found = tables.read_text_table(spark, folder).withColumn("place", F.monotonically_increasing_id() + 1)
    return found.select("place", "grantee", "grantee_state", "disposition", "n_grants")
