"""Queries on topic tags and model answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, labels, text
from ..operators import tagging
from .common import registry, table

QUERIES, query = registry()

RULES = [("license|work", "finaid"), (" the ", "stem"), (" la ", "hass"), (" und ", "research"), ("[0-9]{6}", "capital")]


def first_match(rules, c: str) -> str:
    parts = ", ".join(f"CASE WHEN regexp_matches({c}, '{p}') THEN '{label}' END" for p, label in rules)
    return f"list_filter([{parts}], lambda x: x IS NOT NULL)"


SPECIFIC = ", ".join(f"'{x}'" for x in fixed.SPECIFIC_LABELS)


def sql_order(found: str) -> str:
    return f"CASE WHEN len(list_intersect([{SPECIFIC}], {found})) > 0 THEN array_to_string(list_filter([{SPECIFIC}], lambda x: list_contains({found}, x)), ';') WHEN list_contains({found}, 'general') THEN 'general' ELSE 'other' END"


@query(f"WITH k AS (SELECT *, lower(trim(regexp_replace(text, '[\\s\\p{{Z}}]+', ' ', 'g'))) AS k FROM documents), r AS (SELECT k, arg_min(text, doc_id) AS raw FROM k WHERE k <> '' GROUP BY k), t AS (SELECT k, {first_match(RULES, 'raw')} AS f FROM r) SELECT k.doc_id, CASE WHEN k.k = '' THEN 'general' ELSE {sql_order('t.f')} END AS tag FROM k LEFT JOIN t ON k.k = t.k")
def unique_space_join_back(spark, sf_dir):
    """Each distinct text is classified once; every row gets its tag."""
    return tagging.classify_once(table(spark, sf_dir, "documents"), "text", "doc_id", lambda c: tagging.by_rules(c, RULES)).select("doc_id", "tag")


def raw_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as model answers in all their shapes: event_id, raw."""
    shapes = ["stem", "Tag: Science, sports", "tags = capital and research", "\"law.\"", "general", "Operating; arts", "finaid; finaid/STEM", "nonsense", "__err__ timeout", "label: other", "Student life,hass", "unrestricted and none"]
    k = F.col("event_id") % (len(shapes) + 1)
    raw = F.element_at(F.array(*[F.lit(x) for x in shapes]), (F.when(k == len(shapes), 0).otherwise(k) + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", F.when(k < len(shapes), raw).alias("raw"))


#: What each shape must become; the last is the null answer's.
CANON = ["stem", "stem;athletics", "research;capital", "professional", "general", "hass", "stem;finaid", "other", "other", "other", "hass;studentlife", "general", "other"]
CANON_SQL = "SELECT event_id, [" + ", ".join(f"'{x}'" for x in CANON) + "][event_id % 13 + 1] AS tag FROM events"


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_answers(spark, sf_dir).select("event_id", labels.canonize(F.col("raw")).alias("tag"))


@query(CANON_SQL)
def canonize_tags(spark, sf_dir):
    return canonical(spark, sf_dir)


@query(f"SELECT count(*) AS n_rows, 0 AS n_blank, 0 AS n_unknown, count(*) FILTER (event_id % 50 = 0) AS n_mixed, count(*) FILTER (event_id % 50 = 1) AS n_unordered FROM ({CANON_SQL})")
def tag_integrity(spark, sf_dir):
    """Canonical tags with some spoiled ones put in."""
    tag = F.when(F.col("event_id") % 50 == 0, "general;stem").when(F.col("event_id") % 50 == 1, "hass;stem").otherwise(F.col("tag"))
    return tagging.integrity(canonical(spark, sf_dir).withColumn("tag", tag))


@query(f"WITH t AS ({CANON_SQL}) SELECT label, count(*) AS n, round(count(*) / (SELECT count(*) FROM t), 9) AS share FROM (SELECT unnest(string_split(tag, ';')) AS label FROM t) GROUP BY label")
def tag_distribution(spark, sf_dir):
    return tagging.distribution(canonical(spark, sf_dir)).withColumn("share", F.round("share", 9))


@query("""WITH e AS (SELECT event_id, event_type, json_extract_string(props, '$.k')::INT AS k FROM events) SELECT event_id, CASE WHEN event_id % 4 < 3 THEN k END AS id, CASE WHEN event_id % 4 < 3 THEN event_type END AS type, CASE WHEN event_id % 4 < 3 THEN 'N ' || k END AS name FROM e""")
def llm_json_parse(spark, sf_dir):
    """Fenced, chatty, bare and broken JSON answers."""
    k = F.get_json_object("props", "$.k")
    body = F.concat(F.lit('[{"id": '), k, F.lit(', "type": "'), F.col("event_type"), F.lit('", "name": "N '), k, F.lit('"}]'))
    key = F.col("event_id") % 4
    raw = F.when(key == 0, body).when(key == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(key == 2, F.concat(F.lit("Here it is: "), body, F.lit(" done."))).otherwise("sorry, no [answer")
    rows = table(spark, sf_dir, "events").select("event_id", labels.parse_json(raw).alias("v"))
    return rows.select("event_id", F.get("v", F.lit(0)).alias("x")).select("event_id", "x.id", "x.type", "x.name")


@query("SELECT doc_id, CASE WHEN toxic = 1 AND quality = 1 THEN 'hass;athletics' WHEN toxic = 1 THEN 'athletics' WHEN quality = 1 THEN 'stem;capital' ELSE 'general' END AS tag FROM labels")
def label_order(spark, sf_dir):
    """Lists put in canonical order; blanks become general."""
    raw = F.when((F.col("toxic") == 1) & (F.col("quality") == 1), "athletics;hass").when(F.col("toxic") == 1, "athletics").when(F.col("quality") == 1, "capital;stem").otherwise(" ")
    tag = F.when(text.qnorm(raw) == "", fixed.GENERAL).otherwise(labels.in_order(raw, fixed.SPECIFIC_LABELS))
    return table(spark, sf_dir, "labels").select("doc_id", tag.alias("tag"))
