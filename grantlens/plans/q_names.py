"""Queries on names: normalising, similarity, matching, verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, similarity, text
from ..functions.lineage import cut, merged
from ..operators import anchors, grams, matching, minting, reporting, verdicts
from . import stages
from .common import registry, sql_lcs, sql_norm, sql_strip, table

QUERIES, query = registry()

# ---- what the queries are shown on ----------------------------------------------------------------------------
NOISE = ["THE", "OF", "TO", r"AND(?:\s+OF)?", "DE LA"]


def strip_sql(c: str) -> str:
    return sql_strip(c, fixed.ABBREVIATIONS, fixed.NOISE)


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as institutions: the first word is the system, some parts are its seat or an office."""
    suffix = F.when(F.col("p_type") == "PROMO", "-MAIN CAMPUS").when((F.col("p_type") == "ECONOMY") & (F.col("p_size") > 40), " System Office").otherwise("")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("canonical_id"),
        F.concat(F.regexp_replace("p_name", " ", "-"), suffix).alias("name"),
        F.col("p_brand").alias("state"),
        F.concat(F.lit("C"), F.col("p_size").cast("string")).alias("city"),
        F.when(F.col("p_type") == "SMALL", "foreign").otherwise("IPEDS-US").alias("entity_class"),
        F.col("p_partkey").alias("pos"),
    )


DIM = """dim AS (SELECT 'P' || p_partkey AS canonical_id, replace(p_name, ' ', '-') || CASE WHEN p_type = 'PROMO' THEN '-MAIN CAMPUS' WHEN p_type = 'ECONOMY' AND p_size > 40 THEN ' System Office' ELSE '' END AS name,
  upper(p_brand) AS up_state, 'C' || p_size AS norm_city, CASE WHEN p_type = 'SMALL' THEN 'foreign' ELSE 'IPEDS-US' END AS entity_class, p_partkey AS pos FROM part),
d AS (SELECT *, trim(replace(upper(name), '-', ' ')) AS norm_name, upper(split_part(name, '-', 1)) AS prefix, upper(name) LIKE '%SYSTEM OFFICE%' AS office, upper(name) LIKE '%MAIN CAMPUS%' AS seat FROM dim)"""


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy names: every part's name with wrappers, a bare system name or a typo, by key."""
    key = F.col("p_partkey") % 5
    name = (
        F.when(key == 0, F.concat(F.lit("The "), F.col("p_name"), F.lit(" Foundation, Inc.")))
        .when(key == 1, F.substring_index("p_name", " ", 1))
        .when(key == 2, F.concat(F.col("p_name"), F.lit(" Main Campus")))
        .when(key == 3, F.regexp_replace("p_name", "i", "y"))
        .otherwise(F.col("p_name"))
    )
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("qid"), name.alias("name"), F.concat(F.lit("C"), F.col("p_size").cast("string")).alias("city"), F.col("p_brand").alias("state"))


ASKED = """asked AS (SELECT p_partkey AS qid, CASE p_partkey % 5 WHEN 0 THEN 'The ' || p_name || ' Foundation, Inc.' WHEN 1 THEN split_part(p_name, ' ', 1) WHEN 2 THEN p_name || ' Main Campus'
  WHEN 3 THEN replace(p_name, 'i', 'y') ELSE p_name END AS name, 'C' || p_size AS q_city, upper(p_brand) AS q_state FROM part)"""

PICK = """, real AS (SELECT *, bool_or(NOT office) OVER (PARTITION BY {k}) AS any_real FROM cand),
pool AS (SELECT *, q_state <> '' AND up_state = q_state AS here FROM real WHERE NOT (office AND any_real)),
agg AS (SELECT {k}, count(*) AS n, min(canonical_id) AS c, count(*) FILTER (here) AS ns, min(canonical_id) FILTER (here) AS cs,
  count(*) FILTER (here AND norm_city = q_city) AS nc, min(canonical_id) FILTER (here AND norm_city = q_city) AS cc,
  count(*) FILTER (here AND seat) AS nhs, min(canonical_id) FILTER (here AND seat) AS chs, count(*) FILTER (seat) AS nse, min(canonical_id) FILTER (seat) AS cse FROM pool GROUP BY {k}),
picked AS (SELECT {k}, CASE WHEN n = 1 THEN c WHEN nc = 1 THEN cc WHEN ns = 1 THEN cs WHEN ns > 0 THEN (CASE WHEN nhs = 1 THEN chs END) WHEN nse = 1 THEN cse END AS canonical_id FROM agg)"""


@query("SELECT doc_id, " + sql_norm("text") + " AS norm FROM documents")
def norm_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.norm(F.col("text")).alias("norm"))


@query("SELECT doc_id, " + sql_strip("text", fixed.ABBREVIATIONS, NOISE) + " AS stripped FROM documents")
def strip_wrappers_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_wrappers(F.col("text"), noise=NOISE).alias("stripped"))


@query("SELECT DISTINCT lower(trim(regexp_replace(text, '[\\s\\p{Z}]+', ' ', 'g'))) AS key FROM documents")
def qnorm_distinct(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(text.qnorm(F.col("text")).alias("key")).distinct()


@query("SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') AS header FROM customer")
def header_norm(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.header_norm(F.col("c_name")).alias("header"))


@query("SELECT p_partkey, NOT (lower(p_name) LIKE '%red ring%' OR lower(p_name) LIKE '%old%') AND (lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE '%gear%' OR lower(p_name) LIKE '%blue rod%') AS kept FROM part")
def keyword_filter_3tier(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.keyword_filter(F.col("p_name"), ["red ring", "old"], ["ring", "gear"], ["blue rod"]).alias("kept"))


@query("""WITH q AS (SELECT c_custkey AS qid, c_mktsegment AS g, c_nationkey AS n FROM customer)
SELECT qid, coalesce(CASE WHEN g = 'BUILDING' AND n = 3 THEN 'S1' WHEN g = 'MACHINERY' AND n = 4 THEN 'S2' END, CASE WHEN g = 'BUILDING' AND n % 7 = 5 THEN 'T1' END, CASE g WHEN 'BUILDING' THEN 'N1' WHEN 'FURNITURE' THEN 'N2' END,
  CASE WHEN g LIKE '%HOLD%' AND g NOT LIKE '%XX%' THEN 'C1' END) AS canonical_id FROM q WHERE g <> 'AUTOMOBILE' AND NOT (g = 'MACHINERY' AND n <> 4)""")
def override_coalesce(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("qid"), F.col("c_mktsegment").alias("name"), F.col("c_nationkey").cast("string").alias("state"), (F.col("c_nationkey") % 7).cast("string").alias("city"))
    by_state = spark.createDataFrame([("The Building, Inc.", "3", "S1"), ("machinery", "4", "S2")], "key string, state string, id string")
    by_city = spark.createDataFrame([("Building", "5", "T1")], "key string, city string, id string")
    by_name = spark.createDataFrame([("building", "N1"), ("Furniture Foundation", "N2")], "key string, id string")
    return matching.overrides(names, by_state, by_city, by_name, [("HOLD", ["XX"], "C1"), ("HOUSE", [], "C2")])


COLLEGES = ({"SEAT ONE": ["BUILDING COLLEGE", "MACHINERY COLLEGE"], "SEAT TWO": ["AUTOMOBILE COLLEGE"]}, ["FURNITURE COLLEGE"], {"SEAT ONE": "F1", "SEAT TWO": "F2"})


@query("""WITH q AS (SELECT c_custkey AS qid, c_mktsegment AS g, c_custkey % 3 AS k FROM customer)
SELECT qid, CASE WHEN g = 'BUILDING' AND k = 0 THEN 'N1' WHEN g IN ('BUILDING', 'MACHINERY') AND k = 0 THEN 'F1' WHEN g = 'AUTOMOBILE' AND k = 0 THEN 'F2' WHEN g = 'FURNITURE' AND k = 1 THEN 'F1' WHEN g = 'FURNITURE' AND k = 2 THEN 'F2' ELSE 'C1' END AS canonical_id FROM q""")
def federation_members(spark, sf_dir):
    """Colleges of federations: after rules by name, before rules by parts of names; shared names count with their seat only."""
    seat = F.when(F.col("c_custkey") % 3 == 1, " Seat One").when(F.col("c_custkey") % 3 == 2, " Seat Two").otherwise("")
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("qid"), F.concat(F.lit("The "), F.initcap("c_mktsegment"), F.lit(" College"), seat).alias("name"), F.lit("").alias("state"), F.lit("").alias("city"))
    none = spark.createDataFrame([], "key string, state string, city string, id string")
    by_name = spark.createDataFrame([("Building College", "N1")], "key string, id string")
    return matching.overrides(names, none.drop("city"), none.drop("state"), by_name, [("COLLEGE", [], "C1")], spark.createDataFrame(matching.federation(*COLLEGES), "key string, id string"))


@query("SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' AND p_name NOT LIKE '%red%' AND p_name NOT LIKE '%old%' THEN 'A' WHEN p_name LIKE '%ed w%' THEN 'B' WHEN p_name LIKE '%red%' THEN 'C' END AS rule FROM part")
def contains_rules(spark, sf_dir):
    """A table of rules, read by an automaton; each distinct name once."""
    rules = spark.createDataFrame([(1, "ring", ["red", "old"], "A"), (2, "ed w", [], "B"), (3, "red", [], "C")], "rule_no int, must string, excludes array<string>, id string")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    found = anchors.first_rule(part.select("p_name").distinct(), "p_name", "p_name", rules)
    return part.join(found, "p_name", "left").select("p_partkey", F.col("id").alias("rule"))


@query("WITH " + DIM + ", " + ASKED + ", q AS (SELECT *, " + sql_norm("name") + " AS q0, " + strip_sql("name") + " AS q1 FROM asked)"
       ", probe AS (SELECT qid, 1 AS tier, q0 AS q, q_state, q_city FROM q UNION ALL SELECT qid, 2, q0, q_state, q_city FROM q UNION ALL SELECT qid, 3, q0, q_state, q_city FROM q UNION ALL SELECT qid, 4, q1, q_state, q_city FROM q UNION ALL SELECT qid, 5, q1, q_state, q_city FROM q UNION ALL SELECT qid, 6, q1, q_state, q_city FROM q)"
       ", cand AS (SELECT p.qid, p.tier, p.q_state, p.q_city, d.* FROM probe p JOIN d ON p.q <> '' AND ((p.tier IN (1, 4) AND p.q = d.norm_name AND p.q_state = d.up_state) OR (p.tier IN (2, 5) AND p.q = d.norm_name) OR (p.tier IN (3, 6) AND d.name LIKE '%-%' AND p.q = d.prefix)))"
       + PICK.format(k="qid, tier") + " SELECT qid, arg_min(canonical_id, tier) AS canonical_id, min(tier)::INT AS tier FROM picked WHERE canonical_id IS NOT NULL GROUP BY qid")
def exact_name_state(spark, sf_dir):
    return matching.exact(asked(spark, sf_dir), dimension(spark, sf_dir))


@query("WITH " + DIM + ", cand AS (SELECT a.c_custkey AS qid, 'BRAND#' || (a.c_nationkey + 1) AS q_state, 'C' || (a.c_custkey % 50 + 1) AS q_city, d.* FROM customer a JOIN d ON d.prefix = CASE a.c_mktsegment WHEN 'BUILDING' THEN 'RED' WHEN 'MACHINERY' THEN 'COLD' WHEN 'FURNITURE' THEN 'OLD' ELSE 'NONE' END)"
       + PICK.format(k="qid") + " SELECT qid, canonical_id FROM picked WHERE canonical_id IS NOT NULL")
def prefix_match(spark, sf_dir):
    """Customers that name a system only: one of its members by city, state or seat."""
    system = F.when(F.col("c_mktsegment") == "BUILDING", "red").when(F.col("c_mktsegment") == "MACHINERY", "Cold").when(F.col("c_mktsegment") == "FURNITURE", "old ").otherwise("none")
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("qid"), system.alias("name"), F.concat(F.lit("C"), (F.col("c_custkey") % 50 + 1).cast("string")).alias("city"), F.concat(F.lit("Brand#"), (F.col("c_nationkey") + 1).cast("string")).alias("state"))
    return matching.exact(names, dimension(spark, sf_dir)).select("qid", "canonical_id")


@query("WITH " + DIM + ", cand AS (SELECT q.p_name AS k, q.p_brand AS b, upper(q.p_brand) AS q_state, 'C' || q.p_size AS q_city, q.p_partkey AS qid, d.* FROM part q JOIN part o ON q.p_name = o.p_name JOIN d ON d.pos = o.p_partkey)"
       + PICK.format(k="qid") + " SELECT qid, canonical_id FROM picked WHERE canonical_id IS NOT NULL")
def pick_cascade(spark, sf_dir):
    """For each part, one among all parts of its name."""
    part = table(spark, sf_dir, "part")
    info = matching.prepared(dimension(spark, sf_dir)).join(part.select(F.col("p_partkey").alias("pos"), F.col("p_name").alias("shared")), "pos").drop("pos")
    q = part.select(F.col("p_partkey").alias("qid"), F.col("p_name").alias("shared"), F.upper("p_brand").alias("q_state"), F.concat(F.lit("C"), F.col("p_size").cast("string")).alias("q_city"))
    return matching.pick(q, info, ["shared"]).select("qid", "canonical_id")


# ---- similarity -----------------------------------------------------------------------------------------------
def name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs a < b of distinct part names that share a word; names are few at any size."""
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    words = names.select(F.col("p_name").alias("a"), F.explode(F.split("p_name", " ")).alias("w"))
    other = words.select(F.col("a").alias("b"), "w")
    return words.join(other, "w").filter("a < b").select("a", "b").distinct()


PAIRS = "names AS (SELECT DISTINCT p_name AS n FROM part), pairs AS (SELECT x.n AS a, y.n AS b FROM names x JOIN names y ON x.n < y.n WHERE len(list_intersect(string_split(x.n, ' '), string_split(y.n, ' '))) > 0)"
sql_ratio = lambda a, b: f"(CASE WHEN length({a}) + length({b}) = 0 THEN 100.0 ELSE 200.0 * {sql_lcs(a, b)} / (length({a}) + length({b})) END)"
sql_sorted = lambda c: f"array_to_string(list_sort(string_split({c}, ' ')), ' ')"
SETS = "sets AS (SELECT *, list_sort(list_intersect(string_split(a, ' '), string_split(b, ' '))) AS i, list_sort(list_filter(string_split(a, ' '), lambda t: NOT list_contains(string_split(b, ' '), t))) AS x, list_sort(list_filter(string_split(b, ' '), lambda t: NOT list_contains(string_split(a, ' '), t))) AS y FROM {src}), joined AS (SELECT *, array_to_string(i, ' ') AS c, array_to_string(list_concat(i, x), ' ') AS l, array_to_string(list_concat(i, y), ' ') AS r FROM sets)"
SET_SCORE = f"CASE WHEN len(i) > 0 AND (len(x) = 0 OR len(y) = 0) THEN 100.0 WHEN len(i) > 0 THEN greatest({sql_ratio('l', 'r')}, {sql_ratio('c', 'l')}, {sql_ratio('c', 'r')}) ELSE {sql_ratio('l', 'r')} END"


@query(f"WITH {PAIRS} SELECT a, b, round({sql_ratio('a', 'b')}, 6) AS score FROM pairs")
def indel_ratio(spark, sf_dir):
    """The expression form."""
    return name_pairs(spark, sf_dir).select("a", "b", F.round(similarity.ratio(F.col("a"), F.col("b")), 6).alias("score"))


@query(f"WITH {PAIRS}, s AS (SELECT a, b, {sql_sorted('a')} AS sa, {sql_sorted('b')} AS sb FROM pairs) SELECT a, b, round({sql_ratio('sa', 'sb')}, 6) AS score FROM s")
def token_sort_ratio(spark, sf_dir):
    """The vectorised form."""
    return name_pairs(spark, sf_dir).select("a", "b", F.round(similarity.scores("token_sort")("a", "b"), 6).alias("score"))


@query(f"WITH {PAIRS}, {SETS.format(src='pairs')} SELECT a, b, round({SET_SCORE}, 6) AS score FROM joined")
def token_set_ratio(spark, sf_dir):
    return name_pairs(spark, sf_dir).select("a", "b", F.round(similarity.scores("token_set")("a", "b"), 6).alias("score"))


# ---- fuzzy matches --------------------------------------------------------------------------------------------
def typo_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part's name with a letter changed, by key: qid, q, q_state."""
    key = F.col("p_partkey") % 3
    name = F.when(key == 0, F.regexp_replace("p_name", "l", "ll")).when(key == 1, F.regexp_replace("p_name", "d", "t")).otherwise(F.concat(F.col("p_name"), F.lit(" works")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("qid"), F.upper(name).alias("q"), F.upper("p_brand").alias("q_state"))


TYPOS = "typos AS (SELECT p_partkey AS qid, upper(CASE p_partkey % 3 WHEN 0 THEN replace(p_name, 'l', 'll') WHEN 1 THEN replace(p_name, 'd', 't') ELSE p_name || ' works' END) AS q, upper(p_brand) AS q_state FROM part)"


def plain_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part names as institutions: a name is one entity, in the brand that has it first."""
    part = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("pos"), F.min_by("p_brand", "p_partkey").alias("state"))
    return part.select(F.upper(F.regexp_replace("p_name", " ", "_")).alias("canonical_id"), F.col("p_name").alias("name"), "state", F.lit("").alias("city"), F.lit("IPEDS-US").alias("entity_class"), "pos")


PLAIN = "plain AS (SELECT upper(replace(p_name, ' ', '_')) AS canonical_id, upper(p_name) AS n, upper(arg_min(p_brand, p_partkey)) AS up_state FROM part GROUP BY p_name)"
MARGINS = """, best AS (SELECT {k}, canonical_id, max(score) AS score FROM scored WHERE score >= {floor} GROUP BY ALL), ranked AS (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY score DESC, canonical_id DESC) AS nth FROM best),
marg AS (SELECT {k}, max(canonical_id) FILTER (nth = 1) AS canonical_id, max(score) AS top, coalesce(max(score) FILTER (nth = 2), 0) AS second FROM ranked WHERE nth <= 2 GROUP BY {k})"""


@query(f"WITH {TYPOS}, {PLAIN}, pairs AS (SELECT DISTINCT t.q AS a, p.n AS b, p.canonical_id FROM typos t JOIN plain p ON len(list_intersect(string_split(t.q, ' '), string_split(p.n, ' '))) > 0 WHERE length(t.q) >= 6 AND t.q LIKE '% %'), {SETS.format(src='pairs')}, scored AS (SELECT a, canonical_id, {SET_SCORE} AS score FROM joined)"
       + MARGINS.format(k="a", floor=80) + " SELECT t.qid, m.canonical_id, round(m.top, 6) AS top, round(m.second, 6) AS second, m.top >= 80 AND m.top - m.second >= 5 AS accepted FROM typos t JOIN marg m ON t.q = m.a")
def blocked_best_match(spark, sf_dir):
    found = matching.national(typo_names(spark, sf_dir).select("qid", "q"), plain_dimension(spark, sf_dir), 80, 5, least=6, common=[])
    return found.select("qid", "canonical_id", F.round("top", 6).alias("top"), F.round("second", 6).alias("second"), "accepted")


@query(f"WITH {TYPOS}, {PLAIN}, pairs AS (SELECT DISTINCT t.qid, t.q AS a, p.n AS b FROM typos t JOIN plain p ON t.q_state = p.up_state), {SETS.format(src='pairs')} SELECT DISTINCT qid FROM joined WHERE {SET_SCORE} >= 85")
def has_similar(spark, sf_dir):
    return matching.has_similar(typo_names(spark, sf_dir), plain_dimension(spark, sf_dir), 85)


@query(f"WITH {TYPOS}, {PLAIN}, scored AS (SELECT t.q, t.q_state, p.canonical_id, {sql_ratio(sql_sorted('t.q'), sql_sorted('p.n'))} AS score FROM (SELECT DISTINCT q, q_state FROM typos WHERE length(q) >= 6) t JOIN plain p ON t.q_state = p.up_state)"
       + MARGINS.format(k="q, q_state", floor=80) + " SELECT t.qid, m.canonical_id, round(m.top, 6) AS top, m.top >= 80 AND m.top - m.second >= 6 AS accepted FROM typos t JOIN marg m ON t.q = m.q AND t.q_state = m.q_state")
def state_scoped_fuzzy(spark, sf_dir):
    found = matching.in_state(typo_names(spark, sf_dir), plain_dimension(spark, sf_dir), "token_sort", 80, 6)
    return found.select("qid", "canonical_id", F.round("top", 6).alias("top"), "accepted")


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy part names through the whole cascade, to the entities of plain_dimension."""
    return matching.cascade(asked(spark, sf_dir), cut(plain_dimension(spark, sf_dir)), save=cut)


CASCADE = (
    f"WITH {ASKED}, {PLAIN}, q AS (SELECT qid, q_state, {sql_norm('name')} AS q0, {strip_sql('name')} AS q1 FROM asked), exact AS (SELECT q.qid, arg_min(p.canonical_id, CASE WHEN p.n = q0 THEN 0 ELSE 1 END) AS canonical_id FROM q JOIN plain p ON p.n = q0 OR (p.n = q1 AND q1 <> '') GROUP BY q.qid),"
    f" nat AS (SELECT DISTINCT q1 AS a FROM q WHERE qid NOT IN (SELECT qid FROM exact) AND length(q1) >= 10 AND q1 LIKE '% %'), pairs AS (SELECT nat.a, p.n AS b, p.canonical_id FROM nat JOIN plain p ON len(list_filter(list_intersect(string_split(nat.a, ' '), string_split(p.n, ' ')), lambda t: t <> 'NEW')) > 0), {SETS.format(src='pairs')}, scored AS (SELECT a, canonical_id, {SET_SCORE} AS score FROM joined)"
    + MARGINS.format(k="a", floor=93)
    + f", national AS (SELECT q.qid, m.canonical_id FROM q JOIN marg m ON q.q1 = m.a WHERE q.qid NOT IN (SELECT qid FROM exact) AND m.top - m.second >= 10),"
    f" rest AS (SELECT DISTINCT q1 AS q, q_state FROM q WHERE qid NOT IN (SELECT qid FROM exact UNION ALL SELECT qid FROM national) AND length(q1) >= 6),"
    f" st AS (SELECT r.q, r.q_state, p.canonical_id, {sql_ratio(sql_sorted('r.q'), sql_sorted('p.n'))} AS score FROM rest r JOIN plain p ON r.q_state = p.up_state),"
    f" st1 AS (SELECT q, q_state, arg_max(canonical_id, score) AS canonical_id, max(score) AS top, coalesce(list_sort(list(score), 'DESC')[2], 0) AS second FROM st WHERE score >= 92 GROUP BY q, q_state),"
    f" sorted AS (SELECT q.qid, s.canonical_id FROM q JOIN st1 s ON q.q1 = s.q AND q.q_state = s.q_state WHERE s.top - s.second >= 6 AND q.qid NOT IN (SELECT qid FROM exact UNION ALL SELECT qid FROM national)),"
    f" rest2 AS (SELECT DISTINCT q1 AS a, q_state FROM q WHERE qid NOT IN (SELECT qid FROM exact UNION ALL SELECT qid FROM national UNION ALL SELECT qid FROM sorted) AND length(q1) >= 6),"
    f" pairs2 AS (SELECT r.a, r.q_state, p.n AS b, p.canonical_id FROM rest2 r JOIN plain p ON r.q_state = p.up_state), {SETS.format(src='pairs2').replace('sets AS', 'sets2 AS').replace('FROM sets)', 'FROM sets2)').replace('joined AS', 'joined2 AS')},"
    f" st2 AS (SELECT a, q_state, arg_max(canonical_id, score) AS canonical_id, max(score) AS top, coalesce(list_sort(list(score), 'DESC')[2], 0) AS second FROM (SELECT a, q_state, canonical_id, {SET_SCORE} AS score FROM joined2) WHERE score >= 95 GROUP BY a, q_state),"
    f" setted AS (SELECT q.qid, s.canonical_id FROM q JOIN st2 s ON q.q1 = s.a AND q.q_state = s.q_state WHERE s.top - s.second >= 8 AND q.qid NOT IN (SELECT qid FROM exact UNION ALL SELECT qid FROM national UNION ALL SELECT qid FROM sorted)),"
    f" found AS (SELECT *, 'exact' AS decided_by FROM exact UNION ALL SELECT *, 'national' FROM national UNION ALL SELECT *, 'state_token_sort' FROM sorted UNION ALL SELECT *, 'state_token_set' FROM setted),"
    f" resolved AS (SELECT a.qid, f.canonical_id, coalesce(f.decided_by, 'unresolved') AS decided_by FROM asked a LEFT JOIN found f ON a.qid = f.qid)"
)


@query(CASCADE + " SELECT * FROM resolved")
def cascade_resolve(spark, sf_dir):
    return resolved(spark, sf_dir)


@query(CASCADE + " SELECT r.decided_by, count(*) AS n, round(avg(CASE WHEN r.canonical_id = upper(replace(p.p_name, ' ', '_')) THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM resolved r JOIN part p ON r.qid = p.p_partkey GROUP BY r.decided_by")
def accuracy_by_source(spark, sf_dir):
    rows = resolved(spark, sf_dir).join(merged(table(spark, sf_dir, "part")), F.col("qid") == F.col("p_partkey"))
    correct = F.coalesce(F.col("canonical_id") == F.upper(F.regexp_replace("p_name", " ", "_")), F.lit(False))
    return reporting.accuracy(rows, "decided_by", correct).withColumn("accuracy", F.round("accuracy", 9))


@query("""WITH w AS (SELECT doc_id, lower(text) AS t FROM documents), a AS (SELECT * FROM (VALUES ('the'), ('the with'), ('of the'), ('and'), ('de la'), ('en'), ('die')) v(anchor)),
hit AS (SELECT doc_id, anchor FROM w, a WHERE contains(' ' || t || ' ', ' ' || anchor || ' ')) SELECT doc_id, arg_min(anchor, (-length(anchor), anchor)) AS anchor FROM hit GROUP BY doc_id""")
def longest_anchor_substring(spark, sf_dir):
    names = spark.createDataFrame([(a,) for a in ("the", "the with", "of the", "and", "de la", "en", "die")], "anchor string")
    return anchors.longest_anchor(table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("t")), "doc_id", "t", names)


GRAMS = """e AS (SELECT DISTINCT p_name AS n FROM part), q AS (SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN replace(p_name, 'i', 'y') ELSE p_name || ' co' END AS n FROM part),
ge AS (SELECT n, unnest(list_concat(list_concat(list_transform(range(1, length(n) + 1), lambda i: substr(' ' || n || ' ', i, 3)), list_transform(range(1, length(n)), lambda i: substr(' ' || n || ' ', i, 4))), list_transform(range(1, length(n) - 1), lambda i: substr(' ' || n || ' ', i, 5)))) AS g FROM e),
gq AS (SELECT n, unnest(list_concat(list_concat(list_transform(range(1, length(n) + 1), lambda i: substr(' ' || n || ' ', i, 3)), list_transform(range(1, length(n)), lambda i: substr(' ' || n || ' ', i, 4))), list_transform(range(1, length(n) - 1), lambda i: substr(' ' || n || ' ', i, 5)))) AS g FROM q),
idf AS (SELECT g, ln((1.0 + (SELECT count(*) FROM e)) / (1.0 + count(DISTINCT n))) + 1 AS idf FROM ge GROUP BY g),
we AS (SELECT n, g, count(*) * any_value(idf) AS w FROM ge JOIN idf USING (g) GROUP BY n, g), wq AS (SELECT n, g, count(*) * any_value(idf) AS w FROM gq JOIN idf USING (g) GROUP BY n, g),
ne AS (SELECT n, sqrt(sum(w * w)) AS l FROM we GROUP BY n), nq AS (SELECT n, sqrt(sum(w * w)) AS l FROM wq GROUP BY n),
dot AS (SELECT wq.n AS q, we.n, round(sum(wq.w / nq.l * we.w / ne.l), 9) AS cosine FROM wq JOIN nq ON wq.n = nq.n JOIN we ON wq.g = we.g JOIN ne ON we.n = ne.n GROUP BY wq.n, we.n),
near AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY cosine DESC, n) AS nth FROM dot)"""


def gram_neighbours(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    part = table(spark, sf_dir, "part")
    q = part.select(F.when(F.col("p_partkey") % 2 == 0, F.regexp_replace("p_name", "i", "y")).otherwise(F.concat(F.col("p_name"), F.lit(" co"))).alias("n"))
    return grams.nearest(q, part.select(F.col("p_name").alias("n")), k)


@query(f"WITH {GRAMS} SELECT q, n, round(cosine, 6) AS cosine FROM near WHERE nth <= 3")
def ngram_topk(spark, sf_dir):
    return gram_neighbours(spark, sf_dir, 3).withColumn("cosine", F.round("cosine", 6))


@query(f"WITH {GRAMS}, g AS (SELECT q, n AS gram, cosine FROM near WHERE nth = 1), r AS (SELECT *, replace(q, ' co', '') AS rule FROM g) SELECT q, CASE WHEN rule = gram THEN 'auto' WHEN contains(rule, gram) OR contains(gram, rule) THEN 'curated' WHEN cosine >= 0.5 AND length(rule) < 10 THEN 'gram' ELSE 'review' END AS decision FROM r")
def reconcile_guesses(spark, sf_dir):
    rows = gram_neighbours(spark, sf_dir, 1).withColumn("rule", F.regexp_replace("q", " co", ""))
    return rows.select("q", verdicts.reconcile(F.col("rule"), F.col("n"), F.col("cosine"), 0.5, F.length("rule") < 10).alias("decision"))


@query(f"WITH {TYPOS}, anchors AS (SELECT DISTINCT upper(p_name) AS n FROM part), pairs AS (SELECT DISTINCT t.q, a.n FROM typos t JOIN anchors a ON len(list_intersect(string_split(t.q, ' '), string_split(a.n, ' '))) > 0), scored AS (SELECT q, n, {sql_ratio('q', 'n')} AS score FROM pairs) SELECT q, arg_min(n, (-score, n)) AS anchor, round(max(score), 6) AS score FROM scored WHERE score >= 85 GROUP BY q")
def snap_to_anchor(spark, sf_dir):
    """Typos snapped to the names that they come from."""
    names = table(spark, sf_dir, "part").select(F.upper("p_name").alias("anchor")).distinct()
    return verdicts.snapped(typo_names(spark, sf_dir).select("q").distinct(), names, 85).withColumn("score", F.round("score", 6))


@query("""WITH q AS (SELECT DISTINCT c_mktsegment AS s, c_custkey % 4 AS k FROM customer) SELECT s || k AS qid, CASE WHEN k IN (0, 1) AND s IN ('BUILDING', 'MACHINERY') THEN s END AS known_id FROM q WHERE k IN (0, 1) AND s IN ('BUILDING', 'MACHINERY')""")
def known_abroad(spark, sf_dir):
    """Names from verdicts found under their formal name, as they are or without "The"; others not."""
    key = F.col("k")
    said = table(spark, sf_dir, "customer").select("c_mktsegment", (F.col("c_custkey") % 4).alias("k")).distinct()
    name = F.when(key == 0, F.initcap("c_mktsegment")).when(key == 1, F.concat(F.lit("The "), F.initcap("c_mktsegment"))).otherwise(F.concat(F.initcap("c_mktsegment"), F.lit(" Works")))
    said = said.select(F.concat("c_mktsegment", key.cast("string")).alias("qid"), name.alias("v_name"))
    known = spark.createDataFrame([(f"{s} FOREIGN", s) for s in ("BUILDING", "MACHINERY")], "n string, known_id string")
    return stages.known_abroad(said, known)


WATERFALL = [("^(red|blue)", "US", "", 0.95, "colour"), ("rod$", "NA", "NA", 0.9, "na_trigger"), ("^old", "foreign", "", 0.8, "foreign_word"), ("gizmo", "NCI", "NCI", 1.0, "hard_nci")]


@query("""SELECT p_partkey, CASE WHEN regexp_matches(p_name, '^(red|blue)') THEN 'US' WHEN regexp_matches(p_name, 'rod$') THEN 'NA' WHEN regexp_matches(p_name, '^old') THEN 'foreign' WHEN contains(p_name, 'gizmo') THEN 'NCI' ELSE 'review' END AS category,
CASE WHEN regexp_matches(p_name, '^(red|blue)') THEN p_name WHEN regexp_matches(p_name, 'rod$') THEN 'NA' WHEN regexp_matches(p_name, '^old') THEN p_name WHEN contains(p_name, 'gizmo') THEN 'NCI' ELSE p_name END AS name,
CASE WHEN regexp_matches(p_name, '^(red|blue)') THEN 0.95 WHEN regexp_matches(p_name, 'rod$') THEN 0.9 WHEN regexp_matches(p_name, '^old') THEN 0.8 WHEN contains(p_name, 'gizmo') THEN 1.0 ELSE 0.0 END::DOUBLE AS confidence,
CASE WHEN regexp_matches(p_name, '^(red|blue)') THEN 'colour' WHEN regexp_matches(p_name, 'rod$') THEN 'na_trigger' WHEN regexp_matches(p_name, '^old') THEN 'foreign_word' WHEN contains(p_name, 'gizmo') THEN 'hard_nci' ELSE 'none' END AS rule FROM part""")
def waterfall_resolve(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", verdicts.waterfall(F.col("p_name"), WATERFALL).alias("w")).select("p_partkey", "w.*")


@query(f"""WITH names AS (SELECT DISTINCT 'The ' || p_name AS raw, CASE WHEN p_name LIKE '%ring' THEN 'Steel ' || split_part(p_name, ' ', 1) WHEN p_name LIKE '%rod' THEN 'Iron Works' ELSE p_name END AS proposed FROM part),
n AS (SELECT *, {strip_sql('raw')} AS a, {sql_norm('proposed')} AS b FROM names) SELECT raw, proposed, {sql_ratio('a', 'b')} < 55 AS heavy, len(string_split(a, ' ')) >= 2 AND len(list_intersect(string_split(a, ' '), string_split(b, ' '))) = 0 AS unshared FROM n""")
def rename_guard(spark, sf_dir):
    name = F.col("p_name")
    proposed = F.when(name.endswith("ring"), F.concat(F.lit("Steel "), F.substring_index(name, " ", 1))).when(name.endswith("rod"), "Iron Works").otherwise(name)
    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("The "), name).alias("raw"), proposed.alias("proposed")).distinct()
    return rows.select("raw", "proposed", verdicts.heavy_rename(F.col("raw"), F.col("proposed")).alias("heavy"), verdicts.no_shared_token(F.col("raw"), F.col("proposed")).alias("unshared"))


@query("""WITH c AS (SELECT c_custkey, CASE WHEN n_regionkey = 1 THEN 'US' WHEN c_nationkey % 3 = 0 THEN 'United States' WHEN c_custkey % 11 = 0 THEN 'Puerto Rico' WHEN c_custkey % 11 = 1 THEN 'Guam' ELSE n_name END AS country, CASE c_custkey % 4 WHEN 0 THEN 'TX' WHEN 1 THEN 'PR' WHEN 2 THEN 'ON' ELSE '' END AS state,
  CASE WHEN c_custkey % 5 = 0 THEN 'K1A 0B1' WHEN c_custkey % 5 = 1 THEN '' ELSE lpad((c_custkey % 100000)::VARCHAR, 5, '0') END AS zip FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, country NOT IN ('', 'US', 'USA', 'United States', 'Puerto Rico', 'Guam') OR state = 'ON' OR (zip <> '' AND NOT regexp_matches(zip, '^[0-9]{5}(-[0-9]{4})?$')) AS intended, country NOT IN ('', 'United States') OR state = 'ON' OR (zip <> '' AND NOT regexp_matches(zip, '^[0-9]{5}(-[0-9]{4})?$')) AS literal,
  CASE WHEN country NOT IN ('', 'US', 'USA', 'United States', 'Puerto Rico', 'Guam') THEN '' WHEN state = 'PR' THEN 'Puerto Rico' WHEN state = 'TX' THEN state ELSE '' END AS territory FROM c""")
def foreign_signal(spark, sf_dir):
    """The intended rule, and the literal one, by which `US` isn't home."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey")
    country = F.when(F.col("n_regionkey") == 1, "US").when(F.col("c_nationkey") % 3 == 0, "United States").when(key % 11 == 0, "Puerto Rico").when(key % 11 == 1, "Guam").otherwise(F.col("n_name"))
    state = F.when(key % 4 == 0, "TX").when(key % 4 == 1, "PR").when(key % 4 == 2, "ON").otherwise("")
    code = F.when(key % 5 == 0, "K1A 0B1").when(key % 5 == 1, "").otherwise(F.lpad((key % 100000).cast("string"), 5, "0"))
    c = c.select("c_custkey", country.alias("country"), state.alias("state"), code.alias("zip"))
    home = tuple(fixed.HOME_COUNTRIES)
    signal = lambda h: verdicts.foreign_signal(F.col("country"), F.col("state"), F.col("zip"), h)
    return c.select("c_custkey", signal(home).alias("intended"), signal(("", "United States")).alias("literal"), verdicts.territory_name(F.col("state"), ~F.col("country").isin(*home)).alias("territory"))


@query("""WITH r AS (SELECT l.doc_id, CASE WHEN l.quality = 0 THEN NULL WHEN l.toxic = 1 THEN 'not_applicable' WHEN d.lang <> 'en' THEN 'foreign' ELSE 'us' END AS v_type, l.doc_id % 3 = 0 AS signal, l.doc_id % 7 = 0 AS flagship, l.doc_id % 5 = 0 AS known, l.doc_id % 4 = 0 AS casc, l.doc_id % 6 = 0 AS heavy, l.doc_id % 8 = 0 AS unshared, l.doc_id % 100 AS top, l.doc_id % 9 = 0 AS alike
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id), o AS (SELECT *, CASE WHEN v_type IS NULL OR v_type = 'not_applicable' THEN 'NA' WHEN v_type = 'foreign' AND (NOT signal OR flagship) THEN 'review' WHEN v_type = 'foreign' AND known THEN 'matched' WHEN v_type = 'foreign' THEN 'mint'
  WHEN casc AND heavy AND unshared THEN 'review' WHEN casc THEN 'matched' WHEN top >= 88 OR alike OR heavy THEN 'review' ELSE 'mint' END AS outcome FROM r)
SELECT doc_id, outcome, CASE outcome WHEN 'NA' THEN 'NA' WHEN 'review' THEN '' WHEN 'matched' THEN (CASE WHEN v_type = 'foreign' THEN 'K' ELSE 'C' END) || doc_id END AS canonical_id FROM o""")
def verdict_disposition(spark, sf_dir):
    """Verdicts made up from labels and languages."""
    l = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")  # noqa: E741
    key = F.col("doc_id")
    kind = F.when(F.col("quality") == 0, F.lit(None)).when(F.col("toxic") == 1, "not_applicable").when(F.col("lang") != "en", "foreign").otherwise("us")
    rows = l.select(
        "doc_id", kind.alias("v_type"), F.lit("x").alias("v_name"), (key % 3 == 0).alias("signal"), (key % 7 == 0).alias("flagship"),
        F.when(key % 5 == 0, F.concat(F.lit("K"), key.cast("string"))).alias("known_id"), F.when(key % 4 == 0, F.concat(F.lit("C"), key.cast("string"))).alias("cascade_id"),
        (key % 6 == 0).alias("heavy"), (key % 8 == 0).alias("unshared"), (key % 100).cast("double").alias("national_top"), (key % 9 == 0).alias("similar"),
    )
    return verdicts.dispositions(rows).select("doc_id", "outcome", "canonical_id")


@query("WITH g AS (SELECT " + sql_norm("text") + " AS key, min(doc_id) AS first_pos FROM documents GROUP BY 1) SELECT md5(key) AS key_md5, first_pos, 'SG' || lpad((41 + row_number() OVER (ORDER BY first_pos))::VARCHAR, 6, '0') AS canonical_id FROM g")
def mint_surrogates(spark, sf_dir):
    """Texts as names that nothing matches: a surrogate for each, after SG00041."""
    dim = spark.createDataFrame([("SG00041",), ("P7",), ("SG00003",)], "canonical_id string")
    out = verdicts.mint(table(spark, sf_dir, "documents"), "text", "doc_id", matching.next_surrogate(dim), digits=6)
    return out.select(F.md5("key").alias("key_md5"), "first_pos", "canonical_id")


MINTED = "CASE p_partkey % 4 WHEN 0 THEN replace(p_name, 'l', 'll') WHEN 1 THEN replace(p_name, 'd', 'dd') ELSE p_name END || ' national works'"


@query(f"""WITH RECURSIVE rows AS MATERIALIZED (SELECT p_partkey AS qid, upper({MINTED}) AS q, CASE WHEN p_size > 45 THEN 90.0 ELSE 0 END AS best FROM part),
firsts AS MATERIALIZED (SELECT q, min(qid) AS led, row_number() OVER (ORDER BY min(qid)) AS i FROM rows WHERE best = 0 GROUP BY q),
pairs AS (SELECT DISTINCT r.q AS a, f.q AS b FROM rows r JOIN firsts f ON r.q <> f.q AND len(list_intersect(string_split(r.q, ' '), string_split(f.q, ' '))) > 0), {SETS.format(src='pairs')},
scored AS MATERIALIZED (SELECT a, b, {SET_SCORE} AS score FROM joined),
waits AS MATERIALIZED (SELECT f.i, list(e.i) AS earlier FROM scored s JOIN firsts f ON f.q = s.a JOIN firsts e ON e.q = s.b WHERE e.i < f.i AND score >= 88 GROUP BY f.i),
fold AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS leaders UNION ALL
  SELECT fold.i + 1, CASE WHEN list_has_any(leaders, coalesce(w.earlier, [])) THEN leaders ELSE list_append(leaders, fold.i + 1) END FROM fold LEFT JOIN waits w ON w.i = fold.i + 1 WHERE fold.i < (SELECT count(*) FROM firsts)),
led AS MATERIALIZED (SELECT f.* FROM firsts f, (SELECT leaders FROM fold ORDER BY i DESC LIMIT 1) WHERE list_contains(leaders, f.i)),
found AS (SELECT r.qid, s.b, s.score FROM rows r JOIN scored s ON s.a = r.q JOIN led l ON l.q = s.b AND l.led < r.qid WHERE s.score >= 87 UNION ALL SELECT r.qid, r.q, 102 FROM rows r JOIN led l ON r.q = l.q AND l.led <= r.qid),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, b DESC) AS nth FROM found),
two AS (SELECT qid, max(b) FILTER (nth = 1) AS b, max(score) AS mine, coalesce(max(score) FILTER (nth = 2), 0) AS rival FROM ranked WHERE nth <= 2 GROUP BY qid),
j AS (SELECT r.qid, r.best, t.b, coalesce(t.mine, 0) AS mine, coalesce(t.rival, 0) AS rival, l.led IS NOT NULL AS leads FROM rows r LEFT JOIN two t ON r.qid = t.qid LEFT JOIN led l ON r.qid = l.led),
v AS (SELECT *, greatest(mine, best) AS top, CASE WHEN mine > best THEN greatest(rival, best) ELSE mine END AS other FROM j),
d AS (SELECT *, CASE WHEN leads THEN 'leads' WHEN mine > 100 OR (top >= 93 AND top - other >= 6 AND mine > best) THEN 'joins' WHEN top >= 93 AND top - other >= 6 THEN 'stays' WHEN top >= 88 THEN 'near' ELSE 'alone' END AS verdict FROM v)
SELECT qid, CASE WHEN verdict IN ('leads', 'joins') THEN b END AS leader, round(least(top, 100), 6) AS top, verdict FROM d""")  # fmt: skip
def mint_in_order(spark, sf_dir):
    """Every part as a new name of one run, in the order of keys; those of large parts resemble one that is known already."""
    name = F.upper(F.expr(MINTED))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("qid"), F.col("p_partkey").alias("place"), name.alias("key"), name.alias("q"), (F.col("p_size") <= 45).alias("may_lead"), F.when(F.col("p_size") > 45, 90.0).alias("best"), F.lit(None).cast("double").alias("second"))
    return minting.settled(rows, margin=6, common=(), least=0).withColumn("top", F.round("top", 6))


@query("""WITH d AS (SELECT 'N' || c_nationkey AS canonical_id, arg_min(c_name, c_custkey) AS canonical_name, arg_min(c_mktsegment, c_custkey) AS entity_class FROM customer GROUP BY c_nationkey)
SELECT s_suppkey, canonical_name, entity_class FROM supplier LEFT JOIN d ON canonical_id = 'N' || (s_nationkey + CASE WHEN s_suppkey % 4 = 0 THEN 100 ELSE 0 END)""")
def id_info(spark, sf_dir):
    """What an id is shown as: its first row's name and class; an id that the dimension lacks has none."""
    dim = table(spark, sf_dir, "customer").select(F.concat(F.lit("N"), "c_nationkey").alias("canonical_id"), F.col("c_name").alias("canonical_name"), F.col("c_mktsegment").alias("entity_class"), F.col("c_custkey").alias("pos"))
    ident = F.concat(F.lit("N"), (F.col("s_nationkey") + F.when(F.col("s_suppkey") % 4 == 0, 100).otherwise(0)).cast("string"))
    asked = table(spark, sf_dir, "supplier").select("s_suppkey", ident.alias("id"))
    return asked.join(matching.shown(dim), F.col("id") == F.col("canonical_id"), "left").select("s_suppkey", "canonical_name", "entity_class")
