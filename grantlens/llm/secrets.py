"""Secret scans over an incremental blob ledger (native).

A blob is a text, addressed by its SHA-256, so any number of paths (documents, historical versions) share one blob.
The ledger is a stored table of which (blob, rule, rule version) were scanned and what was found. scan() looks only at
those that the ledger lacks, incremental() appends them to it, and findings() joins what the ledger has for the current
versions back to all paths. The ledger's folder is named by the session's grantlens.secrets.ledger; without that, a run
has one of its own in the shared folder.

Defined results for odd input: a null text is the empty blob; an empty text has no finding; repeated rows are paths of
their own; null ids stay; a row that two runs both appended counts once; an empty table gives an empty result; columns
beside doc_id and text are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import boxed, shared_dir, table_at, unboxed

#: Fixed rules, by name: version, pattern, least length, the group that the length counts (0: all of the match).
RULES = {
    "assign": (1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    "access": (1, r"AKIA[A-Z0-9]+", 16, 0),
    "hex": (1, r"[0-9a-f]+", 32, 0),
    "pem": (1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0),
}
#: The kinds every result counts, in their order among spans with one start.
BASE = ("assign", "access", "hex")
LEDGER = "sha string, rule string, version int, spans array<struct<start:int,end:int>>"
LEDGER_FOLDER = "grantlens.secrets.ledger"
#: Matches of a text that are placed together.
PLACED = 256


def bound(value: Column, body) -> Column:
    """body(value), with value computed once: inside another lambda an expression would be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spans_of(text: Column, rule: str) -> Column:
    """Array of (start, end) of the rule's matches, in code points; matches under the least length are dropped.

    The text between matches comes from split(), the matches from regexp_extract_all(); their lengths, summed in
    turn, give the places. Sums run over PLACED matches at a time, then over those groups, so the work grows with the
    matches and not with their square.
    """
    _, pattern, least, group = RULES[rule]
    # a run of one class of characters that is too short can't hold a long one, so the length goes into the pattern
    pattern = {"hex": "[0-9a-f]{32,}", "access": "AKIA[A-Z0-9]{12,}"}.get(rule, pattern)
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    parts = F.arrays_zip(
        F.transform(between, lambda x: F.length(x)).alias("gap"),
        F.transform(whole, lambda x: F.length(x)).alias("len"),
        F.transform(counted, lambda x: F.length(x)).alias("counted"),
    )
    none = F.array().cast("array<struct<start:int,end:int,counted:int>>")
    length = lambda x: x["gap"] + F.coalesce(x["len"], F.lit(0))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = acc["at"] + length(x)
        hit = F.array(F.struct(begin.alias("start"), end.alias("end"), x["counted"].alias("counted")))
        return F.struct(end.alias("at"), F.when(x["len"].isNull(), acc["found"]).otherwise(F.concat(acc["found"], hit)).alias("found"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins"))

    def grouped(all_parts: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(all_parts) - 1) / PLACED).cast("int")), lambda g: F.slice(all_parts, g * PLACED + 1, F.lit(PLACED)))

    def placed(groups: Column) -> Column:
        sums = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda n, x: n + length(x)))
        begins = F.aggregate(sums, first, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["begins"], F.array(acc["at"])).alias("begins")), lambda acc: acc["begins"])
        return F.zip_with(groups, begins, lambda g, at: F.aggregate(g, F.struct(at.alias("at"), none.alias("found")), step, lambda acc: acc["found"]))

    kept = F.filter(F.flatten(bound(bound(parts, grouped), placed)), lambda x: x["counted"] >= least)
    places = F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), places).otherwise(nothing)


def addressed(docs: DataFrame) -> DataFrame:
    """Paths with their blob: doc_id, sha, text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.sha2(text.cast("binary"), 256).alias("sha"), text.alias("text"))


def unseen(paths: DataFrame, ledger: DataFrame | None, rules: list[str]) -> DataFrame:
    """One row for each blob with a rule version that the ledger lacks: sha, text, todo (rule names).

    Which path brings the blob's text is settled on ids and addresses alone; the texts then meet that choice by id,
    so thousands of copies don't meet in one task.
    """
    bringer = paths.groupBy("sha").agg(F.min(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("bringer"))
    todo = F.array(*[F.lit(r) for r in rules])
    if ledger is not None:
        wanted = " OR ".join(f"(rule = '{r}' AND version = {RULES[r][0]})" for r in rules)
        seen = ledger.filter(wanted).groupBy("sha").agg(F.collect_set("rule").alias("seen"))
        bringer = bringer.join(seen, "sha", "left")
        todo = F.array_except(todo, F.coalesce(F.col("seen"), F.array().cast("array<string>")))
    bringer = bringer.select(F.col("bringer").alias("b_id"), F.col("sha").alias("b_sha"), todo.alias("todo")).filter(F.size("todo") > 0)
    texts = paths.withColumn("p_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return texts.join(bringer, (F.col("p_id") == F.col("b_id")) & (F.col("sha") == F.col("b_sha"))).select("sha", "text", "todo")


def scan(paths: DataFrame, ledger: DataFrame | None = None, rules: list[str] | None = None) -> DataFrame:
    """New ledger rows. Every scanned pair gets a row, also when nothing was found, so that it isn't scanned again."""
    rules = rules or list(RULES)
    todo = unseen(paths, ledger, rules)
    each = F.array(*[F.when(F.array_contains("todo", r), F.struct(F.lit(r).alias("rule"), F.lit(RULES[r][0]).alias("version"), spans_of(F.col("text"), r).alias("spans"))) for r in rules])
    rows = todo.select("sha", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("x")).select("sha", "x.rule", "x.version", "x.spans")
    # a row repeated with its id brings its blob twice
    return rows.groupBy("sha", "rule", "version").agg(F.first("spans").alias("spans"))


def stored(spark: SparkSession, folder: str) -> DataFrame | None:
    """The ledger in a folder, or None where there is none yet."""
    return table_at(spark, folder, LEDGER)


def incremental(paths: DataFrame, folder: str | None = None, rules: list[str] | None = None) -> DataFrame:
    """The ledger in folder after what it lacks of these paths was scanned and appended: all of it, earlier runs' rows too."""
    spark = paths.sparkSession
    folder = folder or spark.conf.get(LEDGER_FOLDER, None) or f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    scan(paths, stored(spark, folder), rules).write.mode("append").parquet(folder)
    return stored(spark, folder)


def findings(paths: DataFrame, ledger: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """Every path with its findings by the rules' current versions: doc_id, sha, found (array of start, order, end, kind, sorted)."""
    rules = rules or list(RULES)
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r), F.lit(i))])
    current = F.create_map(*[x for r in rules for x in (F.lit(r), F.lit(RULES[r][0]))])
    hits = ledger.filter(F.col("rule").isin(rules) & (F.col("version") == current[F.col("rule")]) & (F.size("spans") > 0))
    hits = hits.select("sha", F.transform("spans", lambda x: F.struct(x["start"].alias("start"), rank[F.col("rule")].alias("rank"), x["end"].alias("end"), F.col("rule").alias("kind"))).alias("part"))
    hits = hits.groupBy("sha").agg(F.array_sort(F.flatten(F.collect_set("part"))).alias("found"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return paths.join(hits, "sha", "left").withColumn("found", F.coalesce("found", none))


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    base = F.filter("found", lambda x: x["kind"].isin(*BASE))
    counts = [F.size(F.filter("found", _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def redacted(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with every finding replaced by [SECRET]; overlapping findings merge. found: sha and found, one row a blob."""
    blobs = found.filter(F.size("found") > 0).select(F.col("sha").alias("blob"), "found").dropDuplicates(["blob"])
    rows = boxed(docs).withColumn("text", F.coalesce(F.col("box_text"), F.lit("")))
    rows = rows.withColumn("own", F.sha2(F.col("text").cast("binary"), 256)).join(blobs, F.col("own") == F.col("blob"), "left")
    dirty = rows.filter("found IS NOT NULL").withColumn("clean", without(F.col("text"), F.col("found")))
    return unboxed(rows.filter("found IS NULL"), docs).unionByName(unboxed(dirty, docs, text=F.col("clean")))


def without(text: Column, found: Column) -> Column:
    """text with its findings (not none, sorted by start) replaced. PLACED findings at a time work on their own stretch of
    the text, so time grows with the findings and the text, not with their product."""
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / PLACED).cast("int")), lambda g: F.slice(found, g * PLACED + 1, F.lit(PLACED)))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins"))

    def stretch(group: Column, begin: Column) -> Column:
        end = F.greatest(begin, F.array_max(F.transform(group, lambda x: x["end"])))

        def step(part: Column):
            def more(acc: Column, x: Column) -> Column:
                out = F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.substring(part, acc["at"] - begin + 1, x["start"] - acc["at"]), F.lit("[SECRET]"))).otherwise(acc["out"])
                return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), out.alias("out"))

            return F.aggregate(group, F.struct(begin.alias("at"), F.lit("").alias("out")), more, lambda acc: acc["out"])

        return bound(F.substring(text, begin + 1, end - begin), step)

    def joined_up(of: Column) -> Column:
        # how far the findings of the groups before reach: where a group's stretch begins
        reach = F.transform(of, lambda g: F.array_max(F.transform(g, lambda x: x["end"])))
        begins = F.aggregate(reach, first, lambda acc, e: F.struct(F.greatest(acc["at"], e).alias("at"), F.concat(acc["begins"], F.array(acc["at"])).alias("begins")), lambda acc: acc["begins"])
        return F.array_join(F.zip_with(of, begins, stretch), "")

    rest = F.substring(text, F.array_max(F.transform(found, lambda x: x["end"])) + 1, F.length(text))
    return F.concat(bound(groups, joined_up), rest)
