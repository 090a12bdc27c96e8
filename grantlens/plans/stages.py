"""The pipeline's stages as plans: parse, match, tag. Each takes and returns DataFrames; __main__ reads and writes them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..functions.lineage import cut
from ..functions.numbering import first_rows
from ..operators import matching, minting, reporting, tagging, verdicts
from ..sources import index, returns, tables


@dataclass
class Parsed:
    grants: DataFrame
    log: DataFrame


def parse(
    found: DataFrame, done: DataFrame | None = None, recipients: Callable[[Column], Column] | None = text.keyword_filter, prior: DataFrame | None = None, exclusions: DataFrame | None = None, save=cut
) -> Parsed:
    """PARSED rows of new returns, and their log: every return is logged, malformed ones too. found: path, value; done:
    xml_file; prior: filer_ein, return_year already emitted; exclusions: filer_ein to leave out.

    The log's grant_bearing says whether a return has a grant that is kept.
    """
    files = wanted(returns.filings(found), prior, exclusions)
    if done is not None:
        files = index.unprocessed(files, done, "xml_file")
    files = save(files.withColumn("form_type", F.when(F.col("foundation_form"), "990PF").otherwise("990")))  # parsed once
    rows = returns.grants(files).join(files.select(F.col("xml_file").alias("_x"), "form_type"), F.col("xml_file") == F.col("_x")).drop("_x")
    kept = (lambda g: recipients(returns.grantee(g))) if recipients is not None else lambda g: F.lit(True)
    if recipients is not None:
        rows = rows.filter(recipients(F.col("grantee")))
    log = files.withColumn("grant_bearing", bearing(kept))
    log = log.select("xml_file", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "form_type", "filer_name", "filer_ein", "filer_support_org", "return_year", "status", "grant_bearing")
    return Parsed(rows.select(*tables.PARSED.names, "pos"), log)


def bearing(kept: Callable[[Column], Column]) -> Column:
    """Whether a filing has a grant group that is kept."""
    return (F.col("status") == "ok") & F.coalesce(F.exists("groups", kept), F.lit(False))


def wanted(files: DataFrame, prior: DataFrame | None = None, exclusions: DataFrame | None = None) -> DataFrame:
    """Filings without those of filers to leave out, and without those of a filer and year emitted before."""
    if exclusions is not None:
        files = index.unprocessed(files, exclusions, "filer_ein")
    if prior is not None:
        pairs = prior.select(F.trim("filer_ein").alias("_e"), F.trim("return_year").alias("_y")).distinct()
        files = files.join(pairs, (F.col("filer_ein") == F.col("_e")) & (F.col("return_year") == F.col("_y")), "left_anti")
    return files


def recorded(log: DataFrame, save=cut) -> tuple[DataFrame, dict[str, int]]:
    """The log of parse(), saved, and what was counted while it was written: recorded, kept (with a grant), deleted
    (without), failed, and supporting organisations."""
    ok, seen = F.col("status") == "ok", Observation()
    counts = {"kept": ok & F.col("grant_bearing"), "deleted": ok & ~F.col("grant_bearing"), "failed": ~ok, "supporting_org": F.col("filer_support_org")}
    saved = save(log.observe(seen, F.count(F.lit(1)).alias("recorded"), *[F.count_if(c).alias(n) for n, c in counts.items()]))
    return saved, dict(seen.get)


def log_upload(log: DataFrame) -> DataFrame:
    """The log in the upload's order and names."""
    return log.withColumn("funder_support_org", F.col("filer_support_org")).select(*tables.LOG_UPLOAD.names)


@dataclass
class Matched:
    grants: DataFrame
    new_institutions: DataFrame
    audit: DataFrame


def _key(name: str, city: str, state: str) -> list[Column]:
    return [text.qnorm(F.col(name)), F.upper(F.coalesce(city, F.lit(""))), F.upper(F.coalesce(state, F.lit("")))]


def match(grants: DataFrame, dim: DataFrame, rules: dict | None = None, answers: Callable[[DataFrame], DataFrame] | None = None, flagship: str | None = fixed.FLAGSHIPS) -> Matched:
    """grants (PARSED) with canonical ids; new dimension rows; the audit by grantee.

    dim: DIM columns. Each distinct grantee is resolved once. answers: asked about the grantees that the cascade leaves
    open (qid, name, city, state, country, zip); returns qid, v_type, v_name, v_country. Without it they are NA.
    """
    d = dim.withColumn("name", F.col("grantee_normalized")).withColumn("pos", F.monotonically_increasing_id())
    k = _key("grantee", "grantee_city", "grantee_state")
    rows = grants.withColumn("k0", k[0]).withColumn("k1", k[1]).withColumn("k2", k[2]).withColumn("place", F.monotonically_increasing_id())
    names = first_rows(rows.select("k0", "k1", "k2", "place", F.col("grantee").alias("name"), F.col("grantee_city").alias("city"), F.col("grantee_state").alias("state"), F.col("grantee_country").alias("country"), F.col("grantee_zip").alias("zip")), ["k0", "k1", "k2"], "place")
    names = cut(names.withColumn("qid", F.xxhash64("k0", "k1", "k2")))
    d = cut(d)
    found = cut(matching.cascade(names, d, rules, save=cut))
    left = names.join(found.filter("canonical_id IS NULL").select("qid"), "qid")
    outcome, fresh = verdict_outcomes(left, d, cut(answers(left)) if answers else None, flagship)
    ids = found.filter("canonical_id IS NOT NULL").select("qid", "canonical_id", "decided_by").withColumn("minted", F.lit(False)).unionByName(outcome)
    ids = cut(ids.join(names.select("qid", "k0", "k1", "k2"), "qid"))
    out = rows.join(ids.select(F.col("k0").alias("r0"), F.col("k1").alias("r1"), F.col("k2").alias("r2"), "canonical_id", "decided_by", "minted"), (F.col("k0") == F.col("r0")) & (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2")), "left")
    own = F.when(F.col("canonical_id").rlike("^SG") | F.col("canonical_id").isin("NA", "NCI"), "").otherwise(F.col("canonical_id"))
    out = out.withColumn("canonical_id", F.coalesce("canonical_id", F.lit(""))).withColumn("ipeds_unitid", F.coalesce(own, F.lit("")))
    seen = reporting.audit(out.withColumn("disposition", reporting.disposition(F.col("canonical_id"), F.col("minted"))), ["k0", "k1", "k2", "disposition", "canonical_id", "ipeds_unitid", "minted"], "grant_amount")
    info = matching.shown(d.unionByName(fresh.withColumn("name", F.col("grantee_normalized")).withColumn("pos", F.lit(0).cast("long")).select(*d.columns)))
    info = info.select(F.col("canonical_id").alias("i"), F.col("name").alias("canonical_name"), F.col("city").alias("canonical_city"), "entity_class")
    audit = seen.join(info, F.col("canonical_id") == F.col("i"), "left").join(names.select("k0", "k1", "k2", F.col("name").alias("grantee"), F.col("city").alias("grantee_city"), F.col("state").alias("grantee_state"), F.col("zip").alias("grantee_zip"), F.col("country").alias("grantee_country"), F.col("place").alias("pos")), ["k0", "k1", "k2"])
    audit = reporting.audit_order(audit.withColumn("is_new_mint", F.col("minted")))
    return Matched(out.select(*tables.MATCHED.names), fresh.select(*tables.DIM.names), audit)


def verdict_outcomes(left: DataFrame, dim: DataFrame, answers: DataFrame | None, flagship: str | None) -> tuple[DataFrame, DataFrame]:
    """(qid, canonical_id, decided_by, minted) of open names, and the new dimension rows."""
    if answers is None:
        none = left.sparkSession.createDataFrame([], tables.DIM)
        return left.select("qid", F.lit("NA").alias("canonical_id"), F.lit("no_verdict").alias("decided_by"), F.lit(False).alias("minted")), none
    said = cut(left.join(answers.select("qid", "v_type", "v_name", "v_country"), "qid", "left"))
    proposed = said.filter("v_name IS NOT NULL").select("qid", F.col("v_name").alias("name"), "city", "state")
    again = matching.cascade(proposed, dim, None, save=cut).select("qid", F.col("canonical_id").alias("cascade_id"), F.col("decided_by").alias("tier"))
    q = proposed.select("qid", text.strip_wrappers(F.col("name")).alias("q"), F.upper(F.coalesce("state", F.lit(""))).alias("q_state"))
    # as low as a rival may be and still keep another from being sure
    tops = matching.national(q, dim, minting.JOIN - minting.MARGIN, 0).select("qid", F.col("top").alias("national_top"), F.col("second").alias("national_second"))
    alike = matching.has_similar(q.withColumn("q", text.norm(F.col("q"))), dim).withColumn("similar", F.lit(True))
    known = matching.prepared(dim).groupBy(F.col("norm_name").alias("n")).agg(F.min("canonical_id").alias("known_id"))
    abroad = known_abroad(said.filter("v_name IS NOT NULL").select("qid", "v_name"), known)
    said = said.join(again, "qid", "left").join(tops, "qid", "left").join(alike, "qid", "left").join(abroad, "qid", "left")
    said = said.withColumn("similar", F.coalesce("similar", F.lit(False)))
    said = said.withColumn("signal", verdicts.foreign_signal(F.col("country"), F.col("state"), F.col("zip")))
    said = said.withColumn("flagship", text.norm(F.col("name")).rlike(flagship) if flagship else F.lit(False))
    said = said.withColumn("heavy", F.coalesce(verdicts.heavy_rename(F.col("name"), F.coalesce("v_name", F.lit(""))), F.lit(False)))
    said = said.withColumn("unshared", verdicts.no_shared_token(F.col("name"), F.col("v_name")))
    done = cut(against_mints(verdicts.dispositions(said), cut))
    foreign = F.col("v_type") == "foreign"
    mints = done.filter("outcome = 'mint'").withColumn("shown_name", F.when(foreign, F.concat(F.col("v_name"), F.lit(" (Foreign)"))).otherwise(F.col("v_name")))
    # numbered in the order in which the grants name them first
    mints = mints.withColumn("order", F.col("place")).withColumn("key", text.norm(F.col("shown_name")))
    new = verdicts.mint(mints, "shown_name", "order", matching.next_surrogate(dim))
    new = cut(new.join(first_rows(mints.select("key", "order", "shown_name", "state", "city", "v_country", "v_type"), ["key"], "order").drop("order"), "key"))
    joined = done.filter("outcome = 'matched' AND leader IS NOT NULL").select("qid", F.col("leader").alias("key"))
    mapped = mints.select("qid", "key").unionByName(joined).join(new.select("key", F.col("canonical_id").alias("minted_id")), "key").drop("key")
    out = done.select("qid", "canonical_id", "outcome").join(mapped, "qid", "left")
    out = out.select("qid", F.coalesce("minted_id", "canonical_id").alias("canonical_id"), F.concat(F.lit("verdict_"), F.col("outcome")).alias("decided_by"), F.col("minted_id").isNotNull().alias("minted"))
    home = F.col("v_type") != "foreign"
    rows = new.select(
        "canonical_id", F.col("shown_name").alias("grantee_normalized"), verdicts.territory_name(F.coalesce("state", F.lit("")), ~home).alias("state"),
        F.when(home, fixed.HOME_NAME).otherwise(F.coalesce("v_country", F.lit(""))).alias("country"), F.when(home, "non-IPEDS-US").otherwise("foreign").alias("entity_class"), F.coalesce("city", F.lit("")).alias("city"),
    )
    return out, rows


def against_mints(rows: DataFrame, save=cut) -> DataFrame:
    """dispositions() rows in the light of the run's own mints: adds leader, the key of the mint that a row joins.

    A name at home that no rule or exact look-up settles meets the mints before it as it meets the dimension. It joins one
    (unless the rename is heavy and shares no word); is reviewed if a mint is too near for it to be new, or for a national
    match to be sure; and is minted, or keeps its match, otherwise.
    """
    # the tiers before similarity are settled without the mints
    open_ = rows.filter("v_type <> 'foreign' AND outcome <> 'NA' AND coalesce(tier, '') NOT IN ('override', 'exact')")
    asked = open_.select("qid", "place", text.norm(F.col("v_name")).alias("key"), text.strip_wrappers(F.col("v_name")).alias("q"), (F.col("outcome") == "mint").alias("may_lead"), F.col("national_top").alias("best"), F.col("national_second").alias("second"))
    found = minting.settled(asked, save=save).select("qid", "leader", "verdict")
    met = rows.join(found, "qid", "left")
    unsure = F.col("verdict").isin("near", "alone")
    outcome = (
        F.when((F.col("verdict") == "joins") & F.col("heavy") & F.col("unshared"), "review")
        .when(F.col("verdict") == "joins", "matched")
        .when(unsure & ((F.col("tier") == "national") | ((F.col("outcome") == "mint") & (F.col("verdict") == "near"))), "review")
        .otherwise(F.col("outcome"))
    )
    met = met.withColumn("outcome", outcome).withColumn("leader", F.when(F.col("outcome") == "matched", F.col("leader")))
    # an id of the dimension stays only where its match does
    return met.withColumn("canonical_id", F.when(F.col("outcome") == "review", "").when(F.col("leader").isNotNull(), F.lit(None)).otherwise(F.col("canonical_id"))).drop("verdict")


def known_abroad(said: DataFrame, known: DataFrame) -> DataFrame:
    """qid, known_id of verdicts abroad whose formal name is known, as it is or without wrappers ("The"). said: qid, v_name; known: n, known_id."""
    name = F.col("v_name")
    keys = F.array(*[F.struct(F.lit(i).alias("rank"), text.norm(F.concat(c, F.lit(" (Foreign)"))).alias("key")) for i, c in enumerate((name, text.strip_wrappers(name)))])
    asked = said.select("qid", F.explode(keys).alias("k")).select("qid", "k.*")
    return asked.join(known, F.col("key") == F.col("n")).groupBy("qid").agg(F.min_by("known_id", "rank").alias("known_id"))


def with_match_columns(rows: DataFrame) -> DataFrame:
    """Adds grantee_match (the text that searches run on) and grantee_support_org."""
    out = rows.withColumn("grantee_match", F.lower(F.concat_ws(" ", "grantee", "grantee_addr1", "grantee_addr2")))
    return out.withColumn("grantee_support_org", F.lower("grantee").contains("foundation"))


def tag(matched: DataFrame, classifier: Callable[[Column], Column]) -> DataFrame:
    """GRANTS rows: each distinct purpose classified once, uid blank."""
    rows = matched.withColumn("place", F.xxhash64("xml_file", "grantee", "grant_amount"))
    out = tagging.classify_once(rows, "grant_purpose", "place", classifier)
    return with_match_columns(out.withColumn("uid", F.lit(""))).select(*tables.GRANTS.names)


#: A classifier by words, for runs without a model.
WORDS = [
    (r"(?i)scholar|tuition|financial aid", "finaid"), (r"(?i)athlet|sport", "athletics"), (r"(?i)research|laborator", "research"), (r"(?i)science|engineer|medic|health|math", "stem"),
    (r"(?i)\barts?\b|music|theat|humanit|history", "hass"), (r"(?i)\blaw\b|business|nursing", "professional"), (r"(?i)student (life|activit)", "studentlife"), (r"(?i)building|construction|facilit|capital", "capital"),
    (r"(?i)general|unrestricted|operating", fixed.GENERAL),
]


def by_words(c: Column) -> Column:
    return tagging.by_rules(c, WORDS)
