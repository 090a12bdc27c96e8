"""What becomes of names that the cascade leaves open: model verdicts, review, surrogate ids, reconciliation, ordered rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..functions.numbering import numbered
from ..functions.similarity import scores
from .alike import candidates
from .matching import shares_token


def foreign_signal(country: Column, state: Column, code: Column, home: Sequence[str] = tuple(fixed.HOME_COUNTRIES), states: Sequence[str] = fixed.STATES) -> Column:
    """Whether an address points abroad: a country that isn't home, a state of two letters or more that isn't one, or a postal code of another shape."""
    country, state, code = (F.coalesce(c, F.lit("")) for c in (country, state, code))
    return ~country.isin(*home) | ((F.length(state) >= 2) & ~F.upper(state).isin(*states)) | ((code != "") & ~code.rlike(fixed.ZIP_PATTERN))


def territory_name(state: Column, foreign: Column, states: Sequence[str] = fixed.STATES) -> Column:
    """The formal name of a territory; other codes of states stay as they are; empty abroad and for what is no state's code."""
    names = F.create_map(*[F.lit(x) for p in fixed.TERRITORIES.items() for x in p])
    code = F.upper(F.coalesce(state, F.lit("")))
    return F.when(foreign | ~code.isin(*states), "").otherwise(F.coalesce(F.try_element_at(names, code), state))


def heavy_rename(raw: Column, proposed: Column, floor: float = 55, subunits: str = fixed.SUBUNITS) -> Column:
    """Whether a proposed name has little left of the raw one, and the raw one names no part of an institution."""
    return (scores("ratio")(text.norm(text.strip_wrappers(raw)), text.norm(proposed)) < floor) & ~text.norm(raw).rlike(subunits)


def no_shared_token(raw: Column, proposed: Column) -> Column:
    """Whether a raw name of two words or more shares none with the proposed one."""
    mine = text.tokens(text.strip_wrappers(raw))
    return (F.size(mine) >= 2) & ~F.arrays_overlap(mine, text.tokens(text.norm(proposed)))


def dispositions(rows: DataFrame) -> DataFrame:
    """Adds outcome and canonical_id. rows: v_type, v_name, signal, flagship, known_id (an entity minted or known under the
    name), cascade_id, heavy, unshared, national_top, similar.

    outcome: NA, review, matched or mint. A verdict that is missing, not applicable or blank is NA; abroad needs a
    signal and no flagship; at home a match is doubted if the rename is heavy and shares no word, and a mint if
    something like it exists.
    """
    blank = F.col("v_type").isNull() | (F.col("v_type") == "not_applicable") | (F.trim(F.coalesce("v_name", F.lit(""))) == "")
    abroad = F.col("v_type") == "foreign"
    known, cascade = F.col("known_id").isNotNull(), F.col("cascade_id").isNotNull()
    outcome = (
        F.when(blank, "NA")
        .when(abroad & (~F.col("signal") | F.col("flagship")), "review")
        .when(abroad & known, "matched")
        .when(abroad, "mint")
        .when(cascade & F.col("heavy") & F.col("unshared"), "review")
        .when(cascade, "matched")
        .when((F.coalesce("national_top", F.lit(0.0)) >= 88) | F.col("similar") | F.col("heavy"), "review")
        .otherwise("mint")
    )
    rows = rows.withColumn("outcome", outcome)
    ident = F.when(F.col("outcome") == "NA", "NA").when(F.col("outcome") == "review", "").when((F.col("outcome") == "matched") & abroad, F.col("known_id")).when(F.col("outcome") == "matched", F.col("cascade_id"))
    return rows.withColumn("canonical_id", ident)


def mint(rows: DataFrame, name: str, position: str, top: DataFrame, prefix: str = "SG", digits: int = 5) -> DataFrame:
    """key, first_pos, canonical_id: a surrogate for each distinct normalised name, in the order of first positions, from top + 1 on.

    top: one row with the largest number in use. Names that normalise alike share one id whatever their order.
    """
    groups = rows.groupBy(text.norm(F.col(name)).alias("key")).agg(F.min(position).alias("first_pos"))
    groups = numbered(groups, "first_pos", "nth").join(top)
    return groups.select("key", "first_pos", F.concat(F.lit(prefix), F.lpad((F.col("nth") + F.col("top")).cast("string"), digits, "0")).alias("canonical_id"))


def reconcile(rule: Column, gram: Column, gram_score: Column, strong: float, rule_weak: Column) -> Column:
    """Of two guesses: auto if they agree; curated if one holds the other; gram if it is strong and the rule weak; else review."""
    agree = rule == gram
    related = rule.contains(gram) | gram.contains(rule)
    return F.when(agree, "auto").when(related, "curated").when((gram_score >= strong) & rule_weak, "gram").otherwise("review")


def waterfall(c: Column, rules: Sequence[tuple[str, str, str, float, str]]) -> Column:
    """A struct category, name, confidence, rule of the first rule whose pattern fits; rules: (pattern, category, name or '' for c, confidence, rule)."""
    made = lambda cat, name, conf, rule: F.struct(F.lit(cat).alias("category"), (F.lit(name) if name else c).alias("name"), F.lit(float(conf)).alias("confidence"), F.lit(rule).alias("rule"))
    out = made("review", "", 0.0, "none")
    for pattern, category, name, confidence, rule in reversed(rules):
        out = F.when(c.rlike(pattern), made(category, name, confidence, rule)).otherwise(out)
    return out


def snapped(names: DataFrame, anchors: DataFrame, floor: float = 90) -> DataFrame:
    """q, anchor, score: the nearest anchor of each name by ratio, the least of equals, if it is near enough.

    A name that shares no word with an anchor has none; a distinct pair is scored once.
    """
    pairs = candidates(names, anchors.select(F.col("anchor").alias("n")), "ratio", floor).filter(shares_token(F.col("q"), F.col("n"), ()))
    near = pairs.withColumn("score", scores("ratio")("q", "n")).filter(F.col("score") >= floor)
    best = near.groupBy("q").agg(F.min(F.struct((-F.col("score")).alias("away"), F.col("n").alias("anchor"))).alias("best"))
    return best.select("q", "best.anchor", (-F.col("best.away")).alias("score"))


def pattern_queue(rows: DataFrame, pattern: Column, amount: str) -> DataFrame:
    """pattern, n, total: the review queue by recurring pattern, the largest first."""
    return rows.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n"), F.sum(amount).alias("total")).orderBy(F.desc("n"), F.desc("total"), "pattern")
