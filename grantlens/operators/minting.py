"""Minting in order: a new name joins an earlier mint of the same run that it equals or resembles, or else leads.

Names are settled as if one after the other, in the order of their places, but in parallel rounds. A name that nothing
earlier resembles leads. In each round, names that resemble a leader are out, names that are out no longer matter to
others, and a name whose earlier neighbours are all out leads. A round is a few joins over the links that are still
open; there are as many rounds as the longest chain of names that wait for each other. What is out is then judged against
the leaders before it, as against any entry of the dimension: it joins the best one if that is good enough and ahead of
all others, and goes to review if not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.lineage import cut
from ..functions.numbering import top_rows
from ..functions.similarity import scores
from .alike import candidates
from .matching import shares_token

#: Floors of a name that joins and of one that is too near to be new; how far the best must be ahead.
JOIN, NEAR, MARGIN = 93, 88, 10


def out_of_order(links: DataFrame, save=cut, rounds: int = 10_000) -> DataFrame:
    """node: those that don't lead. links: later, earlier (distinct pairs of nodes, acyclic in the order of places).

    A node leads if none of its earlier neighbours leads: the greedy choice in order. save cuts lineage between rounds.
    """
    open_links, out = save(links.select("later", "earlier").distinct()), None
    for _ in range(rounds):
        if open_links.isEmpty():
            break
        heads = open_links.join(open_links.select(F.col("later").alias("earlier")).distinct(), "earlier", "left_anti").select("earlier").distinct()
        lost = save(open_links.join(heads, "earlier", "left_semi").select(F.col("later").alias("node")).distinct())
        out = lost if out is None else out.unionByName(lost)
        left = open_links.join(lost, F.col("later") == F.col("node"), "left_anti")
        open_links = save(left.join(lost, F.col("earlier") == F.col("node"), "left_anti"))
    else:
        raise RuntimeError(f"names didn't settle in {rounds} rounds")
    return links.select(F.col("later").alias("node")).limit(0) if out is None else out


def eligible(q: Column, least: int = 10) -> Column:
    """Whether a name may resemble another one anywhere: long enough, and of two words or more."""
    return (F.length(q) >= least) & q.contains(" ")


def resembling(names: DataFrame, keys: DataFrame, floor: float, common: Sequence[str] = fixed.COMMON_TOKENS, least: int = 10) -> DataFrame:
    """q, n, score of the pairs that reach the floor: names: q; keys: n. An equal pair, whatever its length, scores 101."""
    equal = names.select("q").distinct().join(keys.select("n").distinct(), F.col("q") == F.col("n")).withColumn("score", F.lit(101.0))
    fit = names.filter(eligible(F.col("q"), least))
    pairs = candidates(fit, keys, "token_set", floor).filter((F.col("q") != F.col("n")) & shares_token(F.col("q"), F.col("n"), common))
    alike = pairs.withColumn("score", scores("token_set")("q", "n")).filter(F.col("score") >= floor)
    return equal.unionByName(alike.select("q", "n", "score"))


def settled(rows: DataFrame, join: float = JOIN, near: float = NEAR, margin: float = MARGIN, common: Sequence[str] = fixed.COMMON_TOKENS, least: int = 10, save=cut) -> DataFrame:
    """qid, leader, top, verdict (leads, joins, stays, near or alone) of names in the order of their places.

    rows: qid, place (distinct), key (what the name is registered as), q (what it is looked up as), may_lead, best, second
    (its scores against the dimension; null counts as 0). Rows with may_lead that
    nothing before them resembles lead. Others are judged by the scores of the dimension and of the leaders before them:
    one that equals a leader by key or q joins it; else the best wins if it reaches `join` and is `margin` ahead of every
    other, and the row joins that leader, or stays with the dimension's; else it is near if the best reaches `near`; else
    it is alone. leader: the key of the leader that it leads as or joins.
    """
    rows = save(rows.select("qid", "place", "key", "q", "may_lead", F.coalesce("best", F.lit(0.0)).alias("best"), F.coalesce("second", F.lit(0.0)).alias("second")))
    # only a key's first row can lead: what keeps it from leading keeps its later rows, too
    first = save(rows.filter("may_lead").groupBy("key").agg(F.min("place").alias("led"), F.min_by("q", "place").alias("q")))
    keys = first.select(F.col("key").alias("n"), "led")
    met = save(resembling(rows, keys, join - margin, common, least))
    by_q = met.join(keys, "n")
    # a first row waits for an earlier one that it equals or is near to
    waits = first.select(F.col("key").alias("later"), "q", F.col("led").alias("place")).join(by_q.filter(F.col("score") >= near), "q").filter(F.col("led") < F.col("place"))
    beaten = out_of_order(waits.select("later", F.col("n").alias("earlier")), save)
    leaders = save(keys.join(beaten, F.col("n") == F.col("node"), "left_anti"))
    # every row against the leaders before it: equal by key, equal by q, or by score
    by_key = rows.join(leaders.select(F.col("n").alias("key"), "led"), "key").filter(F.col("led") <= F.col("place"))
    same = by_key.select("qid", F.col("key").alias("n"), F.lit(102.0).alias("score"))
    like = rows.select("qid", "q", "key", "place").join(met, "q").join(leaders, "n").filter((F.col("led") < F.col("place")) & (F.col("n") != F.col("key")))
    two = top_rows(same.unionByName(like.select("qid", "n", "score")), ["qid"], [F.desc("score"), F.desc("n")], 2)
    two = two.groupBy("qid").agg(F.max(F.struct("score", "n")).alias("one"), F.min("score").alias("other"), F.count("*").alias("many"))
    first_places = leaders.select(F.col("led").alias("place"), F.lit(True).alias("leads"))
    judged = rows.join(two, "qid", "left").join(first_places, "place", "left").withColumn("leads", F.coalesce("leads", F.lit(False)) & F.col("may_lead"))
    mine, exact = F.coalesce("one.score", F.lit(0.0)), F.coalesce(F.col("one.score") > 100, F.lit(False))
    rival = F.when(F.col("many") == 2, F.col("other")).otherwise(0.0)
    ahead = mine > F.col("best")
    top = F.greatest(mine, F.col("best"))
    second = F.when(ahead, F.greatest(rival, F.col("best"))).otherwise(F.greatest(mine, F.col("second")))
    sure = (top >= join) & (top - second >= margin)
    verdict = F.when(F.col("leads"), "leads").when(exact | (sure & ahead), "joins").when(sure, "stays").when(top >= near, "near").otherwise("alone")
    out = judged.select("qid", F.col("one.n").alias("leader"), F.least(top, F.lit(100.0)).alias("top"), verdict.alias("verdict"))
    return out.withColumn("leader", F.when(F.col("verdict").isin("leads", "joins"), F.col("leader")))
