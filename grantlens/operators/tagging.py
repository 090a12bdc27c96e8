"""Topic tags: classify each distinct text once and join back, rules in order, integrity and distribution."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..functions.labels import canonize


def by_rules(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """All labels whose pattern fits, in the order of rules, ;-joined; other if none does."""
    hits = F.filter(F.array(*[F.when(c.rlike(p), F.lit(label)) for p, label in rules]), lambda x: x.isNotNull())
    return F.when(F.size(hits) > 0, F.array_join(F.array_distinct(hits), ";")).otherwise(fixed.OTHER)


def classify_once(rows: DataFrame, column: str, position: str, classifier: Callable[[Column], Column], blank: str = fixed.GENERAL) -> DataFrame:
    """Adds tag. Texts that are equal but for case and spacing are classified once, by their first raw form; blanks aren't classified.

    The distinct texts meet the rows again by their key; which side is sent is left to sizes.
    """
    keyed = rows.withColumn("_key", text.qnorm(F.col(column)))
    distinct = keyed.filter("_key <> ''").groupBy(F.col("_key").alias("_k")).agg(F.min_by(column, position).alias("_raw"))
    tags = distinct.select("_k", canonize(classifier(F.col("_raw"))).alias("_tag"))
    out = keyed.join(tags, F.col("_key") == F.col("_k"), "left")
    return out.withColumn("tag", F.when(F.col("_key") == "", blank).otherwise(F.coalesce("_tag", F.lit(fixed.OTHER)))).drop("_key", "_k", "_tag")


def integrity(rows: DataFrame, tag: str = "tag") -> DataFrame:
    """One row of counts: rows, blank tags, unknown labels, stand-ins mixed with others, labels out of order."""
    known = [*fixed.SPECIFIC_LABELS, fixed.GENERAL, fixed.OTHER]
    parts = F.split(F.coalesce(F.col(tag), F.lit("")), ";")
    order = F.array(*[F.lit(x) for x in fixed.SPECIFIC_LABELS])
    mixed = (F.size(parts) > 1) & (F.array_contains(parts, fixed.GENERAL) | F.array_contains(parts, fixed.OTHER))
    unknown = F.exists(parts, lambda p: ~p.isin(*known))
    unordered = ~unknown & ~mixed & (F.size(parts) > 1) & (F.array_join(F.array_intersect(order, parts), ";") != F.col(tag))
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(F.coalesce(F.col(tag), F.lit("")) == "").alias("n_blank"), F.count_if(unknown).alias("n_unknown"), F.count_if(mixed).alias("n_mixed"), F.count_if(unordered).alias("n_unordered"))


def distribution(rows: DataFrame, tag: str = "tag") -> DataFrame:
    """label, n, share of rows (shares may add up to over 1)."""
    total = rows.agg(F.count("*").alias("total"))
    parts = rows.select(F.explode(F.array_distinct(F.split(tag, ";"))).alias("label")).groupBy("label").agg(F.count("*").alias("n"))
    return parts.join(F.broadcast(total)).select("label", "n", (F.col("n") / F.col("total")).alias("share"))
