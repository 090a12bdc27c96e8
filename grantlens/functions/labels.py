"""Topic labels: canonical label strings from free ones, and model answers in JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

VERDICTS = "array<struct<id:int,type:string,name:string,country:string>>"


def _synonyms() -> Column:
    return F.create_map(*[F.lit(x) for p in fixed.LABEL_SYNONYMS.items() for x in p])


def label_set(raw: Column) -> Column:
    """The known labels of a raw answer, in the order of first mention; empty for null and errors."""
    low = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    bare = F.regexp_replace(low, r"^(tag|tags|label|labels)\s*[:=]\s*", "")
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(bare), r'^"+|"+$', ""), r"^'+|'+$", ""), r"^\.+|\.+$", "")
    pieces = F.transform(F.split(bare, "[;,/]| and "), lambda p: F.regexp_replace(p, "[^a-z]", ""))
    known = F.array(*[F.lit(x) for x in [*fixed.SPECIFIC_LABELS, fixed.GENERAL, fixed.OTHER]])
    named = F.transform(pieces, lambda p: F.when(F.array_contains(known, p), p).otherwise(F.try_element_at(_synonyms(), p)))
    found = F.array_distinct(F.filter(named, lambda p: p.isNotNull()))
    return F.when(low.startswith("__err__"), F.array().cast("array<string>")).otherwise(found)


def canonize(raw: Column) -> Column:
    """Specific labels in canonical order, ;-joined; else general, if named; else other."""
    found = label_set(raw)
    order = F.array(*[F.lit(x) for x in fixed.SPECIFIC_LABELS])
    specific = F.array_intersect(order, found)
    return F.when(F.size(specific) > 0, F.array_join(specific, ";")).when(F.array_contains(found, fixed.GENERAL), fixed.GENERAL).otherwise(fixed.OTHER)


def in_order(tags: Column, order: list[str]) -> Column:
    """A ;-joined list of labels, sorted by the given order; others go."""
    return F.array_join(F.array_intersect(F.array(*[F.lit(x) for x in order]), F.split(tags, ";")), ";")


def parse_json(answer: Column, schema: str = VERDICTS) -> Column:
    """The array from the first [ to the last ] of an answer, whatever stands around it; null if it is no JSON."""
    return F.from_json(F.regexp_extract(answer, r"(?s)(\[.*\])", 1), schema)
