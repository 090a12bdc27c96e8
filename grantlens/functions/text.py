"""Column functions on names and free text. All are built-in expressions, inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def squeezed(c: Column) -> Column:
    """White space runs (Unicode) become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def norm(c: Column) -> Column:
    """Upper case; & becomes AND; punctuation becomes a space; null becomes empty."""
    c = F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"(?U)\s*&\s*", " AND ")
    return squeezed(F.regexp_replace(c, r"(?U)[^\w\s]", " "))


def noise_pattern(phrases: Sequence[str]) -> str:
    return r"\b(" + "|".join(phrases) + r")\b"


def strip_wrappers(c: Column, abbreviations: Sequence[tuple[str, str]] = fixed.ABBREVIATIONS, noise: Sequence[str] = fixed.NOISE) -> Column:
    """norm, with abbreviations expanded and phrases that carry no name removed."""
    c = norm(c)
    for short, full in abbreviations:
        c = F.regexp_replace(c, rf"(?U)\b{short}\b", full)
    return squeezed(F.regexp_replace(c, "(?U)" + noise_pattern(noise), " "))


def qnorm(c: Column) -> Column:
    """The key that equal free texts share: trimmed, squeezed, lower case."""
    return F.lower(squeezed(F.coalesce(c, F.lit(""))))


def header_norm(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """Whether one of the words stands in c; false for null."""
    found = F.lit(False)
    for w in words:
        found = found | c.contains(w)
    return F.coalesce(found, F.lit(False))


def keyword_filter(c: Column, exclude: Sequence[str] = fixed.EXCLUDE_WORDS, include: Sequence[str] = fixed.INCLUDE_WORDS, names: Sequence[str] = fixed.INCLUDE_NAMES) -> Column:
    """Exclusions win; then any keyword or name lets a text in. Case doesn't count."""
    low = F.lower(c)
    return ~contains_any(low, exclude) & (contains_any(low, include) | contains_any(low, names))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor '', 'null' or 'NULL'."""
    return F.coalesce(*[F.when(~c.isin("", "null", "NULL"), c) for c in columns])


def plausible_year(c: Column, least: int, most: int) -> Column:
    year = F.regexp_extract(c, r"^(\d{4})", 1)
    return F.when(year.try_cast("int").between(least, most), year)


def filing_year(columns: Sequence[Column], least: int, most: int) -> Column:
    """The first plausible year of the columns, or 'unknown'."""
    return F.coalesce(*[plausible_year(c, least, most) for c in columns], F.lit("unknown"))


def money(c: Column) -> Column:
    """A tolerant number: $, commas and white space go; what is no number is null; an empty text is 0."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), r"[,$\s]", "")
    return F.when(bare == "", F.lit(0.0)).otherwise(bare.try_cast("double"))


def timestamp_or_first(c: Column) -> Column:
    """A timestamp from ISO text; else from its first ten characters; else the least one."""
    return F.coalesce(c.try_cast("timestamp"), F.substring(c, 1, 10).try_cast("timestamp"), F.lit("0001-01-01 00:00:00").cast("timestamp"))


def tokens(c: Column) -> Column:
    """The distinct words of a normalised text, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.split(c, " "), lambda t: t != "")))


def distinctive_tokens(c: Column, common: Sequence[str] = fixed.COMMON_TOKENS) -> Column:
    return F.array_except(tokens(c), F.array(*[F.lit(t) for t in common]))


def bool_text(c: Column) -> Column:
    return F.when(c, "True").otherwise("False")


def shard(c: Column, n: int) -> Column:
    """A stable shard number from CRC-32."""
    return F.pmod(F.crc32(c.cast("binary")), F.lit(n))
