"""Name similarity from 0 to 100: the normalised length of the longest common subsequence, plain or over tokens.

Two forms with equal results: lcs() is a Column expression, for checks and small sets; scores() is a vectorised UDF
with a bit-parallel recurrence, for volume.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs(a: Column, b: Column) -> Column:
    """The length of the longest common subsequence: one fold over a's characters, each a fold over the row of b's."""
    xs = F.filter(F.split(a, ""), lambda c: c != "")
    ys = F.filter(F.split(b, ""), lambda c: c != "")
    zero = F.transform(F.sequence(F.lit(0), F.length(b)), lambda _: F.lit(0))

    def row(prev: Column, x: Column) -> Column:
        def cell(acc: Column, j: Column) -> Column:
            left = F.element_at(acc, -1)
            diagonal = F.element_at(prev, j) + 1
            return F.concat(acc, F.array(F.when(F.element_at(ys, j) == x, diagonal).otherwise(F.greatest(left, F.element_at(prev, j + 1)))))

        places = F.when(F.length(b) > 0, F.sequence(F.lit(1), F.length(b))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(places, F.array(F.lit(0)), cell)

    return F.aggregate(xs, zero, row, lambda acc: F.element_at(acc, -1))


def ratio(a: Column, b: Column) -> Column:
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * lcs(a, b) / total)


def sorted_tokens(c: Column, distinct: bool = False) -> Column:
    found = F.filter(F.split(c, r"\s+"), lambda t: t != "")
    return F.array_join(F.array_sort(F.array_distinct(found) if distinct else found), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    return ratio(sorted_tokens(a), sorted_tokens(b))


def token_set_ratio(a: Column, b: Column) -> Column:
    """The best ratio of the common tokens with and without each side's others; 100 if one side has no others."""
    x = F.array_sort(F.array_distinct(F.filter(F.split(a, r"\s+"), lambda t: t != "")))
    y = F.array_sort(F.array_distinct(F.filter(F.split(b, r"\s+"), lambda t: t != "")))
    common, only_x, only_y = F.array_intersect(x, y), F.array_except(x, y), F.array_except(y, x)
    both, left, right = F.array_join(common, " "), F.array_join(F.concat(common, only_x), " "), F.array_join(F.concat(common, only_y), " ")
    some = F.size(common) > 0
    best = F.when(some, F.greatest(ratio(left, right), ratio(both, left), ratio(both, right))).otherwise(ratio(left, right))
    empty = (F.size(x) == 0) | (F.size(y) == 0)
    return F.when(empty, F.lit(0.0)).when(some & ((F.size(only_x) == 0) | (F.size(only_y) == 0)), F.lit(100.0)).otherwise(best)


# ---- vectorised form ------------------------------------------------------------------------------------------
def lcs_length(a: str, b: str) -> int:
    """Bit-parallel: one machine-word-like integer holds a row of the table (Hyyro's recurrence)."""
    if not a or not b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & at.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def plain(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / total if total else 100.0


def by_sorted_tokens(a: str, b: str) -> float:
    return plain(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def by_token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
    if common and not (only_x and only_y):
        return 100.0
    left, right = " ".join(common + only_x), " ".join(common + only_y)
    best = plain(left, right)
    if common:
        both = " ".join(common)
        best = max(best, plain(both, left), plain(both, right))
    return best


SCORERS = {"ratio": plain, "token_sort": by_sorted_tokens, "token_set": by_token_set}


def scores(kind: str):
    """A vectorised UDF of two string columns; nulls count as empty. Pairs that repeat within a batch are scored once."""
    scorer = SCORERS[kind]

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(a.fillna(""), b.fillna(""), strict=True):
            if pair not in known:
                known[pair] = scorer(*pair)
            out.append(known[pair])
        return pd.Series(out, dtype="float64")

    return run


def could_reach(a: Column, b: Column, floor: float) -> Column:
    """Whether lengths alone allow a plain ratio of at least floor: twice the shorter over the sum bounds it."""
    return F.lit(200.0) * F.least(F.length(a), F.length(b)) >= F.lit(float(floor)) * (F.length(a) + F.length(b))
