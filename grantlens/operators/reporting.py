"""Audit, samples, star-schema reports and upload projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

#: Dispositions in the order of the audit.
RANK = ["new_mint", "review", "matched", "NCI", "NA"]


def disposition(canonical_id: Column, minted: Column) -> Column:
    return F.when(canonical_id.isin("NA", "NCI"), canonical_id).when(canonical_id == "", "review").when(minted, "new_mint").otherwise("matched")


def audit(rows: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """keys, n_grants, total_amount; amounts that are no numbers count as nothing."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_grants"), F.round(F.coalesce(F.sum(text.money(F.col(amount))), F.lit(0.0)), 2).alias("total_amount"))


def audit_order(rows: DataFrame, column: str = "disposition", position: str = "pos") -> DataFrame:
    """New mints first, then what needs review; within them the largest money first."""
    rank = F.array_position(F.array(*[F.lit(x) for x in RANK]), F.col(column))
    return rows.orderBy(rank, F.desc("total_amount"), position)


def disposition_pivot(rows: DataFrame, by: str, column: str, values: Sequence[str]) -> DataFrame:
    """by, and a count for each value: one aggregate."""
    return rows.groupBy(by).agg(*[F.count_if(F.col(column) == v).alias(f"n_{v.lower()}") for v in values])


def counters(rows: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """One row: how many rows pass each test, and all; one aggregate, combined before the shuffle."""
    return rows.agg(F.count("*").alias("recorded"), *[F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in tests.items()])


def accuracy(rows: DataFrame, by: str, correct: Column) -> DataFrame:
    """by, n, accuracy."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.avg(correct.cast("double")).alias("accuracy"))


def coverage_gaps(expected: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Expected keys that the log lacks."""
    return expected.join(log.select(F.col(key).alias("_seen")).distinct(), F.col(key) == F.col("_seen"), "left_anti")


def stratified_sample(rows: DataFrame, stratum: str, order: Sequence[Column], n: int) -> DataFrame:
    """n rows of each stratum, the first in a fixed order, so that reruns agree."""
    nth = F.row_number().over(Window.partitionBy(stratum).orderBy(*order))
    return rows.withColumn("_nth", nth).filter(F.col("_nth") <= n).drop("_nth")


def without_double_counts(grants: DataFrame, log: DataFrame, file: str, flag: str) -> DataFrame:
    """Grants whose filer isn't flagged in the log."""
    good = log.filter(F.col(flag) == "False").select(F.col(file).alias("_file"))
    return grants.join(good, F.col(file) == F.col("_file"))


def totals(rows: DataFrame, keys: Sequence[str], amount: str, rollup: bool = False, cube: bool = False) -> DataFrame:
    """keys, n, total; with subtotals over prefixes of keys (rollup) or over all their subsets (cube)."""
    grouped = rows.cube(*keys) if cube else rows.rollup(*keys) if rollup else rows.groupBy(*keys)
    return grouped.agg(F.count("*").alias("n"), F.sum(amount).alias("total"))


def mapped_back(rows: DataFrame, resolution: DataFrame, keys: Sequence[tuple[str, Column]], column: str, default: str) -> DataFrame:
    """rows with column from resolution (k0, k1, ..., value); keys pair a name with the row's expression; what isn't found gets the default."""
    on = None
    for i, (_, c) in enumerate(keys):
        test = c == F.col(f"k{i}")
        on = test if on is None else on & test
    out = rows.join(resolution, on, "left").withColumn(column, F.coalesce("value", F.lit(default)))
    return out.drop("value", *[f"k{i}" for i in range(len(keys))])
