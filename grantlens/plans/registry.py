"""All queries on the driver's tables, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import q_filings, q_names, q_reports, q_state, q_tags

MODULES = (q_names, q_filings, q_tags, q_reports, q_state)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolve noisy names, keep each customer-year's latest order, report money by resolved part and year."""
    return q_reports.flagship(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, (f, _) in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
