"""Registering queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry() -> tuple[dict[str, tuple[Query, str | None]], Callable]:
    found: dict[str, tuple[Query, str | None]] = {}

    def query(sql: str | None):
        def put(f: Query) -> Query:
            found[f.__name__] = (f, sql)
            return f

        return put

    return found, query


#: norm() in DuckDB: its \w and \s are ASCII, and its upper case of ß differs.
def sql_norm(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace(upper(replace(coalesce({c}, ''), 'ß', 'ss')), '[\\s\\p{{Z}}]*&[\\s\\p{{Z}}]*', ' AND ', 'g'), '[^\\p{{L}}\\p{{N}}\\p{{M}}_\\s\\p{{Z}}]', ' ', 'g'), '[\\s\\p{{Z}}]+', ' ', 'g'))"


def sql_strip(c: str, abbreviations, noise) -> str:
    """strip_wrappers() in DuckDB, whose word bounds are ASCII: after sql_norm a word ends at a space, and with two between
    words each has bounds of its own."""
    out = f"' ' || replace({sql_norm(c)}, ' ', '  ') || ' '"
    wide = lambda p: p.replace(" ", "  ")
    for short, full in abbreviations:
        out = f"regexp_replace({out}, ' {wide(short)} ', ' {wide(full)} ', 'g')"
    words = "|".join(wide(p) for p in noise)
    return f"trim(regexp_replace(regexp_replace({out}, ' ({words}) ', ' ', 'g'), '\\s+', ' ', 'g'))"


def sql_lcs(a: str, b: str) -> str:
    """The longest common subsequence by a fold over a's characters; state: the table's row as a list."""
    # inner fold: acc grows by one cell per character of b
    return (
        f"list_reduce(list_concat([list_transform(range(length({b}) + 1), lambda z: 0)], list_transform(string_split({a}, ''), lambda ch: [ascii(ch)])), "
        f"lambda prev, x: list_reduce(list_concat([[0]], list_transform(range(1, length({b}) + 1), lambda j: [j])), "
        f"lambda acc, j: list_append(acc, CASE WHEN ascii(substr({b}, j[1]::INT, 1)) = x[1] THEN prev[j[1]] + 1 ELSE greatest(acc[len(acc)], prev[j[1] + 1]) END)))[length({b}) + 1]"
    )
