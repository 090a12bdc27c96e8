"""Rules and anchors as tables, found in texts by an Aho-Corasick automaton.

All patterns of a table are one automaton, which reads a text once however many patterns there are. Its patterns are
counted first: a table beyond PATTERN_CHARS characters becomes several automata, each within the bound and each broadcast
in its turn, whose findings are merged. Texts stay where they are; only a text's winner leaves a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of patterns that one automaton holds at most: some hundred bytes of memory each.
PATTERN_CHARS = 2_000_000


def shares(patterns: DataFrame, of: str, most: int | None = None) -> Iterator[DataFrame]:
    """patterns in parts of about PATTERN_CHARS characters at most, by a hash of column `of` (a string)."""
    chars = patterns.agg(F.coalesce(F.sum(F.length(of)), F.lit(0))).first()[0]
    parts = max(1, -(-chars // (most or PATTERN_CHARS)))
    for i in range(parts):
        yield patterns if parts == 1 else patterns.filter(F.pmod(F.xxhash64(of), F.lit(parts)) == i)


def automaton(words: dict[str, object]) -> ahocorasick.Automaton | None:
    """None if there are no patterns."""
    found = ahocorasick.Automaton()
    for word, value in words.items():
        if word:
            found.add_word(word, value)
    if not len(found):
        return None
    found.make_automaton()
    return found


def _scan(texts: DataFrame, key: str, column: str, schema: str, judge: Callable[[str], list[tuple]]) -> DataFrame:
    """key and what judge finds in each text: rows of schema; no row for a null text."""
    kind = texts.schema[key].dataType.simpleString()
    names = [key, *[c.split()[0] for c in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at = [], []
            for i, text in enumerate(batch.column(1)):
                for found in judge(text.as_py()) if text.is_valid else ():
                    rows.append(found)
                    at.append(i)
            columns = [batch.column(0).take(pa.array(at, pa.int64()))]
            kinds = [pa.int32() if c.endswith(" int") else pa.string() for c in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)]], names)

    return texts.select(F.col(key).alias("key"), F.col(column).cast("string").alias("text")).mapInArrow(run, f"`{key}` {kind}, {schema}")


def longest_anchor(texts: DataFrame, key: str, column: str, anchors: DataFrame, most: int | None = None) -> DataFrame:
    """key, anchor: the longest anchor that stands in the text between spaces (the least of equals). Texts without one have no row.

    A key's rows count as one text. Empty and null anchors are none.
    """
    spark, found = texts.sparkSession, None
    for part in shares(anchors.select("anchor").filter("anchor <> ''").distinct(), "anchor", most):
        held = automaton({f" {r['anchor']} ": r["anchor"] for r in part.collect()})  # within PATTERN_CHARS
        if held is None:
            continue
        shared = spark.sparkContext.broadcast(held)

        def longest(text: str, shared=shared) -> list[tuple]:
            best = None
            for _, anchor in shared.value.iter(f" {text} "):
                if best is None or (-len(anchor), anchor) < (-len(best), best):
                    best = anchor
            return [] if best is None else [(best,)]

        one = _scan(texts, key, column, "anchor string", longest)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return texts.select(key, F.lit(None).cast("string").alias("anchor")).limit(0)
    return found.groupBy(key).agg(F.min_by("anchor", F.struct(-F.length("anchor"), F.col("anchor"))).alias("anchor"))


def first_rule(texts: DataFrame, key: str, column: str, rules: DataFrame, most: int | None = None) -> DataFrame:
    """key, id: of the first rule (by rule_no) whose text stands anywhere in the text and none of whose exclusions does.

    rules: rule_no int, must string, excludes array<string>, id string. Texts without a rule have no row; a key's rows are
    judged apart, and the first rule among them wins. A rule with an empty or null must never fits.
    """
    spark, found = texts.sparkSession, None
    usable = rules.filter("must <> ''").select("rule_no", "must", F.coalesce("excludes", F.array().cast("array<string>")).alias("excludes"), "id")
    usable = usable.withColumn("chars", F.concat_ws("\x01", "must", "excludes"))
    for part in shares(usable, "chars", most):
        rows = part.collect()  # within PATTERN_CHARS
        patterns: dict[str, tuple[list, str]] = {}
        for r in rows:
            patterns.setdefault(r["must"], ([], r["must"]))[0].append((r["rule_no"], tuple(x for x in r["excludes"] if x is not None), r["id"]))
            for x in r["excludes"]:
                if x:
                    patterns.setdefault(x, ([], x))
        held = automaton(patterns)
        if held is None:
            continue
        shared = spark.sparkContext.broadcast(held)

        def first(text: str, shared=shared) -> list[tuple]:
            met: dict[str, list] = {}
            for _, (mine, pattern) in shared.value.iter(text):
                met[pattern] = mine
            # an empty exclusion stands in every text
            fit = [(no, ident) for mine in met.values() for no, excludes, ident in mine if not any(x == "" or x in met for x in excludes)]
            return [min(fit, key=lambda x: (x[0], x[1] or ""))] if fit else []

        one = _scan(texts, key, column, "rule_no int, id string", first)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return texts.select(key, F.lit(None).cast("string").alias("id")).limit(0)
    return found.groupBy(key).agg(F.min_by("id", F.struct("rule_no", "id")).alias("id"))
