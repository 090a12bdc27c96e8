"""Nearest names by character n-grams: TF-IDF cosine over distinct names, joined on the heaviest grams, with upper bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..functions.numbering import top_rows
from .alike import meet


def grams(c: Column, least: int = 3, most: int = 5) -> Column:
    """All n-grams of least to most characters, with repeats, of the text between spaces."""
    padded = F.concat(F.lit(" "), c, F.lit(" "))

    def of(n: int) -> Column:
        count = F.length(padded) - n + 1
        return F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.substring(padded, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of(n) for n in range(least, most + 1)])


def weights(names: DataFrame, least: int, most: int, idf: DataFrame | None = None) -> DataFrame:
    """n, g, w: unit vectors of tf * idf. idf (g, idf) comes from the entries; grams that they lack fall out."""
    tf = names.select("n").distinct().select("n", F.explode(grams(F.col("n"), least, most)).alias("g")).groupBy("n", "g").agg(F.count("*").alias("tf"))
    rows = tf.join(idf, "g").withColumn("w", F.col("tf") * F.col("idf"))
    norm = rows.groupBy("n").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return rows.join(norm, "n").select("n", "g", (F.col("w") / F.col("norm")).alias("w"))


def inverse_frequency(entries: DataFrame, least: int, most: int) -> DataFrame:
    """g, idf over the distinct entries: ln((1 + N) / (1 + df)) + 1."""
    distinct = entries.select("n").distinct()
    df = distinct.select("n", F.explode(F.array_distinct(grams(F.col("n"), least, most))).alias("g")).groupBy("g").agg(F.count("*").alias("df"))
    total = distinct.agg(F.count("*").alias("total"))
    return df.join(F.broadcast(total)).select("g", (F.log((1.0 + F.col("total")) / (1.0 + F.col("df"))) + 1).alias("idf"))


def dots(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """q, n, cosine of the pairs. a: q, g, wq; b: n, g, w."""
    return pairs.join(a, "q").join(b, ["n", "g"]).groupBy("q", "n").agg(F.round(F.sum(F.col("wq") * F.col("w")), 9).alias("cosine"))


def floors(a: DataFrame, b: DataFrame, k: int, heavy: int = 4, champions: int = 4) -> DataFrame:
    """q, floor: the k-th best cosine among the entries in which a query's heaviest grams weigh most; 0 if there are fewer.

    What is k-th best overall is no less. Of a gram's entries only `champions` times k are looked at here.
    """
    first = top_rows(a, ["q"], [F.desc("wq"), F.asc("g")], heavy)
    index = top_rows(b, ["g"], [F.desc("w"), F.asc("n")], champions * k)
    some = first.join(index, "g").select("q", "n").distinct()
    best = top_rows(dots(some, a, b), ["q"], [F.desc("cosine"), F.asc("n")], k)
    return best.groupBy("q").agg(F.min("cosine").alias("low"), F.count("*").alias("many")).select("q", F.when(F.col("many") == k, F.col("low")).otherwise(0.0).alias("floor"))


def promising(a: DataFrame, b: DataFrame, floor: DataFrame) -> DataFrame:
    """q, n: the pairs whose cosine may reach the query's floor. a: q, g, wq; b: n, g, w, both of unit length.

    A query's grams are taken in falling weight until those left have less length than the floor: an entry with none of
    the taken ones can't reach it. For the others, what they share so far, and the lengths that both have left, bound it.
    """
    slack = 1e-8
    before = Window.partitionBy("q").orderBy(F.desc("wq"), F.asc("g")).rowsBetween(Window.unboundedPreceding, -1)
    rows = a.join(floor, "q", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
    rows = rows.withColumn("left", F.sqrt(F.greatest(F.lit(0.0), 1 - F.coalesce(F.sum(F.col("wq") * F.col("wq")).over(before), F.lit(0.0)))))
    taken = rows.filter(F.col("left") >= F.col("floor") - slack)
    unseen = taken.groupBy("q").agg(F.sqrt(F.greatest(F.lit(0.0), 1 - F.sum(F.col("wq") * F.col("wq")))).alias("unseen"))
    met = meet(taken.select("q", "g", "wq", "floor"), b, ["g"])
    pairs = met.groupBy("q", "n").agg(F.sum(F.col("wq") * F.col("w")).alias("dot"), F.sum(F.col("w") * F.col("w")).alias("seen"), F.first("floor").alias("floor"))
    bound = F.col("dot") + F.col("unseen") * F.sqrt(F.greatest(F.lit(0.0), 1 - F.col("seen")))
    return pairs.join(unseen, "q").filter(bound >= F.col("floor") - slack).select("q", "n")


def nearest(queries: DataFrame, entries: DataFrame, k: int, least: int = 3, most: int = 5) -> DataFrame:
    """q, n, cosine: the k entries nearest each query (both with a column n); ties by name.

    Exact, but few entries are scored: a first guess gives each query a floor, and only entries that may reach it are.
    """
    idf = inverse_frequency(entries, least, most)
    a = cut(weights(queries, least, most, idf).select(F.col("n").alias("q"), "g", F.col("w").alias("wq")))
    b = cut(weights(entries, least, most, idf))
    pairs = cut(promising(a, b, floors(a, b, k)))
    return top_rows(dots(pairs, a, b), ["q"], [F.desc("cosine"), F.asc("n")], k)
