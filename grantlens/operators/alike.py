"""Pairs of names that may be alike: an exact similarity join with prefix filters.

A ratio of at least `floor` allows a bounded number of inserted and deleted letters, and each of those changes few q-grams
of a name. So two such names have a number of grams in common, and if every name's grams are put in one order, the
first few of each name must share one or more (the prefix filter). The order is by document frequency, the rarest first,
taken from the names themselves, so a name is looked up by what few other names have. Each is looked up by some grams more than needed, and must then share as many more. How many of the looked-up grams
two names share bounds how many they can share in all, and pairs that can't reach what their lengths demand go before
any score is computed. Grams are taken within words and their spaces, so they don't depend on the words' order.

A token-set ratio also reaches the floor where one name's words are nearly all in the other. Such names share one of any
words of the first that have more than the letters it may lack: the rarest of them are looked up among the other's words.

A key that many names have is dealt out on both sides (`meet`), so no task holds it whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import cut, merged
from ..functions.similarity import sorted_tokens

#: Rows of one key and side that meet in a task.
MOST = 2000
#: Letters of a gram; grams that a name is looked up by beyond those that it must be: pairs need so many more in common.
Q, EXTRA = 2, 4
#: Up to so many pairs of equal keys there is nothing to gain from filters.
FEW_PAIRS = 100_000


def meet(a: DataFrame, b: DataFrame, on: Sequence[str], most: int = MOST) -> DataFrame:
    """a joined with b on equal keys. The rows of a key beyond `most` on one side are dealt out into parts, and the other
    side's rows are copied to each part; both sides may be dealt out. Heavy keys are rows / most at most."""
    on = list(on)

    def parts(df: DataFrame, out: str) -> DataFrame:
        return df.groupBy(*on).agg(F.ceil(F.count("*") / most).cast("int").alias(out)).filter(F.col(out) > 1)

    heavy = parts(a, "a_parts").join(parts(b, "b_parts"), on, "full")

    def dealt(df: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        rest = [c for c in df.columns if c not in on]
        rows = df.join(heavy, on, "left").withColumn("own", F.coalesce(own, F.lit(1))).withColumn("other", F.coalesce(other, F.lit(1)))
        rows = rows.withColumn(mine, F.pmod(F.xxhash64(*rest) if rest else F.lit(0), F.col("own")).cast("int"))
        return rows.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col("other") - 1))).select(*on, mine, theirs, *rest)

    left, right = dealt(a, "a_parts", "b_parts", "turn", "part"), dealt(b, "b_parts", "a_parts", "part", "turn")
    return left.join(merged(right), [*on, "turn", "part"]).drop("turn", "part")


def changed(size: Column, floor: float, q: int) -> Column:
    """How many of a text's q-grams a text like it may lack: a deleted letter takes q of them, an inserted one q - 1."""
    f = floor / 100
    most = F.greatest(q * 2 * (1 - f) / (2 - f) * size, (q - 1) * 2 * (1 - f) / f * size)
    return F.floor(most + 1e-6).cast("int")


def _windows(q: int):
    def of(token: Column) -> Column:
        padded = F.concat(F.lit(" "), token, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - (q - 1), F.lit(1))), lambda i: F.substring(padded, i, F.lit(q)))

    return of


def words(c: Column, distinct: bool = False) -> Column:
    found = F.filter(F.split(c, r"\s+"), lambda t: t != "")
    return F.array_distinct(found) if distinct else found


def with_grams(names: DataFrame, name: str, q: int, distinct: bool) -> DataFrame:
    """Adds units: the q-grams of a name's words, repeats numbered; distinct: of words that repeat only one counts, as in a set ratio."""
    rows = names.withColumn("sorted_grams", F.array_sort(F.flatten(F.transform(words(F.col(name), distinct), _windows(q)))))
    return rows.withColumn("units", F.transform("sorted_grams", lambda x, i: F.concat(x, (i + 1 - F.array_position("sorted_grams", x)).cast("string")))).drop("sorted_grams")


def rare_first(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with ranked: their units, those that the fewest names of the two have first."""
    sides = [df.select(*[c for c in df.columns if c != "units"], F.explode("units").alias("u")) for df in (a, b)]
    frequency = sides[0].select("u").unionAll(sides[1].select("u")).groupBy("u").agg(F.count("*").alias("df"))
    out = []
    for side in sides:
        by = [c for c in side.columns if c != "u"]
        out.append(side.join(merged(frequency), "u").groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("df", "u"))).alias("ranked")))
    return out[0], out[1]


def gram_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], floor: float, distinct: bool) -> DataFrame:
    """keys, q, n of pairs that may reach the floor as texts. a: keys, q, size; b: keys, n, size; sizes are the texts' lengths."""
    keys, q = list(keys), Q
    left, right = map(cut, rare_first(with_grams(a, "q", q, distinct), with_grams(b, "n", q, distinct)))

    def looked_up(df: DataFrame, name: str, own: str) -> DataFrame:
        many = F.size("ranked")
        rows = df.withColumn(f"{own}_many", many).withColumn(f"{own}_held", F.least(many, changed(F.col("size"), floor, q) + 1 + EXTRA))
        return rows.select(*keys, name, F.col("size").alias(f"{own}_size"), f"{own}_many", f"{own}_held", F.explode(F.slice("ranked", 1, F.col(f"{own}_held"))).alias("x")).withColumn("u", F.col("x.u")).drop("x")

    met = meet(looked_up(left, "q", "a"), looked_up(right, "n", "b"), [*keys, "u"])
    near = 1 - floor / 100
    most = near * (F.col("a_size") + F.col("b_size"))  # letters deleted and inserted
    met = met.filter(F.abs(F.col("a_size") - F.col("b_size")) <= most + 1e-6)
    found = met.groupBy(*keys, "q", "n").agg(F.count("*").alias("shared"), *[F.first(c).alias(c) for c in ("a_size", "b_size", "a_many", "b_many", "a_held", "b_held")])
    deleted, inserted = (most + F.col("a_size") - F.col("b_size")) / 2, (most - F.col("a_size") + F.col("b_size")) / 2
    need = F.greatest(F.col("a_many") - q * deleted - (q - 1) * inserted, F.col("b_many") - q * inserted - (q - 1) * deleted)
    rest = F.greatest(F.col("a_many") - F.col("a_held"), F.col("b_many") - F.col("b_held"))
    return found.filter(F.col("shared") + rest >= need - 1e-6).select(*keys, "q", "n").unionByName(short_pairs(left, right, keys, floor, q))


def short_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], floor: float, q: int) -> DataFrame:
    """Pairs of texts of which neither has more grams than may change (words of a letter or two): they meet on near lengths."""
    share = floor / (200 - floor)
    few = F.size("ranked") <= changed(F.col("size"), floor, q)
    lengths = F.sequence(F.ceil(F.col("a_size") * share - 1e-6).cast("int"), F.floor(F.col("a_size") / share + 1e-6).cast("int"))
    left = a.filter(few).select(*keys, "q", F.col("size").alias("a_size")).withColumn("size", F.explode(lengths)).drop("a_size")
    return meet(left, b.filter(few).select(*keys, "n", "size"), [*keys, "size"]).select(*keys, "q", "n")


def telling(ranked: Column, size: Column, floor: float) -> Column:
    """Of ranked words, the first with more letters than a text that shares enough of them may lack."""
    share = floor / (200 - floor)  # of the longer text that the shorter one has at least
    start = F.struct(F.lit(0).alias("letters"), F.array().cast("array<string>").alias("taken"))
    enough = (1 - share) * size

    def step(acc: Column, x: Column) -> Column:
        more = acc["letters"] <= enough
        return F.struct((acc["letters"] + F.length(x["u"])).alias("letters"), F.when(more, F.concat(acc["taken"], F.array(x["u"]))).otherwise(acc["taken"]).alias("taken"))

    return F.aggregate(ranked, start, step, lambda acc: acc["taken"])


def word_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], floor: float) -> DataFrame:
    """keys, q, n of pairs of which one's words may nearly all be the other's. a: keys, q, size; b: keys, n, size."""
    keys = list(keys)
    left, right = map(cut, rare_first(a.withColumn("units", words(F.col("q"), True)), b.withColumn("units", words(F.col("n"), True))))
    some = lambda df, name: df.select(*keys, name, F.explode(telling(F.col("ranked"), F.col("size"), floor)).alias("u"))
    every = lambda df, name: df.select(*keys, name, F.explode("ranked.u").alias("u"))
    met = meet(some(left, "q"), every(right, "n"), [*keys, "u"]).unionByName(meet(every(left, "q"), some(right, "n"), [*keys, "u"]))
    return met.select(*keys, "q", "n")


def paired(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> int:
    """How many pairs have equal keys."""
    if not keys:
        return a.count() * b.count()
    counts = [df.groupBy(*keys).agg(F.count("*").alias(n)) for df, n in ((a, "x"), (b, "y"))]
    return counts[0].join(counts[1], list(keys)).agg(F.coalesce(F.sum(F.col("x") * F.col("y")), F.lit(0))).first()[0]


def candidates(queries: DataFrame, entries: DataFrame, kind: str, floor: float, keys: Sequence[str] = (), few_pairs: int | None = None) -> DataFrame:
    """keys, q, n: the distinct pairs, of equal keys, that may reach the floor: all that do, and few others.

    queries: keys, q; entries: keys, n; kind: ratio, token_sort or token_set. Nulls and names without words have no pair.
    Where equal keys make few pairs anyway (counted first), they only need lengths that are near enough.
    """
    form = {"ratio": lambda c: c, "token_sort": sorted_tokens, "token_set": lambda c: sorted_tokens(c, True)}[kind]
    a = cut(queries.select(*keys, "q").filter("q IS NOT NULL").distinct().withColumn("size", F.length(form(F.col("q")))))
    b = cut(entries.select(*keys, "n").filter("n IS NOT NULL").distinct().withColumn("size", F.length(form(F.col("n")))))
    if paired(a, b, keys) <= (FEW_PAIRS if few_pairs is None else few_pairs):
        one, sizes = F.lit(1).alias("every"), F.least("size", "b_size") * 200 + 1e-6 >= floor * (F.col("size") + F.col("b_size"))
        met = a.filter("size > 0").select(*keys, one, "q", "size").join(b.filter("size > 0").select(*keys, one, "n", F.col("size").alias("b_size")), [*keys, "every"])
        return met.filter(sizes if kind != "token_set" else F.lit(True)).select(*keys, "q", "n")
    pairs = gram_pairs(a, b, keys, floor, kind == "token_set")
    if kind == "token_set":
        pairs = pairs.unionByName(word_pairs(a, b, keys, floor))
    return pairs.distinct()
