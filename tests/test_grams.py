"""Top-k by n-grams against all pairs; how many pairs are scored."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from grantlens.operators import grams


def vectors(names, idf=None):
    def of(n):
        t = f" {n} "
        return Counter(t[i : i + s] for s in (3, 4, 5) for i in range(len(t) - s + 1))

    if idf is None:
        df = Counter(g for n in set(names) for g in of(n))
        idf = {g: math.log((1 + len(set(names))) / (1 + c)) + 1 for g, c in df.items()}
    out = {}
    for n in set(names):
        v = {g: c * idf[g] for g, c in of(n).items() if g in idf}
        size = math.sqrt(sum(x * x for x in v.values()))
        out[n] = {g: x / size for g, x in v.items()} if size else {}
    return out, idf


def names(rng, n):
    words = ["university", "college", "of", "state", *["".join(rng.choice("abcdelmnort") for _ in range(rng.randint(3, 9))) for _ in range(n // 3)]]
    return [" ".join(rng.choice(words[:4] if rng.random() < 0.4 else words) for _ in range(rng.randint(2, 4))) for _ in range(n)]


def test_top_k_is_that_of_all_pairs(spark):
    rng = random.Random(2)
    entries = names(rng, 150)
    asked = [e.replace("e", "a", 1) for e in entries[:60]] + ["zzz", "university", "", entries[3]]
    found = {}
    for r in grams.nearest(spark.createDataFrame([(q,) for q in asked], "n string"), spark.createDataFrame([(e,) for e in entries], "n string"), 3).collect():
        found.setdefault(r["q"], []).append((-r["cosine"], r["n"]))
    b, idf = vectors(entries)
    a, _ = vectors(asked, idf)
    for q, v in a.items():
        scored = sorted((-round(sum(x * w.get(g, 0) for g, x in v.items()), 9), n) for n, w in b.items() if set(v) & set(w))[:3]
        got = sorted(found.get(q, []))
        assert [n for _, n in got] == [n for _, n in scored] or all(abs(x - y) < 2e-9 for (x, _), (y, _) in zip(got, scored, strict=True))
        assert len(got) == len(scored)


def test_few_pairs_are_scored(spark):
    """Words that a third of all names have bring no pairs of their own."""
    counts = []
    for n in (200, 1000):
        rng = random.Random(4)
        entries = sorted({f"university of {''.join(rng.choice('abcdefghiklmnoprst') for _ in range(8))} {''.join(rng.choice('abcdefghiklmnoprst') for _ in range(8))}" for _ in range(n)})
        asked = [e[:-1] + "x" for e in entries]
        idf = grams.inverse_frequency(spark.createDataFrame([(e,) for e in entries], "n string"), 3, 5)
        a = grams.weights(spark.createDataFrame([(q,) for q in asked], "n string"), 3, 5, idf).select(F.col("n").alias("q"), "g", F.col("w").alias("wq")).cache()
        b = grams.weights(spark.createDataFrame([(e,) for e in entries], "n string"), 3, 5, idf).cache()
        counts.append(grams.promising(a, b, grams.floors(a, b, 1)).count())
        a.unpersist()
        b.unpersist()
    assert counts[0] < 3 * 200 and counts[1] < 3 * 1000  # of 40,000 and 1,000,000 pairs that share a gram
