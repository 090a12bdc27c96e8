"""Anchors and rules by automaton against plain searches."""

import random
import time

from grantlens.operators import anchors


def plain_longest(text, names):
    fit = [n for n in names if n and f" {n} " in f" {text} "]
    return min(fit, key=lambda n: (-len(n), n)) if fit else None


def texts_and_names(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    names = {" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(n)}
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    return texts + [(500, None), (501, ""), (502, " "), (None, sorted(names)[0]), (503, "  ".join(sorted(names)[:3]))], sorted(names)


def test_longest_anchor(spark):
    texts, names = texts_and_names(1, 200)
    df = spark.createDataFrame(texts, "k long, t string").repartition(3)
    table = spark.createDataFrame([(n,) for n in [*names, names[0], "", None]], "anchor string")
    want = {(k, plain_longest(t, names)) for k, t in texts if t is not None and plain_longest(t, names)}
    assert {tuple(r) for r in anchors.longest_anchor(df, "k", "t", table).collect()} == want
    # several automata, none of them beyond the bound
    assert {tuple(r) for r in anchors.longest_anchor(df, "k", "t", table, most=300).collect()} == want
    assert anchors.longest_anchor(df, "k", "t", table.limit(0)).collect() == []
    assert anchors.longest_anchor(df.limit(0), "k", "t", table).collect() == []


def test_first_rule(spark):
    texts, names = texts_and_names(2, 80)
    rng = random.Random(3)
    rules = [(i, n, rng.sample(names, rng.randint(0, 2)), f"r{i}") for i, n in enumerate(names)] + [(-1, "", [], "never"), (-2, None, None, "never"), (-3, names[5], [""], "never"), (900, "a", None, "last")]
    rng.shuffle(rules)
    df = spark.createDataFrame(texts, "k long, t string").repartition(3)
    table = spark.createDataFrame(rules, "rule_no int, must string, excludes array<string>, id string")
    want = set()
    for k, t in texts:
        fit = [(no, i) for no, must, excludes, i in rules if t is not None and must and must in t and not any(x in t for x in excludes or [])]
        if fit:
            want.add((k, min(fit)[1]))
    assert {tuple(r) for r in anchors.first_rule(df, "k", "t", table).collect()} == want
    assert {tuple(r) for r in anchors.first_rule(df, "k", "t", table, most=400).collect()} == want


def test_a_hundred_thousand_anchors(spark):
    """Reading a text costs the text, not the table: ten times the anchors, about the same time."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(4000)]
    names = sorted({" ".join(rng.choice(words) for _ in range(3)) for _ in range(100_000)})
    texts = [(i, " ".join(rng.choice(words) for _ in range(300)) + " " + rng.choice(names)) for i in range(300)] + [(999, " ".join(rng.choice(words) for _ in range(300_000)) + " " + names[7])]
    df, table = spark.createDataFrame(texts, "k long, t string"), spark.createDataFrame([(n,) for n in names], "anchor string")
    took = time.time()
    found = {r["k"]: r["anchor"] for r in anchors.longest_anchor(df, "k", "t", table).collect()}
    assert time.time() - took < 60
    held = set(names)
    for k, t in texts[:40] + texts[-1:]:
        w = t.split()
        assert found[k] == min((c for c in (" ".join(w[i : i + 3]) for i in range(len(w))) if c in held), key=lambda n: (-len(n), n))
