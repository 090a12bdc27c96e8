"""The similarity join against every pair; how its candidates grow; heavy keys dealt out."""

import random

import pytest
from pyspark.sql import functions as F

from grantlens.functions import similarity
from grantlens.operators import alike, matching

SCORER = {"ratio": similarity.plain, "token_sort": similarity.by_sorted_tokens, "token_set": similarity.by_token_set}


def names(rng, n, vocabulary):
    out = set()
    while len(out) < n:
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.5 and out:
            words = rng.choice(sorted(out)[:50]).split()
            w = rng.randrange(len(words))
            at = rng.randrange(len(words[w]) + 1)
            words[w] = words[w][:at] + rng.choice(["", "E", "S", "LL"]) + words[w][at + rng.randint(0, 1) :] or "X"
            rng.shuffle(words)
        out.add(" ".join(words))
    return sorted(out)


def word(rng, least=2, most=9):
    return "".join(rng.choice("ABCDEILMNORST") for _ in range(rng.randint(least, most)))


@pytest.mark.parametrize(("kind", "floor", "few"), [("ratio", 90, 0), ("token_sort", 92, 0), ("token_sort", 80, 0), ("token_set", 95, 0), ("token_set", 83, 0), ("token_set", 85, None)])
def test_no_pair_that_reaches_the_floor_is_missing(spark, kind, floor, few):
    rng = random.Random(floor)
    vocabulary = [word(rng) for _ in range(40)] + ["A", "B", "C", "OF", "UNIVERSITY", "COLLEGE"]
    a = names(rng, 150, vocabulary) + ["A B C", "A B", "A A B C", "X", "", "OF OF OF COLLEGE", "ABCDEFGH ABCDEFGX", None]
    b = names(rng, 150, vocabulary) + ["A B C", "B A", "A B C C", "XY", "", "OF COLLEGE", "ABCDEFGH ABCDEFGH", None]
    left = spark.createDataFrame([(q, s) for q in a for s in ("S1", "S2")], "q string, s string")
    right = spark.createDataFrame([(n, "S1" if i % 2 else "S2") for i, n in enumerate(b)] + [(b[0], "S3")], "n string, s string")
    got = {tuple(r) for r in alike.candidates(left, right, kind, floor, ["s"], few_pairs=few).select("q", "n", "s").collect()}
    want = {(q, n, "S1" if i % 2 else "S2") for q in a if q for i, n in enumerate(b) if n and SCORER[kind](q, n) >= floor}
    assert want <= got
    assert all(s in ("S1", "S2") for _, _, s in got)


def test_candidates_grow_with_the_names(spark):
    """Ten times the names, ten times the words they are made of: candidates grow in proportion, not with the square."""
    counts = []
    for n in (200, 2000):
        rng = random.Random(7)
        vocabulary = [word(rng, 5, 11) for _ in range(n)]
        made = [" ".join(["UNIVERSITY OF", rng.choice(vocabulary), rng.choice(vocabulary), rng.choice(["COLLEGE", "STATE", "CAMPUS"])]) for _ in range(n)]
        typed = [m.replace("E", "EE", 1) for m in made]
        left, right = spark.createDataFrame([(q,) for q in typed], "q string"), spark.createDataFrame([(m,) for m in made], "n string")
        counts.append([alike.candidates(left, right, kind, floor, few_pairs=0).count() for kind, floor in (("token_sort", 92), ("token_set", 95))])
    for small, large in zip(*counts, strict=True):
        assert small < 200 * 10 and large < 2000 * 10, counts  # of 40,000 and 4,000,000 pairs


def test_a_word_of_a_third_of_all_names_is_dealt_out(spark):
    """Every name has the same frequent word: no key of the joins holds more than its share of rows."""
    a = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(900)], "i int, k string")
    b = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(600)], "j int, k string")
    met = alike.meet(a, b, ["k"], most=50)
    assert met.count() == 600 * 400 + 200
    assert met.select("i", "j").distinct().count() == met.count()
    # the largest join key holds most * most pairs
    left = alike.meet(a.withColumn("mark", F.lit(1)), b, ["k"], most=50)
    assert set(left.columns) == {"k", "i", "mark", "j"}


def test_national_needs_a_distinctive_word(spark):
    dim = spark.createDataFrame([("1", "NORTH STATE COLLEGE", "TX", "", "IPEDS-US", 0), ("2", "ZENITH STATE COLLEGE", "TX", "", "IPEDS-US", 1)], "canonical_id string, name string, state string, city string, entity_class string, pos int")
    asked = spark.createDataFrame([(1, "SOUTH STATE COLLEGE"), (2, "ZENITH COLLEGE OF STATE")], "qid int, q string")
    found = {r["qid"]: r["canonical_id"] for r in matching.national(asked, dim, 80, 0).collect()}
    assert found == {2: "2"}
