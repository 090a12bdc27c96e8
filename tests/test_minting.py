"""Minting in order against a plain fold over the names."""

import random

import pytest

from grantlens.functions import similarity
from grantlens.operators import minting
from grantlens.plans import stages


def fold(rows, join=93, near=88, margin=10):
    """One name after the other, as the rule says: rows (qid, key, may_lead, best, second) in order."""
    leaders, out = [], {}
    for qid, key, may_lead, best, second in rows:
        if key in leaders:
            out[qid] = ("joins", key)
            continue
        like = []
        for n in leaders:
            if len(key) >= 10 and " " in key and set(key.split()) & set(n.split()):
                score = similarity.by_token_set(key, n)
                if score >= join - margin:
                    like.append((score, n))
        like.sort(reverse=True)
        mine, rival = (like[0][0] if like else 0), (like[1][0] if len(like) > 1 else 0)
        top, other = max(mine, best), (max(rival, best) if mine > best else max(mine, second))
        if top >= join and top - other >= margin:
            out[qid] = ("joins", like[0][1]) if mine > best else ("stays", None)
        elif top >= near:
            out[qid] = ("near", None)
        elif may_lead:
            leaders.append(key)
            out[qid] = ("leads", key)
        else:
            out[qid] = ("alone", None)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_names_settle_as_one_after_the_other(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["ALPHA", "BETA", "GAMMA", "DELTA", "EPSILON", "ZETA", "KAPPA", "LAMBDA", "OMICRON", "SIGMA"]
    names = []
    for _ in range(160):
        if names and rng.random() < 0.6:  # chains: a name made from the one before it
            words = names[-1].split()
            w = rng.randrange(len(words))
            words[w] = rng.choice([words[w] + "S", words[w][:-1] or "X", rng.choice(vocabulary)])
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 4))]
        names.append(" ".join(words))
    rows = []
    for i, name in enumerate(names):
        best = rng.choice([0, 0, 0, 0, 85, 90, 95])
        rows.append((i, name, best < 88 and rng.random() < 0.9, best, rng.choice([0, 84]) if best else 0))
    # whether a key may lead is the key's own property
    first = {}
    rows = [(i, n, *first.setdefault(n, (may, float(b), float(s)))) for i, n, may, b, s in rows]
    df = spark.createDataFrame([(i, i * 10, n, n, may, b, s) for i, n, may, b, s in rows], "qid int, place int, key string, q string, may_lead boolean, best double, second double")
    got = {r["qid"]: (r["verdict"], r["leader"]) for r in minting.settled(df.repartition(5), common=()).collect()}
    assert got == fold(rows)
    assert {v for v, _ in got.values()} >= {"leads", "joins", "near"}


def test_a_long_chain_of_waiting_names(spark):
    """Each name resembles the one before it only: every second one leads."""
    links = spark.createDataFrame([(i + 1, i) for i in range(12)], "later int, earlier int")
    assert sorted(r["node"] for r in minting.out_of_order(links).collect()) == [1, 3, 5, 7, 9, 11]
    assert minting.out_of_order(links.limit(0)).collect() == []


def test_later_names_of_a_run_meet_its_mints(spark):
    dim = spark.createDataFrame([("SG00007", "Quite Different Seminary", "TX", "United States", "non-IPEDS-US", "Waco")], "canonical_id string, grantee_normalized string, state string, country string, entity_class string, city string")
    said = {"Nova Polytechnic Reno": "Nova Polytechnic of Reno", "Nova Polytechnic Reno Inc": "The Nova Polytechnic of Reno", "N Polytechnic of Reno": "Nova Polytechnic of Renoo", "Nova Polytechnic": "Nova Polytechnic", "Harvard Extension Berlin": "Harvard", "Vega Conservatory": "Vega Conservatory of Music"}
    grants = spark.createDataFrame(
        [(f"{i}.xml", n, "Berlin" if "Harvard" in n else "Reno", "ON" if "Vega" in n else "PR" if n == "Nova Polytechnic Reno" else "NV", "Germany" if "Harvard" in n else "United States", "10115" if "Harvard" in n else "89501", "10", i) for i, n in enumerate(said)],
        "xml_file string, grantee string, grantee_city string, grantee_state string, grantee_country string, grantee_zip string, grant_amount string, pos int",
    )
    for c in stages.tables.PARSED.names:
        if c not in grants.columns:
            grants = grants.withColumn(c, stages.F.lit(""))
    answers = spark.createDataFrame([(n, "foreign" if "Harvard" in n else "us_university", v, "Germany" if "Harvard" in n else "US") for n, v in said.items()], "name string, v_type string, v_name string, v_country string")
    got = stages.match(grants, dim, answers=lambda left: left.select("qid", "name").join(answers, "name").drop("name"))
    ids = {r["grantee"]: r["canonical_id"] for r in got.grants.collect()}
    assert ids["Nova Polytechnic Reno"] == ids["Nova Polytechnic Reno Inc"] == ids["N Polytechnic of Reno"] == "SG00008"
    assert ids["Nova Polytechnic"] == "SG00008"  # all of its words are in the mint's name
    assert ids["Harvard Extension Berlin"] == ""  # never abroad
    assert ids["Vega Conservatory"] == "SG00009"
    rows = {r["canonical_id"]: (r["grantee_normalized"], r["state"], r["country"]) for r in got.new_institutions.collect()}
    assert rows == {"SG00008": ("Nova Polytechnic of Reno", "Puerto Rico", "United States"), "SG00009": ("Vega Conservatory of Music", "", "United States")}
