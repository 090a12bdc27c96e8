"""Language ID, quality, nearest neighbours and the pipeline."""

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from fixtures import documents, empty, frame

from grantlens.llm import ann, langid, quality, queries, stages


def test_marginals_equal_a_plain_forward_backward():
    rng = np.random.default_rng(0)
    scores, switch = rng.normal(size=(900, 3)) * 3, rng.normal(size=(3, 3))
    at = np.array([0, 1, 1, 130, 400, 900])
    got = langid.marginals(scores, at, switch)
    psi = np.exp(switch)
    for lo, hi in zip(at, at[1:], strict=False):
        ahead, v = [], np.ones(3) / 3
        for k in range(lo, hi):
            v = (v @ psi) * np.exp(scores[k])
            v /= v.sum()
            ahead.append(v)
        back, v = [], np.ones(3)
        for k in range(hi - 1, lo - 1, -1):
            back.append(v)
            v = psi @ (np.exp(scores[k]) * v)
            v /= v.sum()
        if hi > lo:
            want = np.array(ahead) * np.array(back[::-1])
            assert np.allclose(got[lo:hi], want / want.sum(axis=1, keepdims=True))


def test_code_switched_words_get_their_own_language():
    rows = [("the cat and the house with this then " * 30, "en"), ("der hund und das haus mit einer nicht " * 30, "de")] * 4
    model = langid.train(rows)
    text = langid.parsed(["the house and then der hund mit einer " * 3])
    labels = langid.marginals(langid.emissions(text, model.weights), text.at, model.switch).argmax(axis=1)
    want = ([1, 1, 1, 1, 0, 0, 0, 0] * 3)
    assert (labels == want).mean() >= 0.9


def test_languages_of_odd_texts(spark):
    rows = langid.languages(frame(spark)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _, _, _ in documents())
    got = {r["doc_id"]: r for r in rows}
    for d in (6, 7, 8, 10):
        assert got[d]["lang_pred"] == "und"
    assert got[9]["lang_pred"] in ("en", "fr", "de", "es")
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows if r["doc_id"] is not None)


def test_languages_held_out(spark, small):
    found = queries.op8_langid(spark, small).filter("held_out")
    truth = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.95


def test_languages_without_training_rows(spark):
    rows = [(d, t, None, s) for d, t, _, s in documents()]
    assert {r["lang_pred"] for r in langid.languages(frame(spark, rows)).collect()} == {"und"}


def test_quality_held_out(spark, small):
    sf = small.replace("sf0.001", "sf0.01")
    rows = queries.op4_quality(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) >= 0.9
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_quality_with_few_or_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.scored(frame(spark), none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality.scored(frame(spark), one).collect()
    assert len(rows) == len(documents())
    assert len({r["score"] for r in rows}) == 1


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cid long, v string")


def test_neighbours_equal_brute_force_on_few_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[50:90] = x[20]
    x[5] = 0
    rows = [(i, x[i].tolist(), 0, 1, "x") for i in range(300)]
    rows += [(1000, None, 0, 1, "x"), (1020, [float("nan")] * 8, 0, 1, "x"), (1040, [1.0, None] * 4, 0, 1, "x"), (1060, [1.0, 2.0], 0, 1, "x"), (None, x[3].tolist(), 0, 1, "x"), rows[7]]
    got = {}
    for r in ann.neighbours(vectors(spark, rows)).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    ids = [i for i in range(300) if i != 5]
    assert set(got) == {i for i in ids if i % 20 == 0}
    hit = 0
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21))
        scores = {i: float(np.dot(x[q].astype(float), x[i].astype(float))) for i in ids if i != q}
        best = sorted(scores, key=lambda i: (-round(scores[i], 12), i))[:20]
        hit += len(set(best) & {v for v, _ in found.values()})
        for v, s in found.values():
            assert s == pytest.approx(scores[v], abs=1e-12)
        order = [(-round(s, 12), v) for _, (v, s) in sorted(found.items())]
        assert order == sorted(order)
    assert hit / (20 * len(got)) >= 0.9


def test_recall(spark, small):
    sf = small.replace("sf0.001", "sf0.1")
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    got = {}
    for r in queries.op6_ann(spark, sf).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        hit += len(got[ids[i]] & set(ids[np.argsort(-scores)[:20]].tolist()))
        total += 20
    assert hit / total >= 0.9


def found_shares(spark, x):
    """Of each twentieth row, the share of its 20 nearest, by brute force, that neighbours() finds; rising."""
    got = {}
    df = spark.createDataFrame([(i, v.tolist(), 0, 1, "x") for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int, cid long, v string")
    for r in ann.neighbours(df).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    shares, asked = [], np.arange(0, len(x), 20)
    for lo in range(0, len(asked), 200):
        some = asked[lo : lo + 200]
        scores = x[some] @ x.T
        scores[np.arange(len(some)), some] = -np.inf
        best = np.argpartition(-scores, 20, axis=1)[:, :20]
        shares += [len(got[i] & set(b)) / 20 for i, b in zip(some.tolist(), best.tolist(), strict=True)]
    return np.sort(shares)


def test_recall_on_fifty_thousand(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(400, 16))
    assert found_shares(spark, centres[rng.integers(0, 400, 50_000)] + 0.4 * rng.normal(size=(50_000, 16))).mean() >= 0.9


def test_recall_where_the_index_is_sampled(spark):
    """More than twice the sample. Measured: 0.96 in all, 0.71 in the worst tenth of the queries."""
    rng = np.random.default_rng(1)
    n = 150_000
    assert n > 2 * ann.SAMPLE
    shares = found_shares(spark, rng.normal(size=(1500, 16))[rng.integers(0, 1500, n)] + 0.4 * rng.normal(size=(n, 16)))
    assert shares.mean() >= 0.9
    assert shares[: len(shares) // 10].mean() >= 0.6


def test_recall_of_a_small_sample(spark, monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(ann, "SAMPLE", 2048)
    shares = found_shares(spark, rng.normal(size=(400, 16))[rng.integers(0, 400, 30_000)] + 0.4 * rng.normal(size=(30_000, 16)))
    assert shares.mean() >= 0.95 and shares[: len(shares) // 10].mean() >= 0.8


def test_ties_beyond_what_is_kept_go_to_smaller_ids():
    """A block of 300 unlike vectors with one and the same score, and some lower ones: rounding of products decides nothing."""
    rng = np.random.default_rng(9)
    rows = [(0, int(i), [5.0, 0.1 * (i % 7), 1e6 / i]) for i in rng.permutation(np.arange(1, 301))] + [(0, i, [4.0, float(i), 1.0]) for i in range(1001, 1101)]
    asked = pd.DataFrame({"cid": [7000], "v": [[1.0, 0.0, 0.0]], "lists": [[0]]})
    found = ann._best(20)(asked, pd.DataFrame(rows, columns=["list", "cid", "v"]))
    assert list(zip(found["cid"], found["score"], strict=True)) == [(i, 5.0) for i in range(1, 22)]


def test_samples_are_bounded_by_rows_when_one_id_stands_very_often(spark, monkeypatch):
    """5,000 rows of one id bring one text of it to the driver."""
    rows = [(7, f"good text of many plain words {i} " * 5, "en", "a") for i in range(5000)] + [(i, f"other text {i} " * 9, "en", "a") for i in range(20, 60)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(7, 1, 0), *[(i, i % 2, 0) for i in range(20, 60)]], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows, counts: seen.append(len(rows)))
    monkeypatch.setattr(langid, "train", lambda rows: seen.append(len(rows)))
    quality.fit(docs, labels)
    langid.fit(docs)
    assert max(seen) <= 41


def test_quality_equals_a_plain_scorer(spark, small):
    """Every score against plain arithmetic: the two sizes of a text by the model's dictionaries, through its curve."""
    import zstandard

    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    model = quality.fit(docs, labels)
    packers = []
    for raw in (model.bad, model.good):
        packers.append(zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=False, write_checksum=False, write_dict_id=False))
    rows = {r["doc_id"]: r for r in quality.scored(docs, labels, model).collect()}
    for doc_id, text in [(r["doc_id"], r["text"] or "") for r in docs.limit(60).collect()]:
        raw = text.encode()
        blocks = [raw[i : i + quality.BLOCK] for i in range(0, len(raw), quality.BLOCK)]
        bad, good = (sum(len(p.compress(b)) for b in blocks) for p in packers)
        x = (bad - good) / max(bad, good) if blocks else 0.0
        score = 1 / (1 + np.exp(-(model.slope * x + model.middle))) if model.bad else model.middle
        assert rows[doc_id]["score"] == pytest.approx(score)
        assert rows[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert rows[doc_id]["predicted"] == int(rows[doc_id]["score"] >= 0.5)


def test_few_candidates_and_none(spark):
    rows = [(20 * i, [1.0, float(i)], 0, 1, "x") for i in range(3)]
    assert Counter(r["query_id"] for r in ann.neighbours(vectors(spark, rows)).collect()) == {0: 2, 20: 2, 40: 2}
    assert ann.neighbours(vectors(spark, [])).count() == 0
    assert ann.neighbours(vectors(spark, rows[:1])).count() == 0


def test_hot_lists_are_split_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).tolist(), 0, 1, "x") for i in range(400)]
    whole = {(r["query_id"], r["rank"], r["vec_id"]) for r in ann.neighbours(vectors(spark, rows)).collect()}
    assert {b for _, b, _ in ann.blocks({1: 5, 2: 6, 3: 40, 4: 1}, 100)} == {0}
    monkeypatch.setattr(ann, "PART", 30)
    assert ann.blocks({1: 5, 2: 6, 3: 40, 4: 1, 5: 29, 6: 1}, 30) == [(1, 0, 1), (2, 0, 1), (3, 1, 2), (4, 2, 1), (5, 2, 1), (6, 3, 1)]
    monkeypatch.setattr(ann, "QUERIES", 5)
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in ann.neighbours(vectors(spark, rows)).collect()} == whole


def test_stages_keep_columns_and_clean_documents(spark):
    docs = frame(spark)
    for _, stage in stages.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        assert stage(spark, empty(spark), "").count() == 0
    assert stages.packing_stage(spark, docs, "").count() > 0
    kept = {r["doc_id"] for r in stages.near_duplicate_stage(spark, docs, "").collect()}
    assert {1, 9, 11, 12, 100} <= kept
    assert not {2, 101, 139} & kept
