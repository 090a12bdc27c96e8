"""Product codes and whitening against plain Python; op11 has SQL as well (test_llm_oracles)."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from grantlens.llm import vacode, vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x int, w int, task int, box_v string"
NAN, INF = float("nan"), float("inf")


def rows(n=700, dims=8, seed=1, odd=True):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(9)]
    out = [(i * 3 % n, [float(np.float32(c + rng.gauss(0, 0.1))) for c in rng.choice(centres)], rng.choice([0, 1, 1, 1, None])) for i in range(n)]
    if odd:
        out += [out[5], out[5], (None, out[7][1], 2), (None, [0.0] * dims, None), (out[9][0], out[11][1], 1)]
        out += [(9001, None, 1), (9002, [], 1), (9003, [0.5] * (dims - 1), 1), (9004, [None] + [0.5] * (dims - 1), 1), (9005, [NAN] + [0.5] * (dims - 1), 1), (9006, [INF] * dims, 1), (9007, [-INF] + [0.5] * (dims - 1), 2), (9008, [3e38] * dims, 1)]
        out += [(9100 + i, [0.25] * dims, 5) for i in range(60)]
    return out


def frame(spark, data):
    return spark.createDataFrame([(i, v, s, "c", 1, 2, 3, "z") for i, v, s in data], SCHEMA)


def usable(data, dims=8):
    return [(i, [math.floor(1024 * c) for c in v], s) for i, v, s in data if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) and abs(c) < 1e9 for c in v)]


def plain_codes(kept, dims=8, rounds=4):
    size = dims // 4
    least = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:256]
    books = [[r[1][p * size : (p + 1) * size] for r in least] for p in range(4)]

    def near(book, part):
        best = min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(book[e], part, strict=True)), e))
        return best, sum((a - b) ** 2 for a, b in zip(book[best], part, strict=True))

    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for _, x, _ in kept:
                part = x[p * size : (p + 1) * size]
                groups.setdefault(near(books[p], part)[0], []).append(part)
            for e, parts in groups.items():
                books[p][e] = [sum(c) // len(parts) for c in zip(*parts, strict=True)]
    out = []
    for i, x, s in kept:
        found = [near(books[p], x[p * size : (p + 1) * size]) for p in range(4)]
        out.append((i, s, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found)))
    sums = {}
    for _, s, _, d in out:
        sums[s] = sums.get(s, 0) + d
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(i, code, d, sums[s], digest) for i, s, code, d in out]


@pytest.mark.parametrize("n", [700, 40])
def test_codes_equal_a_plain_search(spark, n):
    data = rows(n)
    found = vacode.report(*vacode.compressed(frame(spark, data)))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(plain_codes(usable(data)), key=repr)


def test_cells_bound_every_distance_and_leave_few():
    rng = np.random.default_rng(2)
    for spread, n in ((300, 256), (3, 256), (300, 5), (1, 1)):
        book, parts = rng.integers(-spread, spread, (n, 16)), rng.integers(-spread - 9, spread + 9, (900, 16))
        file = vacode.Cells.of(book)
        lower, upper = file.bounds(parts)
        exact = ((book[:, None] - parts[None]) ** 2).sum(axis=2)
        assert (lower <= exact).all() and (exact <= upper).all()
        best, away = file.nearest(parts)
        assert (best == exact.argmin(axis=0)).all() and (away == exact.min(axis=0)).all()
        if spread == 300 and n == 256:
            assert (lower <= upper.min(axis=0)).mean() < 0.3  # what is refined


def test_codes_decode_to_their_entries(spark):
    data = rows(odd=False)
    codes, books = vacode.compressed(frame(spark, data))
    x = {i: v for i, v, _ in usable(data)}
    for r in vacode.decoded(codes, books).collect():
        assert sum((a - b) ** 2 for a, b in zip(x[r["vec_id"]], r["approx"], strict=True)) == r["error"]


def test_lengths_that_parts_do_not_divide_are_filled_up(spark):
    data = rows(50, dims=6, odd=False)
    filled = [(i, [*v, 0.0, 0.0], s) for i, v, s in data]
    assert sorted(map(tuple, vacode.report(*vacode.compressed(frame(spark, data))).collect())) == sorted(plain_codes(usable(filled)))


def test_no_vectors_no_rows(spark):
    for data in ([], [(1, None, 1), (2, [], 1), (3, [NAN], 1)]):
        assert vacode.report(*vacode.compressed(frame(spark, data))).collect() == []
        assert whitening.report(frame(spark, data)).collect() == []


def shifted(data, dims=8):
    return [(i, [c + 100_000 for c in x]) for i, x, _ in usable(data, dims)]


def plain_covariance(kept):
    n, dims = len(kept), len(kept[0][1])
    sums = [sum(x[d] for _, x in kept) for d in range(dims)]
    return n, sums, [[sum((x[i] - Fraction(sums[i], n)) * (x[j] - Fraction(sums[j], n)) for _, x in kept) / n for j in range(dims)] for i in range(dims)]


def test_covariance_is_exact_beyond_doubles(spark):
    data = rows(300)
    n, sums, want = plain_covariance(shifted(data))
    x = vectors.whole(frame(spark, data), whitening.LIMIT, whitening.SHIFT).repartition(7)
    mean = whitening.mean_of(x)
    assert (mean.n, mean.sums) == (n, sums)
    high, low = whitening.covariance(x, mean)
    for i in range(8):
        for j in range(8):
            got = Fraction(float(high[i, j])) + Fraction(float(low[i, j]))
            assert abs(got - want[i][j]) <= abs(want[i][j]) * Fraction(1, 10**28) + Fraction(1, 10**24)


def test_parts_merge_over_many_tasks(spark, monkeypatch):
    data = rows(300)
    monkeypatch.setattr(whitening, "FAN", 3)
    monkeypatch.setattr(whitening, "PAIRS", 10)  # blocks of pairs, too
    x = vectors.whole(frame(spark, data), whitening.LIMIT, whitening.SHIFT).repartition(29)
    mean = whitening.mean_of(x)
    high, low = whitening.covariance(x, mean)
    _, _, want = plain_covariance(shifted(data))
    assert all(abs(Fraction(float(high[i, j])) + Fraction(float(low[i, j])) - want[i][j]) < Fraction(1, 10**20) for i in range(8) for j in range(8))


def test_whitened_rows(spark):
    data = rows(300)
    kept = shifted(data)
    n, sums, cov = plain_covariance(kept)
    values, axes = np.linalg.eigh(np.array([[float(c) for c in r] for r in cov]))
    values, axes = values[::-1], axes[:, ::-1]
    found = whitening.report(frame(spark, data)).collect()
    assert len(found) == len(kept) * 8
    by = {}
    for r in found:
        by.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    signs = {}
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        for k in range(8):
            r = by[i, deviation][k + 1][0]
            want = float(sum((c - Fraction(s, n)) * Fraction(float(a)) for c, s, a in zip(x, sums, axes[:, k], strict=True))) / math.sqrt(values[k])
            sign = signs.setdefault(k, 1 if want * r["whitened"] > 0 else -1)
            assert abs(sign * r["whitened"] - want) < 1e-7
            assert abs(r["explained"] - values[k] / values.sum()) < 1e-9
            assert r["n"] == n and 0 <= r["identity_error"] < 1e-9


def test_components_without_variance(spark):
    flat = [(i, [0.5, float(i), 2.0 * i], 0) for i in range(20)]  # one direction in three dimensions
    found = whitening.report(frame(spark, flat)).collect()
    assert len(found) == 60
    for r in found:
        if r["component"] > 1:
            assert r["whitened"] == 0 and r["explained"] == 0
        assert r["identity_error"] < 1e-9
    assert {(r["whitened"], r["explained"], r["identity_error"]) for r in whitening.report(frame(spark, [(1, [0.5, 1.0], 0)])).collect()} == {(0.0, 0.0, 0.0)}


def test_near_equal_eigenvalues_are_refined():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    want = np.array([5, 5 - 1e-7, 4, 3, 2, 1, 1e-3, 1e-4, 1e-5, 1e-6, 1e-7, 1e-8])
    exact = (q.astype(np.longdouble) * want) @ q.T.astype(np.longdouble)
    high = exact.astype(np.float64)
    values, x = whitening.eigen((high + high.T) / 2, ((exact - high) + (exact - high).T).astype(np.float64) / 2)
    assert np.abs(values - want).max() < 1e-14
    assert np.abs(x.T @ x - np.eye(12)).max() < 1e-15


def test_deviations_beyond_64_bits():
    mean = whitening.Mean(10**6, [0, 0])
    assert whitening.deviations(np.array([[3, 4], [10**6, 0]]), mean) == [25 * 10**12, None if 10**24 >= 1 << 63 else 10**24]
