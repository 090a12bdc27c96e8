"""Approximate nearest neighbours by balanced posting lists, for the largest inner product.

Vectors are lifted by one coordinate so that the largest inner product is the least distance. A balanced tree over a
bounded sample gives the lists' centroids. Every vector goes to its nearest list, and to others whose centroid is
nearly as near. A query finds near centroids by walking an in-memory graph, and reads the lists whose distance is
within a ratio of the nearest. Long lists and lists with many queries are split, so no task holds a hot list.

Equal vectors are one entry with its least ids: as many as a result can hold, as ties go to the smaller id. The
sample has about SAMPLE vectors or SAMPLE_NUMBERS components at most (those with the least hash); every vector is indexed.
There are as many lists as vectors of LIST fill, up to a quarter of the sample, which bounds the graph in memory; beyond
that many vectors lists grow longer, and recall stays, as the pruning ratio is one of distances.

Defined results for odd input: vectors that are null, zero, of another length than most, or have null or non-finite
components take no part, nor do rows with a null id; a row repeated with its id and vector counts once; with fewer
candidates than k, all are returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

K = 20
EVERY = 20
#: Sampled vectors and numbers at most; vectors meant for a list; lists at most.
SAMPLE, SAMPLE_NUMBERS = 65_536, 4_000_000
LIST = 128
#: Sampled vectors that a list stands for at least.
PER_LIST = 4
#: Links of a centroid, centroids that a walk keeps open at least, nodes it expands at a time.
LINKS, OPEN, EXPAND = 24, 24, 8
#: Vectors that walk at a time: what a walk holds is this times the links that it follows.
WALKERS = 256
#: A vector goes to lists within this ratio of its nearest, and to so many at most.
CLOSURE, COPIES = 1.05, 2
#: The pruning ratio is that which keeps this share of the sample's own neighbours, for so many of the sample as queries; and
#: which lets the same share of those queries keep EACH of their own.
SHARE, TRIALS, EACH = 0.95, 256, 0.9
#: Vectors, components of vectors, and queries that one task takes.
PART, PART_NUMBERS, QUERIES = 32_768, 4_000_000, 4096


@dataclass
class Index:
    """centroids of the lifted space, their graph, the graph's entries, the norm that lifting scales by, the pruning ratio."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray
    norm: float
    ratio: float = 1.0

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Stored vectors: scaled into the unit ball, on whose upper half the last coordinate puts them."""
        x = x / self.norm
        return np.concatenate((x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))), axis=1)

    @staticmethod
    def aim(q: np.ndarray) -> np.ndarray:
        """Queries: their direction, with nothing in the last coordinate."""
        return np.concatenate((q / np.sqrt((q * q).sum(axis=1, keepdims=True)), np.zeros((len(q), 1))), axis=1)

    def walk(self, x: np.ndarray, keep: int, ratio: float) -> np.ndarray:
        """Distances of x to the centroids that the graph walk met; infinite for the others.

        The walk expands the nearest open nodes until the nearest `keep`, and all within ratio of the nearest, are done.
        """
        n, size = len(x), len(self.centroids)
        squares = (self.centroids**2).sum(axis=1)
        far = np.full((n, size), np.inf)
        own = (x * x).sum(axis=1, keepdims=True)
        far[:, self.entries] = np.maximum(0, own - 2 * x @ self.centroids[self.entries].T + squares[self.entries])
        done = np.zeros((n, size), bool)
        keep, some = min(keep, size), min(EXPAND, size)
        while True:
            bound = np.maximum(np.partition(far, keep - 1, axis=1)[:, keep - 1], far.min(axis=1) * ratio**2)
            fresh = np.where(done, np.inf, far)
            pick = np.argpartition(fresh, some - 1, axis=1)[:, :some]
            near = np.take_along_axis(fresh, pick, 1)
            rows, cols = np.nonzero(np.isfinite(near) & (near <= bound[:, None]))
            if not len(rows):
                return np.sqrt(far)
            nodes = pick[rows, cols]
            done[rows, nodes] = True
            rows, nodes = np.repeat(rows, self.links.shape[1]), self.links[nodes].ravel()
            new = np.isinf(far[rows, nodes])
            rows, nodes = rows[new], nodes[new]
            far[rows, nodes] = np.maximum(0, own[rows, 0] - 2 * np.einsum("ij,ij->i", x[rows], self.centroids[nodes]) + squares[nodes])

    def lists(self, x: np.ndarray, ratio: float, most: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of each choice: lists whose distance is within ratio of the nearest, the nearest `most` of them."""
        far = self.walk(x, OPEN, ratio if most is None else 1.0)
        ok = far <= ratio * far.min(axis=1, keepdims=True)
        if most is not None and most < far.shape[1]:
            ok &= far <= np.partition(far, most - 1, axis=1)[:, most - 1 : most]
        return np.nonzero(ok)


def balanced(x: np.ndarray, leaves: int) -> np.ndarray:
    """Centroids of a tree whose nodes are halved at the median along their main direction."""
    groups = [np.arange(len(x))]
    rng = np.random.default_rng(3)
    while len(groups) < leaves:
        halves = []
        for g in groups:
            y = x[g] - x[g].mean(axis=0)
            v = rng.normal(size=x.shape[1])
            for _ in range(6):
                v = y.T @ (y @ v)
                v /= np.linalg.norm(v) + 1e-30
            order = np.argsort(y @ v, kind="stable")
            halves += [g[order[: len(g) // 2]], g[order[len(g) // 2 :]]]
        groups = halves
    return np.stack([x[g].mean(axis=0) for g in groups if len(g)])


def build(sample: np.ndarray, norm: float, total: int) -> Index:
    """sample: distinct vectors; norm: the largest of all; total: distinct vectors in all."""
    index = Index(np.zeros((0, 0)), np.zeros((0, 0), int), np.zeros(0, int), norm)
    lifted = index.lift(sample)
    leaves = 1
    while leaves * 2 * LIST <= total and leaves * 2 <= len(sample) // PER_LIST:
        leaves *= 2
    centroids = balanced(lifted, leaves)
    near = neighbouring(centroids)
    ring = (np.arange(len(centroids))[:, None] + 1) % len(centroids)  # keeps the graph in one piece
    entries = np.arange(0, len(centroids), max(1, len(centroids) // 32))
    index = Index(centroids, np.concatenate((near, ring), axis=1), entries, norm)
    index.ratio = pruning_ratio(index, sample, lifted)
    return index


def neighbouring(centroids: np.ndarray) -> np.ndarray:
    """The LINKS nearest other centroids of each, some rows of the distance table at a time."""
    squares, links, out = (centroids**2).sum(axis=1), min(LINKS, max(1, len(centroids) - 1)), []
    for lo in range(0, len(centroids), WALKERS):
        part = centroids[lo : lo + WALKERS]
        far = squares[lo : lo + WALKERS, None] + squares - 2 * part @ centroids.T
        far[np.arange(len(part)), lo + np.arange(len(part))] = np.inf if len(centroids) > 1 else 0
        pick = np.argpartition(far, links - 1, axis=1)[:, :links]
        out.append(np.take_along_axis(pick, np.argsort(np.take_along_axis(far, pick, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out)


def pruning_ratio(index: Index, sample: np.ndarray, lifted: np.ndarray) -> float:
    """How far beyond the nearest centroid a query must look to meet SHARE of its neighbours in the sample.

    All vectors lie denser than the sample, and a query's true neighbours nearer, so the ratio errs to the safe side.
    """
    trials = sample[np.random.default_rng(5).permutation(len(sample))[:TRIALS]]
    near = np.argsort(-trials @ sample.T, axis=1)[:, 1 : K + 1]
    if not near.size:
        return 1.0
    held, of = np.unique(near, return_inverse=True)  # the sampled vectors that are some trial's neighbours
    of = of.reshape(near.shape)
    chosen = np.full((len(held), COPIES), -1)
    for lo in range(0, len(held), WALKERS):
        rows, lists = index.lists(lifted[held[lo : lo + WALKERS]], CLOSURE, COPIES)
        nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
        chosen[lo + rows[nth < COPIES], nth[nth < COPIES]] = lists[nth < COPIES]
    aimed = index.aim(trials)
    far = np.sqrt(np.maximum(0, (aimed**2).sum(1)[:, None] - 2 * aimed @ index.centroids.T + (index.centroids**2).sum(1)))
    need = [np.where(chosen[of[i]] >= 0, far[i][chosen[of[i]]], np.inf).min(axis=1) / far[i].min() for i in range(len(trials))]
    # enough for all neighbours taken together, and for most queries taken one by one
    each = np.quantile(np.stack(need), EACH, axis=1)
    return float(max(np.quantile(np.concatenate(need), SHARE), np.quantile(each, SHARE))) * (1 + 1e-9)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (doubles) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    finite = "NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')) AND exists(v, x -> x <> 0)"
    rows = rows.filter(F.expr(finite))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("v") == (most["n"] if most else 0))


def entries(rows: DataFrame, k: int = K) -> DataFrame:
    """cid (the least id), v and ids (the k + 1 least) of each distinct vector."""
    first = rows.distinct().withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("nth") <= k + 1)
    return first.groupBy("v").agg(F.min("vec_id").alias("cid"), F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in the order of components."""
    out = np.zeros(len(q))
    for i in range(q.shape[1]):
        out += q[:, i] * v[:, i]
    return out


def _assign(shared):
    """A row for each list that a vector goes to."""

    def run(frames):
        index = shared.value
        for frame in frames:
            for lo in range(0, len(frame), WALKERS):
                part = frame.iloc[lo : lo + WALKERS]
                rows, lists = index.lists(index.lift(_matrix(part["v"])), CLOSURE, COPIES)
                yield pd.DataFrame({"list": lists.astype(np.int32), "cid": part["cid"].to_numpy()[rows], "v": part["v"].to_numpy()[rows]})

    return run


def _choose(shared, block_of: dict[int, int]):
    """A row for each block that holds lists which a query reads, with those lists."""

    def run(frames):
        index = shared.value
        blocks_of = np.full(len(index.centroids), -1, np.int32)
        blocks_of[list(block_of)] = list(block_of.values())
        for frame in frames:
            for lo in range(0, len(frame), WALKERS):
                part = frame.iloc[lo : lo + WALKERS]
                rows, lists = index.lists(index.aim(_matrix(part["v"])), index.ratio, None)
                held = blocks_of[lists] >= 0  # a list that no vector went to has no block
                rows, lists = rows[held], lists[held]
                key = rows.astype(np.int64) << 32 | blocks_of[lists]
                order = np.argsort(key, kind="stable")
                begin = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0))) if len(order) else np.zeros(0, np.int64)
                first = order[begin]
                yield pd.DataFrame({"block": blocks_of[lists[first]], "cid": part["cid"].to_numpy()[rows[first]], "v": part["v"].to_numpy()[rows[first]], "lists": [x.tolist() for x in np.split(lists[order].astype(np.int32), begin[1:])] if len(first) else []})

    return run


def _best(k: int):
    def run(queries: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        """The k + 1 best of a block of lists for each query of a block; of each list only for queries that chose it."""
        if not len(queries) or not len(stored):
            return pd.DataFrame({"qcid": [], "cid": [], "score": []}).astype({"qcid": "int64", "cid": "int64"})
        stored = stored.sort_values(["list", "cid"], kind="stable")
        v, ids, lists = _matrix(stored["v"]), stored["cid"].to_numpy(), stored["list"].to_numpy()
        edges = np.flatnonzero(np.concatenate(([True], lists[1:] != lists[:-1], [True])))
        keep = COPIES * (k + 1)  # a vector may stand in so many lists
        length = np.sqrt((v * v).sum(axis=1).max())
        out = []
        for lo in range(0, len(queries), WALKERS // 4):
            part = queries.iloc[lo : lo + WALKERS // 4]
            q, wanted = _matrix(part["v"]), [set(x) for x in part["lists"]]
            rough = np.full((len(q), len(v)), -np.inf)
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                rows = [n for n, w in enumerate(wanted) if lists[i] in w]
                rough[rows, i:j] = q[rows] @ v[i:j].T
            for n in range(len(q)):
                read = np.flatnonzero(np.isfinite(rough[n]))
                if len(read) > keep:  # all that could be among the best once scores are exact: ties and rounding too
                    least = np.partition(rough[n][read], len(read) - keep)[len(read) - keep]
                    read = read[rough[n][read] >= least - 1e-9 * length * np.sqrt(q[n] @ q[n])]
                score = exact(np.broadcast_to(q[n], (len(read), q.shape[1])), v[read])
                best = np.lexsort((ids[read], -score))[:keep]
                out.append((np.full(len(best), part["cid"].to_numpy()[n]), ids[read[best]], score[best]))
        found = pd.DataFrame(dict(zip(("qcid", "cid", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True))).drop_duplicates(["qcid", "cid"]).sort_values(["qcid", "score", "cid"], ascending=[True, False, True])
        return found.groupby("qcid", sort=False).head(k + 1)

    return run


def blocks(sizes: dict[int, int], most: int) -> list[tuple[int, int, int]]:
    """(list, block, parts): lists of neighbouring centroids share a block of up to `most` vectors; a longer list is a block
    in so many parts. One row a list."""
    out, block, room = [], -1, 0
    for number in sorted(sizes):
        if sizes[number] > room:
            block, room = block + 1, most
        out.append((number, block, -(-sizes[number] // most)))
        room -= sizes[number]
    return out


def fit(distinct: DataFrame) -> Index | None:
    """The index's centroids, from the bounded sample."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    total, dims, largest = distinct.agg(F.count("*"), F.max(F.size("v")), F.max(norm)).first()
    if not total:
        return None
    share = min(SAMPLE, max(64, SAMPLE_NUMBERS // dims)) / total
    # by a bound on the hash and not by a sort, whose parts would all meet in one task
    chosen = distinct if share >= 1 else distinct.filter(F.pmod(F.xxhash64("cid"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = chosen.select("v", "cid").toArrow().sort_by("cid").combine_chunks()
    return build(sample.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dims), largest, total)


def neighbours(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row whose vec_id is divisible by every."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    distinct = saved(entries(rows, k), "vectors")
    index = fit(distinct)
    schema = "query_id long, rank int, vec_id long, score double"
    if index is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(index)  # a quarter of the sample at most
    asking = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "v").distinct()
    asking = asking.join(distinct.select("v", "cid"), "v").select("vec_id", "cid")
    asked = distinct.join(asking.select("cid").distinct(), "cid", "left_semi").select("cid", "v")
    stored = saved(distinct.select("cid", "v").mapInPandas(_assign(shared), "list int, cid long, v array<double>"), "postings")
    # one row a list, and one a block: a quarter of the sample at most
    dims = index.centroids.shape[1]
    plan = blocks({r["list"]: r["count"] for r in stored.groupBy("list").count().collect()}, max(1, min(PART, PART_NUMBERS // dims)))
    parts = {block: n for _, block, n in plan}
    chosen = saved(asked.mapInPandas(_choose(shared, {number: block for number, block, _ in plan}), "block int, cid long, v array<double>, lists array<int>"), "asked")
    turns = [(r["block"], parts[r["block"]], -(-r["count"] // QUERIES)) for r in chosen.groupBy("block").count().collect()]
    turns = F.broadcast(spark.createDataFrame(turns, "block int, parts long, turns long"))
    left = chosen.join(turns, "block").withColumn("turn", F.expr("pmod(xxhash64(cid), turns)")).withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)")))
    of = F.broadcast(spark.createDataFrame([(number, block) for number, block, _ in plan], "list int, block int"))
    right = stored.join(of, "list").join(turns, "block").withColumn("part", F.expr("pmod(xxhash64(cid), parts)")).withColumn("turn", F.explode(F.expr("sequence(0L, turns - 1)")))
    keys = ["block", "part", "turn"]
    # both sides come from one plan: fresh columns keep them apart
    left = left.select(*[F.col(c).alias(c) for c in [*keys, "cid", "v", "lists"]])
    right = right.select(*[F.col(c).alias(c) for c in [*keys, "cid", "v", "list"]])
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_best(k), "qcid long, cid long, score double")
    found = found.groupBy("qcid", "cid").agg(F.max("score").alias("score"))
    by_query = Window.partitionBy("qcid").orderBy(F.desc("score"), "cid")
    found = found.withColumn("nth", F.row_number().over(by_query)).filter(F.col("nth") <= k + 1).drop("nth")
    found = found.join(distinct.select("cid", "ids"), "cid").select("qcid", "score", F.explode("ids").alias("id"))
    found = found.withColumn("nth", F.row_number().over(Window.partitionBy("qcid").orderBy(F.desc("score"), "id"))).filter(F.col("nth") <= k + 1).drop("nth")
    answers = asking.join(found, F.col("cid") == F.col("qcid")).filter("vec_id <> id")
    rank = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.desc("score"), "id"))
    return answers.select(F.col("vec_id").alias("query_id"), rank.cast("int").alias("rank"), F.col("id").alias("vec_id"), "score").filter(F.col("rank") <= k)
