"""A quality classifier by compression.

Two zstandard dictionaries are built from pieces of good and of bad labelled texts. A text is compressed block by
block with each; the difference of the two sizes, over the larger, is its one feature. A logistic curve fitted on
labelled texts that neither dictionary has seen turns it into a probability of label 1.

Fitting takes at most TRAIN_DOCS ids a label (those with the least hash) and of each id one text, the least, of at most
TRAIN_BYTES bytes.
Label counts over all training rows weigh the curve. Every text is scored whole, block after block.

Defined results for odd input: null and empty texts have no difference and score as the curve has it there; with one
label only, or none, all texts score that label's share (or 0.5); a null label teaches nothing; an id with both
labels counts for both; null ids count as the text 'null' for the held-out rule; repeated rows stay rows; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches
from .words import portions

FOLDS, HELD_OUT = 3, 1
TRAIN_DOCS = 1800
TRAIN_BYTES = 16_000
#: Of the sampled rows, one in so many fits the curve and not the dictionaries.
CURVE = 3
DICTIONARY = 32_768
#: Bytes of a dictionary's sample pieces, and of the blocks that texts are compressed in.
PIECE = 512
BLOCK = 512
LEVEL = 3
RESULT = "doc_id long, held_out boolean, score double, predicted int"


@dataclass
class Model:
    bad: bytes
    good: bytes
    slope: float
    middle: float


def _cut(raw: bytes, size: int) -> list[bytes]:
    return [raw[i : i + size] for i in range(0, len(raw), size)]


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.packers = []
        for raw in (model.bad, model.good):
            known = zstandard.ZstdCompressionDict(raw)
            known.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False))

    def difference(self, text: str | None) -> float:
        blocks = _cut((text or "").encode(), BLOCK)
        bad, good = (sum(len(p.compress(b)) for b in blocks) for p in self.packers)
        return (bad - good) / max(bad, good) if blocks else 0.0

    def score(self, text: str | None) -> float:
        if not self.model.bad:
            return self.model.middle
        return float(1 / (1 + np.exp(-np.clip(self.model.slope * self.difference(text) + self.model.middle, -500, 500))))


def curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the weighted logistic fit, by Newton steps with a little ridge on the slope."""
    design = np.stack([x, np.ones_like(x)], 1)
    beta = np.zeros(2)
    ridge = np.diag([1e-3, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - ridge @ beta
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(bend, slope)
        beta += np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def train(rows: list[tuple[int, str, int]], counts: dict[int, int]) -> Model:
    """rows: (doc_id, text, quality) of the sample; counts: rows by label in all of the training data."""
    total = sum(counts.values())
    constant = Model(b"", b"", 0.0, counts.get(1, 0) / total if total else 0.5)
    fits = [r for r in rows if zlib.crc32(f"curve {r[0]}".encode()) % CURVE == 0]
    learns = [r for r in rows if zlib.crc32(f"curve {r[0]}".encode()) % CURVE != 0]
    pieces = {q: [p for _, t, label in learns if label == q for p in _cut(t.encode(), PIECE)] for q in (0, 1)}
    if min(len(p) for p in pieces.values()) < 8 or len({r[2] for r in fits}) < 2:
        return constant
    try:
        bad, good = (zstandard.train_dictionary(DICTIONARY, pieces[q]).as_bytes() for q in (0, 1))
    except zstandard.ZstdError:  # too little to learn a dictionary from: the pieces themselves serve as one
        bad, good = (b"".join(pieces[q])[:DICTIONARY] for q in (0, 1))
    scorer = Scorer(Model(bad, good, 0.0, 0.0))
    x = np.array([scorer.difference(t) for _, t, _ in fits])
    y = np.array([label for _, _, label in fits], float)
    weight = np.where(y == 1, counts[1] / y.sum(), counts[0] / (1 - y).sum())
    slope, middle = curve(x, y, weight * len(y) / weight.sum())
    return Model(bad, good, slope, middle)


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")) % FOLDS == HELD_OUT


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Trains on the driver, on the bounded sample that the module's docstring states. Two counts cover all training rows."""
    known = labels.select("doc_id", "quality").filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}  # two rows
    texts = docs.select("doc_id", "text").filter(F.octet_length("text") <= TRAIN_BYTES)
    usable = known.join(texts.select("doc_id"), "doc_id").distinct()
    # the least hashes of each label: a sort that keeps TRAIN_DOCS rows a task, not one that gathers a label's rows
    first = [usable.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS) for q in (0, 1)]
    chosen = first[0].unionByName(first[1])
    ids = F.broadcast(chosen.select("doc_id").distinct())
    # one text an id, however often it stands in the table, so TRAIN_DOCS rows a label at most reach the driver
    rows = texts.join(ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).join(F.broadcast(chosen), "doc_id").collect()
    return train(sorted((r["doc_id"], r["text"], r["quality"]) for r in rows), counts)


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value) if model.value.bad else None
        for batch in batches:
            for part in portions(batch, "text"):
                scores = [scorer.score(t) if scorer else model.value.middle for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return run


def scored(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """RESULT of every row of docs."""
    spark = docs.sparkSession
    short_batches(spark)
    shared = spark.sparkContext.broadcast(model or fit(docs, labels))  # two dictionaries
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scored(shared), RESULT)
