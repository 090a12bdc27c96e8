"""Language identification by a linear-chain conditional random field over words.

Each word has affix, byte n-gram and lexicon features, hashed into one weight table; transitions between the languages
of neighbouring words are learned too. Forward-backward gives every word's language probabilities, so code-switched
texts are labelled word by word; a document's language is the one with the greatest mean probability.

Training takes at most TRAIN_DOCS documents a language (those with the least hash of their id) of at most TRAIN_BYTES
bytes, cut into stretches, with stretches of different languages put in one sequence so that switches are seen. All
documents are predicted over their whole text, whatever its length.

Defined results for odd input: a null text, or one without a letter, is `und` with score 0; without any training row
every text is `und`; rows with a null lang are predicted but not learned from; null ids count as the text 'null' for
the held-out rule; repeated rows stay rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import boxed, short_batches
from .words import mix, portions, spans_hash, word_bounds

FOLDS = 5
TRAIN_DOCS = 300
TRAIN_BYTES = 16_000
#: Weight rows (a power of two), words in a training stretch, sequences in a training step, steps, learning rate.
TABLE = 1 << 17
STRETCH = 20
SEQUENCES = 32
STEPS = 250
RATE = 0.2
DECAY = 1e-4
#: Words in a block of the forward-backward pass.
BLOCK = 128
#: Steps after which vectors are scaled anew.
SCALE = 4
AFFIXES = (1, 2, 3, 4)
GRAM = 3
LETTER = re.compile("[A-Za-z]")
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass
class Text:
    """Words of several rows: the rows' bounds among the words, and the words' feature places."""

    at: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def parsed(texts: list[str]) -> Text:
    """texts, lower-cased, in one buffer; a space stands before, between and after them."""
    raw = [t.lower().encode() for t in texts]
    data = np.frombuffer(b"    " + b" ".join(raw) + b"    ", np.uint8).copy()
    bounds = np.cumsum([4] + [len(r) + 1 for r in raw])
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
    data[(data >= 9) & (data <= 13)] = 0x20
    return Text(np.searchsorted(starts, bounds), data, starts, ends)


def _place(value: np.ndarray, tag: int) -> np.ndarray:
    return (mix(value ^ np.uint64(tag << 56)) >> np.uint64(64 - TABLE.bit_length() + 1)).astype(np.int32)


def gram_places(data: np.ndarray) -> np.ndarray:
    """The weight row of the GRAM bytes that start at each byte but the last GRAM - 1."""
    value = data[: len(data) - GRAM + 1].astype(np.uint32)
    for i in range(1, GRAM):
        value |= data[i : len(data) - GRAM + 1 + i].astype(np.uint32) << np.uint32(8 * i)
    value *= np.uint32(2654435761)
    value >>= np.uint32(32 - TABLE.bit_length() + 1)
    return value.astype(np.int32)


def word_places(text: Text) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """Weight rows of the features that a word has once: itself and its affixes (with a mask: words that long)."""
    lengths = text.ends - text.starts
    out: list[tuple[np.ndarray, np.ndarray | None]] = [(_place(spans_hash(text.data, text.starts, text.ends), 40), None)]
    for k in AFFIXES:
        has = lengths >= k
        for tag, first in ((20 + k, text.starts), (30 + k, text.ends - k)):
            value = np.zeros(len(lengths), np.uint64)
            for i in range(k):
                value |= text.data[first + i].astype(np.uint64) << np.uint64(8 * i)
            out.append((_place(value, tag), has))
    return out


def gram_bounds(text: Text) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a word start from the space before it to where they take in the space after it."""
    first = text.starts - 1
    return first, np.maximum(text.ends + 2 - GRAM, first + 1)


def emissions(text: Text, weights: np.ndarray) -> np.ndarray:
    """Words x languages: the sum of the words' feature weights. weights: languages x TABLE."""
    langs = len(weights)
    out = np.zeros((len(text.starts), langs))
    for places, has in word_places(text):
        for j in range(langs):
            w = weights[j][places]
            out[:, j] += w if has is None else np.where(has, w, 0)
    places = gram_places(text.data)
    bounds = np.stack(gram_bounds(text), 1).ravel()
    for j in range(langs):
        out[:, j] += np.add.reduceat(weights[j][places], bounds)[::2] if len(bounds) else 0
    return out


def marginals(scores: np.ndarray, at: np.ndarray, switch: np.ndarray) -> np.ndarray:
    """Each word's language probabilities by forward-backward. at: the rows' bounds; switch: log weights of transitions.

    Rows are cut into blocks of BLOCK words. The blocks' transfer matrices are multiplied out side by side, chained
    along each row, and give every block the vectors that enter it from both ends; so the result is exact and the
    number of steps doesn't depend on the longest row.
    """
    n, langs = scores.shape
    if n == 0:
        return scores
    psi = np.exp(switch)
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    counts = -(-np.diff(at) // BLOCK)
    total = int(counts.sum())
    row = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = at[row] + nth * BLOCK
    length = np.minimum(at[row + 1] - begin, BLOCK)
    order = np.argsort(length, kind="stable")
    begin, length = begin[order], length[order]
    place = np.empty(total, np.int64)
    place[order] = np.arange(total)
    steps = int(length[-1])
    lows = np.searchsorted(length, np.arange(steps + 1), side="right")  # blocks from here on have that word

    # side by side: word t of every block
    block = np.repeat(place, length[place])
    step = np.arange(n) - begin[block]
    wide = np.ones((steps, total, langs))
    wide[step, block] = e
    m = np.broadcast_to(np.eye(langs), (total, langs, langs)).copy()
    for t in range(steps if counts.max() > 1 else 0):
        lo = lows[t]
        x = (m[lo:].reshape(-1, langs) @ psi).reshape(-1, langs, langs)
        x *= wide[t, lo:, None, :]
        if t % SCALE == 0:
            x /= x.max(axis=(1, 2), keepdims=True)
        m[lo:] = x
    entering = np.full((total, langs), 1.0 / langs)
    leaving = np.ones((total, langs))
    most = int(counts.max())
    first = np.cumsum(counts) - counts
    for k in range(1, most):
        rows = np.flatnonzero(counts > k)
        here, before = place[first[rows] + k], place[first[rows] + k - 1]
        v = np.einsum("bi,bij->bj", entering[before], m[before])
        entering[here] = v / v.sum(axis=1, keepdims=True)
        here, after = place[first[rows] + counts[rows] - 1 - k], place[first[rows] + counts[rows] - k]
        v = np.einsum("bij,bj->bi", m[after], leaving[after])
        leaving[here] = v / v.sum(axis=1, keepdims=True)
    ahead = np.empty_like(wide)
    v = entering
    for t in range(steps):
        lo = lows[t]
        x = np.matmul(v[lo:], psi, out=ahead[t, lo:])
        x *= wide[t, lo:]
        if t % SCALE == 0:
            x /= x.sum(axis=1, keepdims=True)
        v = ahead[t]
    v = leaving
    for t in range(steps - 1, -1, -1):
        lo = lows[t]
        ahead[t, lo:] *= v[lo:]
        x = (wide[t, lo:] * v[lo:]) @ psi.T
        if t % SCALE == 0:
            x /= x.sum(axis=1, keepdims=True)
        v[lo:] = x
    out = ahead[step, block]
    return out / out.sum(axis=1, keepdims=True)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray
    switch: np.ndarray


def train(rows: list[tuple[str, str]]) -> Model:
    """rows: (text, lang). Stochastic gradient steps on the sequences' log likelihood, with step sizes by Adagrad."""
    langs = sorted({lang for _, lang in rows})
    count = len(langs)
    weights, switch = np.zeros((count, TABLE)), np.zeros((count, count))
    if count < 2:
        return Model(langs, weights.astype(np.float32), switch)
    text = parsed([t for t, _ in rows])
    label = np.repeat([langs.index(lang) for _, lang in rows], np.diff(text.at))
    once = word_places(text)
    grams = [(gram_places(text.data), *gram_bounds(text))]
    stretches: list[list[int]] = [[] for _ in langs]
    for (lo, hi), (_, lang) in zip(zip(text.at, text.at[1:]), rows, strict=False):
        stretches[langs.index(lang)] += range(lo, hi - STRETCH + 1, STRETCH)
    usable = [j for j in range(count) if stretches[j]]
    if not usable:
        return Model(langs, weights.astype(np.float32), switch)
    rng = np.random.default_rng(11)
    squares, switch_squares = np.full((count, TABLE), 1e-6), np.full((count, count), 1e-6)
    for _ in range(STEPS):
        picks = np.array([[rng.choice(stretches[j]) for j in rng.choice(usable, 3)] for _ in range(SEQUENCES)])
        words = (picks[:, :, None] + np.arange(STRETCH)).reshape(SEQUENCES, -1)
        flat = words.ravel()
        place, owner = [], []
        for places, has in once:
            keep = np.arange(len(flat)) if has is None else np.flatnonzero(has[flat])
            place.append(places[flat[keep]])
            owner.append(keep)
        for places, lo, hi in grams:
            width = hi[flat] - lo[flat]
            own = np.repeat(np.arange(len(flat)), width)
            place.append(places[lo[flat][own] + np.arange(len(own)) - np.repeat(np.cumsum(width) - width, width)])
            owner.append(own)
        place, owner = np.concatenate(place), np.concatenate(owner)
        scores = np.stack([np.bincount(owner, weights[j][place], len(flat)) for j in range(count)], 1).reshape(SEQUENCES, -1, count)
        truth = np.eye(count)[label[words]]
        wrong, switch_wrong = _gradients(scores, truth, switch)
        used, inverse = np.unique(place, return_inverse=True)
        step = wrong.reshape(-1, count)
        for j in range(count):
            g = np.bincount(inverse, step[owner, j], len(used)) + DECAY * weights[j][used]
            squares[j][used] += g * g
            weights[j][used] -= RATE * g / np.sqrt(squares[j][used])
        switch_squares += switch_wrong**2
        switch -= RATE * switch_wrong / np.sqrt(switch_squares)
    return Model(langs, weights.astype(np.float32), switch)


def _gradients(scores: np.ndarray, truth: np.ndarray, switch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the negative log likelihood, by word and language and by transition; sequences x words x languages."""
    psi = np.exp(switch)
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    size, steps, count = e.shape
    ahead, back = np.empty_like(e), np.ones_like(e)
    v = np.full((size, count), 1.0 / count)
    for t in range(steps):
        v = (v @ psi) * e[:, t]
        v /= v.sum(axis=1, keepdims=True)
        ahead[:, t] = v
    for t in range(steps - 2, -1, -1):
        v = (e[:, t + 1] * back[:, t + 1]) @ psi.T
        back[:, t] = v / v.sum(axis=1, keepdims=True)
    marg = ahead * back
    marg /= marg.sum(axis=2, keepdims=True)
    pair = ahead[:, :-1, :, None] * psi * (e[:, 1:] * back[:, 1:])[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    seen = np.einsum("bti,btj->ij", truth[:, :-1], truth[:, 1:])
    return marg - truth, (pair.sum(axis=(0, 1)) - seen) / size


def predicted(texts: list[str], model: Model) -> list[tuple[str, float]]:
    """(language, score) of each text."""
    has = [bool(LETTER.search(t)) or any(c.isalpha() for c in t) for t in texts]
    if not model.langs:
        return [("und", 0.0)] * len(texts)
    text = parsed(texts)
    by_word = marginals(emissions(text, model.weights), text.at, model.switch)
    letters = np.cumsum(np.concatenate(([0], (text.data >= 0x61) & (text.data <= 0x7A) | (text.data >= 0x80))))
    weight = np.minimum(letters[text.ends] - letters[text.starts], 1).astype(float) + 1e-9
    run = np.concatenate((np.zeros((1, len(model.langs))), np.cumsum(by_word * weight[:, None], axis=0)))
    sums = run[text.at[1:]] - run[text.at[:-1]]
    out = []
    for ok, s in zip(has, sums, strict=True):
        if not ok:
            out.append(("und", 0.0))
        else:
            j = int(s.argmax())
            out.append((model.langs[j], float(min(1.0, max(0.0, s[j] / s.sum())))))
    return out


def held_out(folds: int, fold: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")) % folds == fold


def fit(docs: DataFrame) -> Model:
    """Trains on the driver, on the bounded sample that the module's docstring states."""
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(FOLDS, 0) & (F.octet_length("text") <= TRAIN_BYTES))
    ranked = known.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
    chosen = ranked.filter(F.col("nth") <= TRAIN_DOCS).select("doc_id", "lang").distinct()
    # one text an id and language, however often it stands in the table, so TRAIN_DOCS rows a language at most reach the driver
    rows = known.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    return train([(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], r["doc_id"]))])


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for part in portions(batch, "text", 1 << 20):
                got = predicted(pc.fill_null(part.column("text"), "").to_pylist(), m)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], [c.split()[0] for c in RESULT.split(", ")])

    return run


def labelled(docs: DataFrame, model: Model) -> DataFrame:
    """docs, boxed, with lang_pred and lang_score; the texts pass through the workers once and aren't joined."""
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = boxed(docs)
    fields = [*rows.schema, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]
    return rows.mapInArrow(_labelled(shared), T.StructType(fields))


def _labelled(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "box_text", 1 << 20):
                got = predicted(pc.fill_null(part.column("box_text"), "").to_pylist(), model.value)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], [*part.schema.names, "lang_pred", "lang_score"])

    return run


def languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """RESULT of every row of docs."""
    spark = docs.sparkSession
    short_batches(spark)
    shared = spark.sparkContext.broadcast(model or fit(docs))  # TABLE weights a language
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(FOLDS, 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scored(shared), RESULT)
