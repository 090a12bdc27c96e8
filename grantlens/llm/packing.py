"""Packing along a space-filling curve.

A document becomes a hashed vector of its byte four-grams, the vector is projected to DIMS dimensions, and the cell it
falls in has a place on a Hilbert curve. Documents are range-sorted by that place, and each range is cut into
sequences of SEQUENCE tokens as it streams by, so neighbours on the curve share sequences. A range's last tokens make
sequences of power-of-two lengths, which need no padding, so nothing is padded at any number of ranges.

The order's low bits come from a hash of the id: copies, which share a cell, can be split over ranges.

Defined results for odd input: a null or empty text is the end token alone; null ids are documents of their own;
repeated rows are packed as often as they come; an empty table gives an empty result; a text may be longer than many
sequences; the string of a special token in a text is that token, as in the vocabulary's own file; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches
from .words import mix, portions, text_bytes

SEQUENCE = 2048
END = 1
#: Buckets of the hashed vector, dimensions of the projection, bits of each on the curve, bits for the id's hash.
BUCKETS = 4096
DIMS = 4
BITS = 12
ID_BITS = 15
#: Sequences of one range are numbered from its number times this.
RANGE_SEQUENCES = 1 << 40
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=1)
def projection() -> np.ndarray:
    """BUCKETS x DIMS, of signs."""
    return np.random.default_rng(7).choice(np.array([-1.0, 1.0]), (BUCKETS, DIMS))


def vectors(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each row's hashed byte four-grams, projected to DIMS and scaled to unit variance for unrelated grams."""
    n = len(at) - 1
    out = np.zeros((n, DIMS))
    if len(data) < 4:
        return out
    d = data.astype(np.uint32)
    gram = d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16) | d[3:] << np.uint32(24)
    bucket = (gram * np.uint32(2654435761)) >> np.uint32(20)
    for i in range(n):
        lo, hi = at[i], at[i + 1] - 3
        if hi > lo:
            counts = np.sqrt(np.bincount(bucket[lo:hi], minlength=BUCKETS))
            out[i] = counts @ projection() / np.sqrt(counts @ counts)
    return out


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (rows of DIMS unsigned numbers under 2**bits), by Skilling's transform."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            on = (x[:, i] & q) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(on, p, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[:, -1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    place = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            place = (place << 1) | ((x[:, i] >> b) & 1)
    return place


def places(vecs: np.ndarray) -> np.ndarray:
    """The curve's place of each projected vector; coordinates are spread by their rank in a logistic curve."""
    unit = 1 / (1 + np.exp(-1.7 * vecs))
    cells = np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
    return hilbert(cells, BITS)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in portions(batch, "text"):
            place = places(vectors(*text_bytes(part.column("text"))))
            ids = part.column("doc_id")
            low = mix(np.nan_to_num(ids.to_numpy(zero_copy_only=False)).astype(np.int64).view(np.uint64)) >> np.uint64(64 - ID_BITS)
            key = (place << ID_BITS) | low.astype(np.int64)
            yield pa.RecordBatch.from_arrays([ids, part.column("text"), pa.array(key)], ["doc_id", "text", "place"])


def along_curve(docs: DataFrame) -> DataFrame:
    """doc_id, text, place: range-parted and sorted by place."""
    short_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.mapInArrow(_keyed, "doc_id long, text string, place long")
    return keyed.repartitionByRange("place").sortWithinPartitions("place", "doc_id")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(path: str):
    """The vocabulary of byte_bpe_50k.json, its special tokens too, in the library that encodes it fastest; the ids are the same."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(enc, text: str) -> np.ndarray:
    return enc.encode_to_numpy(text, allowed_special="all")


class Packer:
    """Cuts a stream of documents into pieces of sequences. Holds no more than one sequence's open pieces."""

    def __init__(self, first: int) -> None:
        self.sequence, self.offset, self.rows = first, 0, []
        self.open: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        n, start = len(ids), 0
        while start < n:
            length = min(n - start, SEQUENCE - self.offset)
            self.open.append((doc_id, start, ids[start : start + length], n, self.offset))
            start += length
            self.offset += length
            if self.offset == SEQUENCE:
                self.close()

    def close(self) -> None:
        for doc_id, start, ids, n, offset in self.open:
            self.rows.append((doc_id, start, len(ids), ids_crc(ids), n, self.sequence, offset))
        self.open, self.offset = [], 0
        self.sequence += 1

    def finish(self) -> None:
        """The last tokens: sequences of the powers of two that add up to their number."""
        rest, self.open, self.offset = self.open, [], 0
        left = sum(len(p[2]) for p in rest)
        room = 1 << (left.bit_length() - 1) if left else 0
        for doc_id, start, ids, n, _ in rest:
            at = 0
            while at < len(ids):
                length = min(len(ids) - at, room - self.offset)
                self.open.append((doc_id, start + at, ids[at : at + length], n, self.offset))
                at += length
                self.offset += length
                left -= length
                if self.offset == room:
                    self.close()
                    room = 1 << (left.bit_length() - 1) if left else 0


def ids_crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names)


def _packed(path: str, special: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, end = encoder(path), np.array([special], np.uint32)
        packer = Packer(TaskContext.get().partitionId() * RANGE_SEQUENCES)
        known: tuple[bytes, np.ndarray] | None = None
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = text or ""
                mark = xxhash.xxh128_digest(text)
                if known is None or known[0] != mark:  # copies follow one another
                    known = mark, np.concatenate((token_ids(enc, text), end)).astype(np.uint32, copy=False)
                packer.add(doc_id, known[1])
            if packer.rows:
                yield _batch(packer.rows)
                packer.rows = []
        packer.finish()
        if packer.rows:
            yield _batch(packer.rows)

    return run


def packed(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The pieces of all documents: see PIECES. vocabulary: the path of the rank file, the same on every executor."""
    return along_curve(docs).mapInArrow(_packed(vocabulary or ranks_path(), END), PIECES)
