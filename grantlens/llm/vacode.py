"""Vector code compression: product codes whose nearest entries are found by VA-file filtering.

Vectors are cut into PARTS equal parts; each part position has a codebook of ENTRIES entries. To find a part's nearest
entry, the entries' coordinates are quantised to BITS bits: a dimension's cells each span the entry coordinates that fall
in them. A part looks up, for every dimension and cell, the least and the largest squared distance to the cell, in a
table made once for that part; sums of look-ups bound the distance to every entry from below and above. Only entries
whose lower bound reaches the least upper bound are refined with whole-number distances, so ties stay exact.

A round of training is one pass: each task assigns its parts and sums them by entry, partial sums of all tasks meet in
one aggregate by entry, and the new codebooks (PARTS * ENTRIES entries at any data size) go out again.

Defined results for odd input: vectors that are null, empty, of another length than most, or that hold null or
non-finite components take no part, nor do those with components beyond LIMIT, whose squared distances could leave 64
bits; a length that PARTS doesn't divide is filled up with zeros; null ids come last in the order of ids and keep their
rows; repeated ids are ordered by their vectors; with fewer rows than ENTRIES there are as many entries; repeated rows
are coded as often as they come; an empty table gives an empty result; a missing label column counts as null labels;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .vectors import matrix, whole

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Bits of a quantised coordinate.
BITS = 4
#: Largest component: with SCALE, squared distances of a part stay exact in 64 bits up to 32 dimensions a part of such size.
LIMIT = float(1 << 18)
#: Parts that look up their bounds at a time.
BLOCK = 512
#: Rows of one label are spread over so many groups where they meet their label's sum.
SALTS = 64


@dataclass
class Cells:
    """One codebook as a VA-file: entries, each coordinate's cell, and the span of entry coordinates in every cell."""

    entries: np.ndarray
    cells: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray, bits: int = BITS) -> Cells:
        """Cells are cut at even ranks of the coordinates; a cell that holds none repeats its neighbour's span."""
        n, dims = entries.shape
        many = min(1 << bits, n)
        ranked = np.sort(entries, axis=0)
        edges = ranked[(np.arange(many) * n) // many]  # the least coordinate of each cell
        cells = np.empty((n, dims), np.int64)
        low, high = np.empty((many, dims), np.int64), np.empty((many, dims), np.int64)
        for d in range(dims):
            cells[:, d] = np.searchsorted(edges[:, d], entries[:, d], side="right") - 1
            ends = np.searchsorted(cells[:, d], np.arange(many), side="right", sorter=np.argsort(cells[:, d], kind="stable"))
            high[:, d] = ranked[np.maximum(ends, 1) - 1, d]
            low[:, d] = np.minimum(edges[:, d], high[:, d])
        return cls(entries, cells, low, high)

    def bounds(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of squared distances, entries by parts, from the look-up tables of the parts."""
        lower = np.zeros((len(self.entries), len(parts)), np.int64)
        upper = np.zeros_like(lower)
        for d in range(parts.shape[1]):
            under = self.low[:, d, None] - parts[None, :, d]
            over = parts[None, :, d] - self.high[:, d, None]
            near = np.maximum(np.maximum(under, over), 0)
            far = np.maximum(np.abs(under), np.abs(over))
            lower += (near * near)[self.cells[:, d]]
            upper += (far * far)[self.cells[:, d]]
        return lower, upper

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each part's nearest entry (the first of equals) and its squared distance."""
        best, away = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        for lo in range(0, len(parts), BLOCK):
            some = parts[lo : lo + BLOCK]
            lower, upper = self.bounds(some)
            row, entry = np.nonzero((lower <= upper.min(axis=0)).T)  # by part, then by entry; each part keeps one at least
            gap = some[row] - self.entries[entry]
            distance = np.einsum("ij,ij->i", gap, gap)
            first = np.searchsorted(row, np.arange(len(some)))
            least = np.minimum.reduceat(distance, first)
            tied = np.flatnonzero(distance == least[row])
            best[lo : lo + len(some)] = entry[tied[np.searchsorted(row[tied], np.arange(len(some)))]]
            away[lo : lo + len(some)] = least
        return best, away


def cut(x: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """rows x parts x dimensions of a part; zeros fill the last part up."""
    short = -x.shape[1] % parts
    if short:
        x = np.concatenate((x, np.zeros((len(x), short), x.dtype)), axis=1)
    return x.reshape(len(x), parts, x.shape[1] // parts)


def _sums(shared):
    """A row for each part position and entry that a task's parts came to: how many, and the sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = [Cells.of(book) for book in shared.value]
        many, dims = files[0].entries.shape
        counts, totals = np.zeros((len(files), many), np.int64), np.zeros((len(files), many, dims), np.int64)
        for batch in batches:
            x = cut(matrix(batch.column("x")), len(files))
            for p, file in enumerate(files):
                if not len(x):
                    continue
                chosen, _ = file.nearest(x[:, p])
                counts[p] += np.bincount(chosen, minlength=many)
                for d in range(dims):  # a batch's sums are exact in a double
                    totals[p, :, d] += np.bincount(chosen, x[:, p, d], many).astype(np.int64)
        part, entry = np.nonzero(counts)
        sums = totals[part, entry]
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * dims, pa.int32()), pa.array(sums.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), flat], ["part", "entry", "n", "s"])

    return run


def _coded(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = [Cells.of(book) for book in shared.value]
        for batch in batches:
            x = cut(matrix(batch.column("x")), len(files)) if batch.num_rows else np.zeros((0, len(files), 1), np.int64)
            found = [file.nearest(x[:, p]) for p, file in enumerate(files)] if len(x) else []
            codes = np.stack([f[0] for f in found], axis=1).astype(np.uint8) if found else np.zeros((0, len(files)), np.uint8)
            error = sum(f[1] for f in found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """The parts of the rows with the least ids: one codebook a part position."""
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").toArrow()
    if not least.num_rows:
        return []
    x = cut(matrix(least.column("x").combine_chunks()), parts)
    return [np.ascontiguousarray(x[:, p]) for p in range(parts)]


def trained(rows: DataFrame, books: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after so many rounds: an entry becomes the floored mean of the parts nearest to it, or stays if there are none."""
    spark = rows.sparkSession
    dims = books[0].shape[1]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        partial = rows.select("x").mapInArrow(_sums(shared), "part int, entry int, n long, s array<long>")
        met = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[d]) for d in range(dims)]).alias("s"))
        books = [b.copy() for b in books]
        for r in met.collect():  # an entry a row
            books[r["part"]][r["entry"]] = [s // r["n"] for s in r["s"]]
        shared.unpersist()
    return books


def compressed(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code (binary: an entry's number for each part), error (squared distance), and the codebooks that decode them."""
    spark = vectors.sparkSession
    rows = saved(whole(vectors, LIMIT, label=True), "vectors")
    books = first_books(rows)
    if not books:
        return spark.createDataFrame([], rows.select("vec_id", "label").schema.add("code", "binary").add("error", "long")), books
    books = trained(rows, books, rounds)
    kind = rows.schema["label"].dataType.simpleString()
    codes = rows.mapInArrow(_coded(spark.sparkContext.broadcast(books)), f"vec_id long, label {kind}, code binary, error long")
    return saved(codes, "codes"), books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Adds label_error: the error summed over equal labels, nulls together.

    Sums are combined before the shuffle; a label's one sum stands in SALTS copies, among which its rows are spread.
    """
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = sums.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("nth"))
    spread = codes.withColumn("salt", F.expr(f"CAST(pmod(xxhash64(vec_id, code), {SALTS}) AS INT)"))
    return spread.join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("nth"))).drop("of", "nth", "salt")


def decoded(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """Adds approx (array<long>): the entries that a code names, one after the other."""
    shared = codes.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            x = np.concatenate([book[numbers[:, p]] for p, book in enumerate(shared.value)], axis=1)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, flat], [*batch.schema.names, "approx"])

    # the schema is the codes' own and one column more
    return codes.mapInArrow(run, codes.withColumn("approx", F.lit(None).cast("array<long>")).schema)


def books_text(books: list[np.ndarray]) -> str:
    return ",".join(str(c) for book in books for c in book.ravel().tolist())


def report(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    rows = with_label_errors(codes)
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
