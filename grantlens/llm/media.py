"""Media columns in a chunk store with content-defined cuts.

A text's payload is stored as the samples of an 8-bit mono WAV file. A rolling gear hash over the last 32 bytes cuts
the file into chunks, so equal stretches of different files give equal chunks. Chunks are addressed by SHA-256; a file
is an ordered list of digests. One pass over the texts writes lists and compressed chunks to a table in the shared
folder; a task writes a chunk once, however many of its files hold it. Chunks are compressed with a dictionary, trained on
SAMPLE texts of at most SAMPLE_BYTES (those with the least hash) and kept in the same table. Reading back takes that table alone: lists are
joined with the chunks, deduplicated by digest, each file's chunks are put in order, every digest and the file's own are
checked, and the samples are decoded.

Equal texts are one file. A file of one chunk is read back where its chunk lies; only those of several chunks send bytes
through joins, compressed: to their digest and to their file.

Defined results for odd input: a null text is an empty payload, padded like any other; null ids and repeated rows stay
rows; an empty table gives an empty result; a long text is many chunks, read back as a stream of rows; a chunk or file
that is missing or damaged fails the read; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, short_batches
from .words import mix, portions

UNIT = 576
FILL = 255
#: Least, usual and greatest bytes of a chunk.
LEAST, USUAL, MOST = 2048, 8192, 65536
WINDOW = 32
HEADER = 44
RATE = 8000
#: Bytes of the dictionary, texts that it is trained on, and bytes of those at most.
DICTIONARY, SAMPLE, SAMPLE_BYTES = 112_640, 400, 16_000
#: Digests that a task remembers having sent, so that copies in one task go out once.
REMEMBERED = 50_000
GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
ENTRIES = "doc_id long, n_bytes long, file binary, digests array<binary>, digest binary, whole boolean, packed binary"
READ_BACK = "file binary, payload_bytes long, payload_digest binary, tail_crc32 long, media_bytes long, chunks long, sum long, squares long, peak long, low long, crossings long"
#: A file's feature, spelled from these columns.
FEATURES = ["chunks", "sum", "squares", "peak", "low", "crossings"]


def payload(raw: bytes) -> bytes:
    short = -len(raw) % UNIT
    return raw + bytes([FILL]) * (short if raw else UNIT)


def wav(samples: bytes) -> bytes:
    """An 8-bit mono PCM file."""
    pad = len(samples) % 2
    head = b"RIFF" + struct.pack("<I", 36 + len(samples) + pad) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8)
    return head + b"data" + struct.pack("<I", len(samples)) + samples + b"\0" * pad


def samples_of(media: bytes) -> bytes:
    """The samples of such a file, found by walking its chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at = 12
    while at < len(media):
        kind, size = media[at : at + 4], struct.unpack("<I", media[at + 4 : at + 8])[0]
        if kind == b"data":
            return media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples")


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte: the sum over the last 32 bytes of their gear value shifted by their age, by doubling."""
    h = GEAR[data]
    width = 1
    while width < WINDOW:
        older = h[:-width] << np.uint32(width)
        h = h.copy()
        h[width:] += older
        width *= 2
    return h


def cuts(media: bytes) -> list[int]:
    """The ends of the chunks. A cut is where the hash's upper bits are zero, at least LEAST and at most MOST after the last."""
    n = len(media)
    if n <= LEAST:
        return [n]
    bits = USUAL.bit_length() - 1
    found = np.flatnonzero(gear(np.frombuffer(media, np.uint8)) >> np.uint32(32 - bits) == 0) + 1
    ends, last = [], 0
    while n - last > LEAST:
        i = int(np.searchsorted(found, last + LEAST))
        end = min(int(found[i]) if i < len(found) else n, last + MOST, n)
        ends.append(end)
        last = end
    if last < n:
        ends.append(n)
    return ends


def chunked(media: bytes) -> list[tuple[bytes, bytes]]:
    """(digest, bytes) of each chunk."""
    out, last = [], 0
    for end in cuts(media):
        part = media[last:end]
        out.append((hashlib.sha256(part).digest(), part))
        last = end
    return out


def features(samples: bytes, chunks: int) -> tuple[int, ...]:
    """FEATURES of a file: its chunks, and sums, extremes and crossings of the middle of its samples."""
    x = np.frombuffer(samples, np.uint8).astype(np.int64)
    crossings = int(np.count_nonzero(np.diff((x >= 128).astype(np.int8))))
    return chunks, int(x.sum()), int((x * x).sum()), int(x.max()), int(x.min()), crossings


def _texts(part: pa.RecordBatch) -> Iterator[tuple[object, bytes]]:
    for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
        yield doc_id, (text or "").encode()


def dictionary(docs: DataFrame) -> bytes:
    """A dictionary for chunks of texts like these; empty where there is too little to learn from."""
    short = docs.select("text").filter(F.octet_length("text").between(1, SAMPLE_BYTES)).withColumn("h", F.xxhash64("text"))
    # hashes alone are sorted; then only the texts of those that were chosen travel
    chosen = F.broadcast(short.select("h").distinct().orderBy("h").limit(SAMPLE))
    texts = short.join(chosen, "h").groupBy("h").agg(F.min("text").alias("text")).orderBy("h").collect()  # SAMPLE rows
    try:
        return zstandard.train_dictionary(DICTIONARY, [wav(payload(r["text"].encode())) for r in texts]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def known(raw: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}


def _encoded(shared):
    return lambda batches: encoded(batches, zstandard.ZstdCompressor(level=3, write_dict_id=False, **known(shared.value)))


def encoded(batches: Iterator[pa.RecordBatch], pack: zstandard.ZstdCompressor) -> Iterator[pa.RecordBatch]:
    """A list row for each text, and a chunk row for each chunk that the task hasn't written yet."""
    sent: OrderedDict[tuple[bytes, bool], None] = OrderedDict()
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.binary(), pa.bool_(), pa.binary()]
    names = [c.split()[0] for c in ENTRIES.split(", ")]
    for batch in batches:
        for part in portions(batch, "text"):
            rows: list[tuple] = []
            for doc_id, raw in _texts(part):
                media = wav(payload(raw))
                chunks = chunked(media)
                whole = len(chunks) == 1
                rows.append((doc_id, len(raw), chunks[0][0] if whole else hashlib.sha256(media).digest(), [d for d, _ in chunks], None, None, None))
                for digest, data in chunks:
                    if (digest, whole) in sent:
                        sent.move_to_end((digest, whole))
                        continue
                    sent[digest, whole] = None
                    if len(sent) > REMEMBERED:
                        sent.popitem(last=False)
                    rows.append((None, None, None, None, digest, whole, pack.compress(data)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def put(docs: DataFrame) -> DataFrame:
    """ENTRIES: the store, written to the shared folder and read again. The row without a digest's bytes is the dictionary."""
    spark = docs.sparkSession
    short_batches(spark)
    learned = dictionary(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(learned)  # DICTIONARY bytes
    own = spark.createDataFrame([(None, None, None, None, b"", None, learned)], ENTRIES)
    return saved(rows.mapInArrow(_encoded(shared), ENTRIES).unionByName(own), "media")


def file_lists(entries: DataFrame) -> DataFrame:
    """doc_id, n_bytes, file (the media's SHA-256), digests (ordered)."""
    return entries.filter("digests IS NOT NULL").select("doc_id", "n_bytes", "file", "digests")


def chunk_store(entries: DataFrame) -> DataFrame:
    """digest, packed: each chunk of files of several chunks once."""
    return entries.filter("NOT whole").groupBy("digest").agg(F.first("packed").alias("packed"))


def read_files(entries: DataFrame) -> DataFrame:
    """READ_BACK, one row a distinct file: reconstructed, verified, decoded. Several tasks may have written a file of one
    chunk; all its rows are verified, and one stays."""
    learned = entries.filter(F.octet_length("digest") == 0).select("packed").first()["packed"]  # one row
    assemble = _assemble(entries.sparkSession.sparkContext.broadcast(bytes(learned)))
    alone = entries.filter("whole").select(F.col("digest").alias("file"), F.lit(1).alias("n"), F.lit(0).alias("nth"), "digest", "packed").mapInArrow(assemble, READ_BACK)
    files = file_lists(entries).filter(F.size("digests") > 1).groupBy("file").agg(F.first("digests").alias("digests"))
    wanted = files.select("file", F.size("digests").alias("n"), F.posexplode("digests").alias("nth", "digest"))
    parts = wanted.join(chunk_store(entries), "digest", "left").select("file", "n", "nth", "digest", "packed")
    found = alone.unionByName(parts.repartition("file").sortWithinPartitions("file", "nth").mapInArrow(assemble, READ_BACK))
    return found.groupBy("file").agg(*[F.first(c).alias(c) for c in (x.split()[0] for x in READ_BACK.split(", ")) if c != "file"])


def _assemble(shared):
    return lambda batches: assembled(batches, zstandard.ZstdDecompressor(**known(shared.value)))


def assembled(batches: Iterator[pa.RecordBatch], unpack: zstandard.ZstdDecompressor) -> Iterator[pa.RecordBatch]:
    parts: list[bytes] = []
    for batch in batches:
        rows = []
        for file, n, nth, digest, packed in zip(*(batch.column(c).to_pylist() for c in ("file", "n", "nth", "digest", "packed")), strict=True):
            if nth != len(parts) or packed is None:
                raise ValueError(f"chunk {nth} of {file.hex()} is missing or out of order")
            part = unpack.decompress(packed)
            if hashlib.sha256(part).digest() != digest:
                raise ValueError(f"chunk {digest.hex()} is damaged")
            parts.append(part)
            if len(parts) < n:
                continue
            media, parts = b"".join(parts), []
            if hashlib.sha256(media).digest() != file:
                raise ValueError(f"file {file.hex()} is damaged")
            samples = samples_of(media)
            rows.append((file, len(samples), hashlib.sha256(samples).digest(), zlib.crc32(samples[-32:]), len(media), *features(samples, n)))
        kinds = [pa.binary(), pa.int64(), pa.binary(), *[pa.int64()] * 8]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [c.split()[0] for c in READ_BACK.split(", ")])
    if parts:
        raise ValueError("the last file is incomplete")


def stored(docs: DataFrame) -> DataFrame:
    """doc_id and n_bytes of every row with what reading its media back gives."""
    entries = put(docs)
    back = read_files(entries).withColumnRenamed("file", "f")
    rows = file_lists(entries).drop("digests").join(back, F.col("file") == F.col("f"), "left")
    missing = F.raise_error(F.concat(F.lit("file is missing: "), F.hex("file"))).cast("long")
    spelled = F.concat_ws(";", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in FEATURES])
    digest = lambda c: F.lower(F.hex(c))
    return rows.select("doc_id", "n_bytes", F.coalesce("payload_bytes", missing).alias("payload_bytes"), digest("payload_digest").alias("payload_sha256"), "tail_crc32", "media_bytes", digest("file").alias("media_sha256"), spelled.alias("feature"))
