"""SimHash near-duplicates by multi-index hashing.

A fingerprint is 64 bits over the XXH64 hashes of a text's three-word shingles. Two fingerprints at most three bits
apart have a 32-bit half in which they differ by at most one bit, so each fingerprint looks up the 33 values of the
small ball around each of its halves in a table of halves; distances are then verified in full. Equal fingerprints
count once. Linked fingerprints form components.

A half that more than BUCKET fingerprints share would give pairs in the square of that number. Its members are
linked through the small ball around their other half instead, at a fixed number of rows each (see crowded()), with
the same components.

Defined results for odd input: a null text or one without words has fingerprint zero, which links like any other; a
text of one or two words is one shingle; repeated rows and null ids stay rows (a null id is never the component's id
unless all are null); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import merged, saved, short_batches
from .components import components
from .words import portions

SHINGLE = 3
SEED = 42
DISTANCE = 3
#: Fingerprints that may share a half before their pairs are found through the other half.
BUCKET = 64
#: Shingles whose bits are counted at a time: a count of one byte can't run over.
COUNTED = 255


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint as an unsigned number: bit set if it is in over half the shingles' hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words)
    if n <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends[SHINGLE - 1 :].tolist(), strict=False)])
    count = n - SHINGLE + 1
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8))
    full = count - count % COUNTED
    sums = np.zeros(64, np.int64)
    if full:
        packed = bits[: full * 64].view(np.uint64).reshape(-1, COUNTED, 8).sum(axis=1, dtype=np.uint64)
        sums += packed.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    sums += bits[full * 64 :].reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * sums > count).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in portions(batch, "text"):
            prints = np.array([fingerprint(t) for t in part.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""
    short_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_fingerprints, "doc_id long, fp long")


def _halves(prints: DataFrame) -> DataFrame:
    """fp, side, own (its half there), other; two rows a fingerprint."""
    left, right = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    both = F.array(F.struct(F.lit(0).alias("side"), left.alias("own"), right.alias("other")), F.struct(F.lit(1).alias("side"), right.alias("own"), left.alias("other")))
    return prints.select("fp", F.explode(both).alias("h")).select("fp", "h.side", "h.own", "h.other")


def _key(side: str, value: str) -> str:
    return f"({value}) * 2 + {side}"


def links(prints: DataFrame) -> DataFrame:
    """Links u < v that give the same components as all pairs of distinct fingerprints at most DISTANCE bits apart. prints: fp, distinct."""
    halves = _halves(prints)
    homes = halves.select(F.expr(_key("side", "own")).alias("key"), "fp", "other")
    sizes = homes.groupBy("key").agg(F.count("*").alias("n"))
    homes = homes.join(merged(sizes), "key")
    flips = "transform(sequence(0, 32), i -> if(i = 32, own, own ^ shiftleft(1L, i)))"
    asks = halves.select("fp", "side", "own", F.explode(F.expr(flips)).alias("value")).select(F.expr(_key("side", "value")).alias("key"), F.col("fp").alias("ask"))
    few = homes.filter(F.col("n") <= BUCKET).select("key", "fp")
    pairs = asks.join(merged(few), "key").filter((F.col("fp") < F.col("ask")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("ask"))) <= DISTANCE))
    many = saved(homes.filter(F.col("n") > BUCKET).select("key", "fp", "other"), "crowded")
    edges = pairs.select(F.col("fp").alias("u"), F.col("ask").alias("v"))
    if many.isEmpty():
        return edges
    return edges.unionByName(crowded(many, asks))


def crowded(many: DataFrame, asks: DataFrame) -> DataFrame:
    """Links among the members of crowded halves, and to those that ask for such a half from one bit away.

    Members differ only in their other half, askers in one more bit. Two members at most two bits apart, or a member
    and an asker at most two bits apart there, have a centre within one bit of both. Two members three bits apart have
    a centre one bit from the first and two from the second. So at each centre it is enough to link all of those near
    it to the least member within one bit of it: no link is longer than three bits, and whatever is that near is joined.
    A centre has at most 33 members within one bit and 529 within two, whatever the data.
    """
    near = "transform(sequence(0, 32), i -> if(i = 32, other, other ^ shiftleft(1L, i)))"
    far = "flatten(transform(sequence(1, 31), i -> transform(sequence(0, i - 1), j -> other ^ shiftleft(1L, i) ^ shiftleft(1L, j))))"
    keys = many.select("key").distinct()
    # an asker's other half: that opposite to the side in the key's last bit
    askers = asks.join(keys, "key").select("key", F.col("ask").alias("fp"), F.expr("if(key % 2 = 0, ask & 4294967295, shiftrightunsigned(ask, 32))").alias("other"))
    one = many.select("key", "fp", F.explode(F.expr(near)).alias("centre"))
    hubs = one.groupBy("key", "centre").agg(F.min("fp").alias("hub"))
    two = many.select("key", "fp", F.explode(F.expr(far)).alias("centre"))
    from_askers = askers.select("key", "fp", F.explode(F.expr(near)).alias("centre"))
    around = one.unionByName(two).unionByName(from_askers)
    met = around.join(merged(hubs), ["key", "centre"]).filter(F.col("fp") != F.col("hub"))
    met = met.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= DISTANCE)
    return met.select(F.least("fp", "hub").alias("u"), F.greatest("fp", "hub").alias("v"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id (the least doc_id reachable by links) of every row."""
    rows = saved(fingerprints(docs), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(links(prints.select("fp")))
    prints = prints.join(merged(roots.select(F.col("node").alias("fp"), "root")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = prints.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = prints.join(merged(least), "root").select(F.col("fp").alias("p"), "component_id")
    return rows.join(merged(named), F.col("fp") == F.col("p")).select("doc_id", "fp", "component_id")


def fingerprint_hex(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
