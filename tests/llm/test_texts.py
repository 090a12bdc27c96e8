"""Packing, SimHash, media and passages against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from fixtures import documents, empty, frame, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from grantlens.llm import media, packing, passages, simhash
from grantlens.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def test_pieces_cover_every_id_once(spark):
    docs = documents()
    rows = packing.packed(frame(spark)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for d, t, _, _ in docs]
    want = Counter((d, tuple(i)) for d, i in ids)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    for d in {d for d, _ in want}:
        mine = [i for (k, i), n in want.items() if k == d for _ in range(n)]
        assert sum(r["length"] for r in pieces[d]) == sum(map(len, mine))
        for r in pieces[d]:
            assert any(len(i) == r["doc_tokens"] and zlib.crc32(np.array(i[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"] for i in mine)
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        assert at & (at - 1) == 0  # nothing to pad


def test_ids_equal_the_tokenizers_library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = packing.encoder(packing.ranks_path())
    for text in ["", " ", "a  b\n\n c", "Ünï “quotes” — 12345 'll 've", "日本語 العربية 🙂", "<|endoftext|> x", "a<|endoftext|><|endoftext|>b <|endoftext|", "x" * 5000, "\t\r\n \x0b", prose(1, 300)]:
        assert packing.token_ids(enc, text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_hilbert_curve_visits_every_cell_in_steps():
    bits, dims = 2, packing.DIMS
    cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
    order = packing.hilbert(cells, bits)
    assert sorted(order) == list(range(len(cells)))
    walk = cells[np.argsort(order)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_copies_are_neighbours_on_the_curve():
    from grantlens.llm.words import text_bytes
    import pyarrow as pa

    key = packing.places(packing.vectors(*text_bytes(pa.array([prose(1, 50), prose(1, 50), prose(2, 50), None, ""]))))
    assert key[0] == key[1] != key[2]
    assert key[3] == key[4]


def plain_fingerprint(text):
    words = WORD.findall(lower(text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="ab Ü\t\x0b\xa0Z", max_size=60))
@settings(max_examples=60, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_many_shingles():
    assert simhash.fingerprint(prose(3, 1200)) == plain_fingerprint(prose(3, 1200))


def plain_components(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    items = list(prints)
    for i, a in enumerate(items):
        for b in items[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in items}


def test_near_duplicates(spark):
    docs = documents()
    rows = simhash.near_duplicates(frame(spark)).collect()
    assert len(rows) == len(docs)
    prints = defaultdict(list)
    for d, t, _, _ in docs:
        prints[plain_fingerprint(t)].append(d)
    roots = plain_components(prints)
    least = defaultdict(list)
    for p, ids in prints.items():
        least[roots[p]] += [d for d in ids if d is not None]
    want = Counter((d, min(least[roots[p]], default=None)) for p, ids in prints.items() for d in ids)
    assert Counter((r["doc_id"], r["component_id"]) for r in rows) == want


@pytest.mark.parametrize("bucket", [1, 3, 1000])
def test_links_by_pairs_and_by_centres_agree(spark, bucket, monkeypatch):
    """Clusters of fingerprints that share halves, at every limit that sends them one way or the other."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = np.random.default_rng(1)
    prints = set()
    for centre in rng.integers(0, 1 << 63, 6, dtype=np.uint64).tolist():
        for _ in range(25):
            p = centre
            for b in rng.choice(40, rng.integers(0, 5), replace=False).tolist():
                p ^= 1 << b
            prints.add(p)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    found = components(simhash.links(spark.createDataFrame([(signed(p),) for p in prints], "fp long"))).collect()
    root = {r["node"]: r["root"] for r in found}
    want = plain_components(prints)
    groups, got = defaultdict(set), defaultdict(set)
    for p in prints:
        groups[want[p]].add(p)
        got[root.get(signed(p), signed(p))].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (300, 200)]
    root = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(root[i] == 0 for i in range(1, 61))
    assert all(root[100 + i] == 100 for i in range(1, 40))
    assert root[300] == 200


def test_media_round_trip(spark):
    docs = documents()
    rows = media.stored(frame(spark)).collect()
    want = Counter()
    for d, t, _, _ in docs:
        raw = (t or "").encode()
        load = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        want[(d, len(raw), len(load), hashlib.sha256(load).hexdigest(), zlib.crc32(load[-32:]))] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in rows) == want
    values = defaultdict(set)
    for r in rows:
        values[r["payload_sha256"]].add((r["media_bytes"], r["media_sha256"], r["feature"]))
    assert all(len(v) == 1 for v in values.values())


@given(st.binary(max_size=40_000))
@settings(max_examples=30, deadline=None)
def test_chunks_put_together_give_the_bytes(raw):
    ends = media.cuts(raw)
    assert ends[-1] == len(raw) or not raw
    sizes = np.diff([0, *ends])
    assert (sizes[:-1] >= media.LEAST).all()
    assert (sizes <= media.MOST).all()
    assert b"".join(p for _, p in media.chunked(raw)) == raw
    assert media.samples_of(media.wav(raw)) == raw


def test_gear_is_a_rolling_hash():
    data = np.random.default_rng(2).integers(0, 256, 500, dtype=np.uint8)
    h, want = 0, []
    for b in data.tolist():
        h = ((h << 1) + int(media.GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    assert media.gear(data).tolist() == want


def test_an_insertion_moves_few_cuts():
    raw = np.random.default_rng(3).integers(0, 256, 200_000, dtype=np.uint8).tobytes()
    before, after = ({d for d, _ in media.chunked(x)} for x in (raw, raw[:50_000] + b"new" + raw[50_000:]))
    assert len(before & after) >= len(before) - 3


def test_damage_is_found(spark, monkeypatch):
    entries = media.put(frame(spark, [documents()[10], documents()[0]]))  # a file of several chunks, and one of one
    assert media.chunk_store(entries).count() > 1
    lost = media.chunk_store(entries).select(F.min("digest")).first()[0]
    with pytest.raises(Exception, match="missing or out of order"):
        media.read_files(entries.filter(F.col("digest").isNull() | (F.col("digest") != lost))).collect()
    with pytest.raises(Exception, match="damaged"):
        media.read_files(entries.withColumn("digest", F.when(F.col("whole"), F.lit(b"x" * 32)).otherwise(F.col("digest")))).collect()
    monkeypatch.setattr(media, "read_files", lambda e, f=media.read_files: f(e).limit(1))
    with pytest.raises(Exception, match="file is missing"):
        media.stored(frame(spark, documents()[:6])).collect()


def shared_runs(docs, n):
    """Ids of documents with n equal words in a row, and the pairs."""
    held = defaultdict(set)
    for d, t, _, _ in docs:
        words = WORD.findall(lower(t or ""))
        if d is not None:
            for i in range(len(words) - n + 1):
                held[tuple(words[i : i + n])].add(d)
    return set().union(*[v for v in held.values() if len(v) > 1])


def test_passages(spark):
    docs = documents()
    rows = passages.shared_passages(frame(spark)).collect()
    found = {r["doc_id"] for r in rows}
    assert shared_runs(docs, 51) <= found
    assert not found - shared_runs(docs, 30)
    words = {d: WORD.findall(lower(t or "")) for d, t, _, _ in docs}
    for r in rows:
        assert r["end"] - r["start"] >= 40
        if r["other_id"] is not None:
            assert r["similarity"] >= 0.8
            assert r["similarity"] < 1 or words[r["other_id"]][r["other_start"] : r["other_end"]] == words[r["doc_id"]][r["start"] : r["end"]][: r["matched"]] or r["links"] > 1


def test_fuzzy_passages_with_changed_added_and_dropped_words(spark):
    base = prose(50, 160).split()
    changed = [w if i % 31 else "changed" for i, w in enumerate(base)]
    added = base[:60] + ["some", "new", "words"] + base[60:]
    dropped = base[:80] + base[84:]
    texts = [base, changed, added, dropped, prose(51, 160).split()]
    docs = [(i, " ".join(prose(60 + i, 30).split() + t + prose(70 + i, 30).split()), "en", "a") for i, t in enumerate(texts)]
    rows = frame(spark, docs).select("doc_id", "text")
    names = {r["text_id"]: r["doc_id"] for r in rows.mapInArrow(passages._members, "doc_id long, text_id long, words int").collect()}
    found = {tuple(sorted((names[r["a"]], names[r["b"]]))): r["matched"] for r in passages.links(rows).collect()}
    assert {(0, 1), (0, 2), (0, 3)} <= set(found)
    assert not any(4 in pair for pair in found)
    for pair, matched in (((0, 1), 154), ((0, 2), 160), ((0, 3), 156)):
        assert abs(found[pair] - matched) <= 6
    spans = passages.shared_passages(frame(spark, docs)).collect()
    assert sorted(r["doc_id"] for r in spans) == [0, 1, 2, 3]
    assert len({(r["class_id"], r["class_start"]) for r in spans}) == 1


def plain_chain(a, b):
    """The best chain's score by trying all predecessors."""
    score = []
    for j in range(len(a)):
        best = max([score[i] - passages.GAP_COST * (a[j] - a[i] + b[j] - b[i]) for i in range(j) if a[i] < a[j] and b[i] < b[j]], default=0)
        score.append(1 + max(0, best))
    return max(score)


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=2, max_size=40, unique=True))
@settings(max_examples=80, deadline=None)
def test_chaining_finds_the_best_chain(points):
    points.sort(key=lambda p: (p[1], p[0]))
    a, b = [p[0] for p in points], [p[1] for p in points]
    chains = passages.chained(a, b)
    best = plain_chain(a, b)
    if chains:
        c = chains[0]
        assert all(a[p] < a[q] and b[p] < b[q] for p, q in zip(c, c[1:], strict=False))
        score = len(c) - sum(passages.GAP_COST * (a[q] - a[p] + b[q] - b[p]) for p, q in zip(c, c[1:], strict=False))
        assert score == pytest.approx(best)
    else:
        assert best <= 1 + 1e-9


def test_empty_tables(spark):
    for f in (packing.packed, simhash.near_duplicates, media.stored, passages.shared_passages):
        assert f(empty(spark)).count() == 0
