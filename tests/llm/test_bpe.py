"""The streaming transducer against the tokenizers library and against a plain search for the lookahead."""

import hashlib
import random
from functools import lru_cache

import numpy as np
import pytest
from fixtures import documents, empty, frame, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from grantlens.llm import bpe

PIECES = ["a", "the", "ing", "'s", "'re", "'", "r", "l", " ", "  ", "\n", "é", "é", "́", "Σ", "ΑΣ", "İ", "日本", "한", "ᄒ", "ᅡ", "ᆫ", "١", "²", "!", "...", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "<|start", "🙂", "\x1c", "\x85", " ", "​", "ß", "_", "0", "99", "क़", "ﬁ", "\U0001d400", "か", "゙", "Ɤ", "\x00"]


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(bpe.vocabulary_path())


@lru_cache(maxsize=1)
def tokenizer():
    return Tokenizer.from_file(bpe.vocabulary_path())


@pytest.fixture(scope="module")
def library():
    return tokenizer()


def encoded(vocab, pieces):
    encoder = bpe.Encoder(vocab)
    return np.frombuffer(b"".join([*[b for p in pieces for b in encoder.feed(p)], *encoder.finish()]), "<u4").tolist()


def cut(text, step):
    return [text[i : i + step] for i in range(0, len(text), step)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30).map("".join) | st.text(max_size=40), st.sampled_from([1, 2, 5, 1000]))
def test_ids_equal_the_library_however_the_text_arrives(text, step):
    vocab, library = bpe.vocabulary(bpe.vocabulary_path()), tokenizer()
    assert encoded(vocab, cut(text, step)) == library.encode(text, add_special_tokens=False).ids


def test_long_words_leave_in_pieces_and_hold_no_more_than_the_lookahead(vocab, library):
    rng = random.Random(4)
    for _ in range(60):
        word = "".join(rng.choice(["a", "e", "th", "in", "an", "re", "er", "lo", "zz", "aaaa"]) for _ in range(rng.randint(400, 3000)))
        one, got, held = bpe.LongWord(vocab, block=64), [], 0
        for part in cut(word, rng.randint(1, 300)):
            got += one.feed(part.encode())
            held = max(held, len(one.held))
        got += one.finish()
        assert got == library.encode(word, add_special_tokens=False).ids
        assert held <= vocab.lookahead + 1 + 2 * 64


def test_a_text_of_several_megabytes(vocab, library):
    words = "x" * 700_000 + " " + prose(3, 300_000) + " " + "日本語" * 200_000 + "é" * 100_000
    assert encoded(vocab, [words]) == library.encode(words, add_special_tokens=False).ids


def plain(word, ranks):
    tokens = list(word)
    for a, b in ranks:
        i, out = 0, []
        while i < len(tokens):
            if tokens[i : i + 2] == [a, b]:
                out.append(a + b)
                i += 2
            else:
                out.append(tokens[i])
                i += 1
        tokens = out
    return tokens


def final_bounds(tokens):
    at, out = 0, {0}
    for t in tokens:
        at += len(t)
        out.add(at)
    return out


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6))
def test_nothing_beyond_the_lookahead_changes_a_token(seed):
    """Random merge lists over three letters: bounds further from the end than the lookahead hold for every continuation."""
    rng = random.Random(seed)
    tokens, merges = ["a", "b", "c"], []
    for _ in range(rng.randint(1, 12)):
        a, b = rng.choice(tokens), rng.choice(tokens)
        if a + b not in tokens:
            tokens.append(a + b)
            merges.append((a, b))
    reach = bpe.lookahead(merges, "abc")
    for _ in range(8):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 40)))
        now = {p for p in final_bounds(plain(word, merges)) if p <= len(word) - reach}
        for _ in range(8):
            more = word + "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
            assert {p for p in final_bounds(plain(more, merges)) if p <= len(word) - reach} == now


def test_a_list_out_of_order_has_no_lookahead():
    with pytest.raises(ValueError, match="in order"):
        bpe.lookahead([("ab", "c"), ("a", "b")], "abc")


def test_decoding_carries_unfinished_characters_and_separators(vocab, library):
    text = "Zwölf Boxkämpfer — 日本語 🙂 it's 12"
    ids = library.encode(text, add_special_tokens=False).ids
    for step in (1, 2, 7, 100):
        spelled, plain_text = bpe.Decoder(vocab), bpe.Decoder(vocab, spelled=False)
        parts = [ids[i : i + step] for i in range(0, len(ids), step)]
        assert "".join([*map(spelled.feed, parts), spelled.finish()]) == library.decode(ids, skip_special_tokens=False)
        assert "".join([*map(plain_text.feed, parts), plain_text.finish()]) == "zwölf boxkämpfer — 日本語 🙂 it 's 1 2 "
    broken = bpe.Decoder(vocab, spelled=False)  # a character that never ends
    assert broken.feed([vocab.inner[0xE6]]) == "" and broken.finish() == "�"


def test_many_texts_at_once(vocab, library, monkeypatch):
    texts = [prose(i, 80) + ("x" * 300 if i % 7 == 0 else "") + ["", "'s", "日本<|endoftext|>", "İ"][i % 4] for i in range(200)]
    monkeypatch.setattr(bpe, "WAITING", 500)
    monkeypatch.setattr(bpe, "KNOWN", 1000)  # the table starts anew now and then
    found = bpe.encode_many(vocab, texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_every_document_has_its_row(spark, library):
    rows = documents()
    want = []
    for doc_id, text, _, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((doc_id, len(ids), digest, hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    found = bpe.report(frame(spark))
    assert [c.split(":")[0] for c in found.columns] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert bpe.report(empty(spark)).collect() == []
