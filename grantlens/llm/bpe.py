"""BPE encoding and decoding as streams, with a lookahead that the merge list itself bounds.

A merge list of which every pair joins what earlier pairs made can be applied in the order of its ranks. Let a text be
known up to some place, with any continuation. Before the first rank, all bounds up to that place are certain. A rank
can make at most one more bound uncertain: it joins the last certain token, its left part, to something that begins
beyond the place. So uncertainty moves left by a chain of pairs of rising ranks; each one's right part must begin with
the token that the one before it took. The longest such chain, in bytes of left parts, is the list's sufficient
lookahead (`lookahead`): whatever follows, a token that ends that far before the known end is final. A word's last byte
is another symbol than the same byte inside a word, so it counts as unknown until the word has ended.

`Encoder` takes a text in pieces of any size. It normalises up to the last place where that is safe, cuts words, and
holds of a long word no more than the lookahead and one block; what is final goes out. A bounded table keeps the ids of
short runs of text between white space; those that it lacks are merged many at a time (`merged_many`). `Decoder` takes ids in pieces of any size: it carries the bytes of an unfinished character, and the
separator that is due, from one to the next.

Memory: one row's text and ids, as Arrow carries them, and beside them a bounded state. Only a run of combining marks is
held whole, as the canonical order sorts the run.

Defined results for odd input: a null or empty text has no ids and decodes to an empty text; the string of a special
token in a text is that token, as in the vocabulary's file; null ids and repeated rows are encoded as they come; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import short_batches
from .words import portions

#: Bytes of a long word that are merged at a time, beside the lookahead; characters of a text that are normalised at a time.
BLOCK = 4096
CHUNK = 1 << 16
#: Bytes of texts that are encoded together; a longer text is encoded by itself.
PORTION = 4 << 20
#: Ids that are decoded at a time.
STEP = 1 << 16
#: Runs of text whose ids a worker keeps, and their longest length in characters; runs that wait for their ids at most.
KNOWN, RUN_CHARS, WAITING = 1 << 18, 48, 1 << 18
#: Bits of the table of pairs.
SLOT_BITS = 20
#: Bytes of a word that is merged without a heap.
SHORT = 96
#: Above all ids: a rank and the id that it makes are one number.
MADE = 1 << 32
#: The value of a pair that doesn't merge.
NONE = 1 << 62
#: Marks a symbol that ends a word.
ENDS = "</w>"

#: How the vocabulary's words are cut, as its file states it.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: Characters on whose classes, case and composition all Unicode versions agree; texts with others go through the file's own rules.
PLAIN = [*range(0x09, 0x0E), *range(0x20, 0x250), *range(0x300, 0x34F), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20AD)]
SPACES = " \t\n\r"


def _class(pattern: str) -> str:
    """The plain characters that fit, as a character class's contents."""
    return "".join(re.escape(chr(c)) for c in PLAIN if regex.match(pattern, chr(c)))


#: How the vocabulary's words are cut, as its file states it, for plain characters.
WORD = re.compile("|".join([f"[{_class(r'\p{L}')}]+", *CONTRACTIONS, f"[{_class(r'\p{N}')}]", f"[{_class(r'[^\s\p{L}\p{N}]')}]+"]))
RARE = re.compile(f"[^{_class('.|\n')}]")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where it is visible in Latin-1, else the next one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return [chr(b) if b in seen else chr(256 + rest.index(b)) for b in range(256)]


@dataclass
class Vocabulary:
    """spelled: id to the token as the file writes it; ranks: pair of ids to rank * MADE + the id made; inner, last: byte to its id
    inside and at the end of a word; special: string to id; marks: finds those strings; lookahead: bytes;
    library: the file in the tokenizers library, for the rules of rare characters; known: ids of short runs met so far;
    slots: ranks as a hashed table (keys, values, probes)."""

    spelled: list[str]
    ranks: dict[tuple[int, int], int]
    inner: list[int]
    last: list[int]
    special: dict[str, int]
    marks: re.Pattern
    lookahead: int
    library: Tokenizer
    known: dict[str, bytes]
    slots: tuple[np.ndarray, np.ndarray, int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        ids = dict(file["model"]["vocab"])
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        spelled = [""] * (1 + max(*ids.values(), *special.values()))
        for token, number in [*ids.items(), *special.items()]:
            spelled[number] = token
        letters = byte_letters()
        marks = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in file["model"]["merges"]]
        ranks = {(ids[a], ids[b]): rank * MADE + ids[a + b] for rank, (a, b) in enumerate(merges)}
        return cls(spelled, ranks, [ids[c] for c in letters], [ids[c + ENDS] for c in letters], special, marks, lookahead(merges, [*letters, *[c + ENDS for c in letters]]), Tokenizer.from_file(path), {}, hashed(ranks))

    def word(self, data: bytes) -> list[int]:
        """The ids of a whole word."""
        inner = self.inner
        symbols = [*[inner[b] for b in data[:-1]], *[self.last[b] for b in data[-1:]]]
        return merged(symbols, self.ranks) if len(data) <= SHORT else merged_long(symbols, self.ranks)[0]

    def words(self, run: str) -> list[str]:
        """The words of normalised text."""
        if not RARE.search(run):
            return WORD.findall(run)
        return [run[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(run)]

    def learn(self, runs: Iterable[str]) -> None:
        """Puts the ids of runs of at most RUN_CHARS characters into known."""
        known = self.known
        parts = {r: self.words(r) for r in runs}
        fresh = list({w for words in parts.values() for w in words}.difference(known))
        known.update(zip(fresh, merged_many(self, [w.encode() for w in fresh]), strict=True))
        known.update({r: b"".join([known[w] for w in words]) for r, words in parts.items() if len(words) != 1})

    def ids(self, runs: list[str]) -> bytes:
        """The ids of runs of text without white space."""
        known, long = self.known, {}
        missing = set(runs).difference(known)
        if missing:
            if len(known) > KNOWN:
                known.clear()
                missing = set(runs)
            self.learn([r for r in missing if len(r) <= RUN_CHARS])
            for r in missing:
                if len(r) > RUN_CHARS:
                    long[r] = b"".join([packed(LongWord.whole(self, w)) for w in self.words(r)])
        if long:
            return b"".join([long[r] if r in long else known[r] for r in runs])
        return b"".join([known[r] for r in runs])

    def token_bytes(self) -> list[bytes]:
        """What each id stands for in a text; a word's end is a space."""
        of = {c: b for b, c in enumerate(byte_letters())}
        marked = set(self.special.values())
        return [t.encode() if i in marked else bytes(of[c] for c in t.removesuffix(ENDS)) + (b" " if t.endswith(ENDS) else b"") for i, t in enumerate(self.spelled)]


def lookahead(merges: Iterable[tuple[str, str]], symbols: Iterable[str]) -> int:
    """Bytes that must be known beyond a token's end for it to be final. merges: pairs by rank; symbols: what they start from.

    A list of which a pair joins what no earlier pair made, or makes what another one makes, has no such bound: ValueError.
    """
    size = {s: 1 for s in symbols}
    left: dict[str, str] = {}
    longest: dict[str, int] = {}  # the longest chain that ends with taking this token
    most = 0
    for a, b in merges:
        if a not in size or b not in size or a + b in size:
            raise ValueError(f"the merge list isn't in order at {a!r} {b!r}")
        size[a + b], left[a + b] = size[a] + size[b], a
        before, token = 0, b
        while token is not None:
            before = max(before, longest.get(token, 0))
            token = left.get(token)
        longest[a] = max(longest.get(a, 0), before + size[a])
        most = max(most, longest[a])
    return most


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary.read(path)


def merged(symbols: list[int], ranks: dict[tuple[int, int], int]) -> list[int]:
    """The tokens that symbols merge to, the least rank first and the leftmost of equals."""
    ids = list(symbols)
    found = [ranks.get(pair, NONE) for pair in zip(ids, ids[1:])]
    while found and (least := min(found)) < NONE:
        i = found.index(least)
        ids[i : i + 2] = [least % MADE]
        del found[i]
        if i:
            found[i - 1] = ranks.get((ids[i - 1], ids[i]), NONE)
        if i < len(found):
            found[i] = ranks.get((ids[i], ids[i + 1]), NONE)
    return ids


def merged_long(symbols: list[int], ranks: dict[tuple[int, int], int]) -> tuple[list[int], list[int]]:
    """The same by a heap of pairs, which long words need, and the symbols up to each token's end."""
    n = len(symbols)
    ids, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[pair], i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in ranks]
    heapq.heapify(heap)

    def joins(i: int, j: int) -> None:
        pair = ids[i], ids[j]
        if pair in ranks:
            heapq.heappush(heap, (ranks[pair], i, *pair))

    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue  # one of the two is part of another token by now
        ids[i], ids[j] = rank % MADE, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            joins(i, after[i])
        if before[i] >= 0:
            joins(before[i], i)
    kept = [i for i in range(n) if ids[i] >= 0]
    return [ids[i] for i in kept], [after[i] for i in kept]


def hashed(ranks: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs (as left << 32 | right) in a table with open addresses, their values, and the most probes that one needs."""
    size, most = 1 << SLOT_BITS, 1
    keys, values = np.full(size, -1, np.int64), np.full(size, NONE, np.int64)
    pairs = np.array([a << 32 | b for a, b in ranks], np.int64)
    for key, at, value in zip(pairs.tolist(), _slot(pairs).tolist(), ranks.values(), strict=True):
        probes = 1
        while keys[at] >= 0:
            at, probes = (at + 1) % size, probes + 1
        keys[at], values[at], most = key, value, max(most, probes)
    return keys, values, most


def _slot(pairs: np.ndarray) -> np.ndarray:
    return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def merged_many(vocab: Vocabulary, words: list[bytes]) -> list[bytes]:
    """The packed ids of whole words, all of them a merge further at a time."""
    if not words:
        return []
    keys, values, probes = vocab.slots
    size = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    ids, word = np.array(vocab.inner, np.int64)[data], np.repeat(np.arange(len(words)), size)
    ends = np.cumsum(size) - 1
    ids[ends] = np.array(vocab.last, np.int64)[data[ends]]
    done_ids, done_words = [], []
    while len(ids):
        pair = (ids[:-1] << 32 | ids[1:])[(inside := word[:-1] == word[1:])]
        slot = _slot(pair)
        value = np.where(keys[slot] == pair, values[slot], NONE)
        left = np.flatnonzero((value == NONE) & (keys[slot] >= 0))  # another pair is there
        for n in range(1, probes):
            if not len(left):
                break
            at = (slot[left] + n) % len(keys)
            value[left] = np.where(keys[at] == pair[left], values[at], NONE)
            left = left[(keys[at] >= 0) & (value[left] == NONE)]
        rank = np.full(len(ids), NONE)
        rank[:-1][inside] = value
        begin = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        best = np.repeat(np.minimum.reduceat(rank, begin), np.diff(np.append(begin, len(ids))))
        over = best == NONE
        done_ids.append(ids[over])
        done_words.append(word[over])
        hit = np.flatnonzero((rank == best) & ~over)
        hit = hit[np.concatenate(([True], word[hit[1:]] != word[hit[:-1]]))[: len(hit)]]  # the leftmost of each word
        ids[hit] = rank[hit] % MADE
        over[hit + 1] = True  # goes, as its left neighbour holds it now
        ids, word = ids[~over], word[~over]
    word = np.concatenate(done_words)
    order = np.argsort(word, kind="stable")
    flat, ends = np.concatenate(done_ids)[order].astype("<u4").tobytes(), (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
    return [flat[lo:hi] for lo, hi in zip([0, *ends], ends)]


class LongWord:
    """One word's bytes in, ids out as soon as they are final. Holds no more than the lookahead and a block."""

    def __init__(self, vocab: Vocabulary, block: int = BLOCK) -> None:
        self.vocab, self.block, self.held = vocab, block, b""

    def feed(self, data: bytes) -> Iterator[int]:
        reach = self.vocab.lookahead + 1  # the last byte may turn out to end the word
        for lo in range(0, len(data), self.block):
            self.held += data[lo : lo + self.block]
            if len(self.held) < reach + self.block:
                continue
            ids, ends = merged_long([self.vocab.inner[b] for b in self.held[:-1]], self.vocab.ranks)
            final = int(np.searchsorted(ends, len(self.held) - reach, side="right"))
            yield from ids[:final]
            if final:
                self.held = self.held[ends[final - 1] :]

    def finish(self) -> list[int]:
        data, self.held = self.held, b""
        return self.vocab.word(data)

    @classmethod
    def whole(cls, vocab: Vocabulary, word: str) -> Iterator[int]:
        one = cls(vocab)
        yield from one.feed(word.encode())
        yield from one.finish()


def safe(c: str) -> bool:
    """Whether nothing before c can compose with it or be ordered after it."""
    return c < "̀" or (c < "\U00010000" and not "ᅠ" <= c <= "ᇿ" and not "ힰ" <= c <= "퟿" and unicodedata.combining(c) == 0 and unicodedata.category(c)[0] in "LNPSZ")


class Encoder:
    """Text in pieces of any size in, little-endian unsigned 32-bit ids out, or, by lines(), lists of runs of text (for
    Vocabulary.ids) among ids: whoever encodes many texts can learn many new runs at once."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.raw, self.rest = "", ""  # not yet normalised; normalised, but not yet cut
        self.word: LongWord | None = None  # a word without an end so far
        self.alike = ""  # a character that what continues it goes on from

    def feed(self, text: str) -> Iterator[bytes]:
        return (x if isinstance(x, bytes) else self.vocab.ids(x) for x in self.lines(text))

    def finish(self) -> Iterator[bytes]:
        return (x if isinstance(x, bytes) else self.vocab.ids(x) for x in self.last_lines())

    def lines(self, text: str) -> Iterator[bytes | list[str]]:
        for lo in range(0, len(text), CHUNK):
            self.raw += text[lo : lo + CHUNK]
            while "<" in self.raw and (mark := self.vocab.marks.search(self.raw)):
                rest, self.raw = self.raw[mark.end() :], self.raw[: mark.start()]
                yield from self.last_lines()  # nothing is normalised or merged across it
                yield packed([self.vocab.special[mark.group()]])
                self.raw = rest
            if cut := self._cut():
                head, self.raw = self.raw[:cut], self.raw[cut:]
                yield from self._words(self.normalised(head), False)

    def last_lines(self) -> Iterator[bytes | list[str]]:
        head, self.raw = self.raw, ""
        yield from self._words(self.normalised(head), True)

    def _cut(self) -> int:
        """The last place up to which raw can be normalised now: behind white space, or else before a safe character."""
        n = len(self.raw)
        if "<" in self.raw[-max(map(len, self.vocab.special), default=0) :]:
            for special in self.vocab.special:  # the start of one may stand at the end
                n = min(n, next((len(self.raw) - k for k in range(len(special) - 1, 0, -1) if self.raw.endswith(special[:k])), n))
        space = max(self.raw.rfind(c, 0, n) for c in SPACES) + 1
        if space:
            return space
        return next((i for i in range(min(n, len(self.raw) - 1), 0, -1) if safe(self.raw[i])), 0)

    def normalised(self, text: str) -> str:
        """As the file's rules say, which fold white space too; words don't depend on that."""
        if text.isascii():
            return text.lower()
        if not RARE.search(text):
            return unicodedata.normalize("NFC", text).lower()
        return self.vocab.library.normalizer.normalize_str(text)

    def _words(self, text: str, last: bool) -> Iterator[bytes | list[str]]:
        """Cuts runs; a word that touches the end stays open unless the text ends here."""
        text, self.rest = self.rest + text, ""
        if self.word is not None:
            end = len(self.vocab.words(self.alike + text)[0]) - 1
            if end:
                yield packed(self.word.feed(text[:end].encode()))
            if end == len(text) and not last:
                return
            yield packed(self.word.finish())
            self.word, text = None, text[end:]
        rare = RARE.search(text)
        runs = self.vocab.words(text) if rare else text.split()
        tail = ""
        if runs and not last and text.endswith(runs[-1]):
            if not rare:
                runs += self.vocab.words(runs.pop())
            if runs[-1] == "'" or (runs[-1] in ("r", "v", "l") and runs[-2:-1] == ["'"] and text.endswith("'" + runs[-1])):
                self.rest = "'" + runs.pop().removeprefix("'")  # the start of a contraction, maybe
                if runs and len(self.rest) > 1:
                    runs.pop()
            else:
                self.alike = self.kind(runs[-1])
                tail = runs.pop() if self.alike else ""
        yield runs
        if tail:
            self.word = LongWord(self.vocab)
            yield packed(self.word.feed(tail.encode()))

    def kind(self, word: str) -> str:
        """A character that a word goes on from like this one; none if nothing may be added to it."""
        if word in CONTRACTIONS:
            return ""
        return next((c for c in "a!" if len(self.vocab.words(c + word[0])) == 1), "")


def packed(ids: Iterable[int]) -> bytes:
    ids = list(ids)
    return struct.pack(f"<{len(ids)}I", *ids)


class Decoder:
    """Ids in pieces of any size in, text out.

    spelled: tokens as the file writes them, with a space between any two, as the library decodes with a file that
    names no decoder. Otherwise the text that the ids' bytes make, with a space at each word's end.
    """

    def __init__(self, vocab: Vocabulary, spelled: bool = True) -> None:
        self.table: list = vocab.spelled if spelled else vocab.token_bytes()
        self.spelled, self.due = spelled, ""
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        table = self.table
        if not self.spelled:
            return self.state.decode(b"".join([table[i] for i in ids]))
        text = " ".join([table[i] for i in ids])
        if text:
            text, self.due = self.due + text, " "
        return text

    def finish(self) -> str:
        return self.state.decode(b"", True)


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for part in portions(batch, "text", PORTION):
                found = encode_many(vocab, [text.as_py() or "" for text in part.column("text")])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "ids"])

    return run


def encode_many(vocab: Vocabulary, texts: Iterable[str]) -> list[bytes]:
    """The packed ids of each text. New runs are learnt whenever about WAITING runs have come together."""
    done: list[list] = []
    waiting: list[tuple[list, int]] = []
    count = 0

    def settle() -> None:
        nonlocal count
        missing = {r for line, i in waiting for r in line[i]}.difference(vocab.known)
        if len(vocab.known) > KNOWN:
            vocab.known.clear()
            missing = {r for line, i in waiting for r in line[i]}
        vocab.learn([r for r in missing if len(r) <= RUN_CHARS])
        for line, i in waiting:
            line[i] = vocab.ids(line[i])
        waiting.clear()
        count = 0

    for text in texts:
        encoder, line = Encoder(vocab), []
        done.append(line)
        for one in chain(encoder.lines(text), encoder.last_lines()):
            line.append(one)
            if not isinstance(one, bytes):
                waiting.append((line, len(line) - 1))
                count += len(one)
                if count > WAITING:
                    settle()
    settle()
    return [b"".join(line) for line in done]


def _decoded(path: str, spelled: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for part in portions(batch, "ids"):
                texts = []
                for ids in part.column("ids"):
                    decoder, numbers = Decoder(vocab, spelled), np.frombuffer(ids.as_py() or b"", "<u4")
                    texts.append("".join([*[decoder.feed(numbers[lo : lo + STEP].tolist()) for lo in range(0, len(numbers), STEP)], decoder.finish()]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return run


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) of every row. path: the vocabulary's file, the same on every executor."""
    short_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encoded(path or vocabulary_path()), "doc_id long, ids binary")


def decoded(rows: DataFrame, spelled: bool = True, path: str | None = None) -> DataFrame:
    """doc_id, ids, text of encoded() rows."""
    short_batches(rows.sparkSession)
    return rows.select("doc_id", "ids").mapInArrow(_decoded(path or vocabulary_path(), spelled), "doc_id long, ids binary, text string")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and of the decoded text."""
    rows = decoded(encoded(docs))
    return rows.select("doc_id", F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
