"""Scopes of many returns at once.

Expat says whether each return is well-formed; Arrow's string kernels cut those that are into tags and texts, and arrays of
their depths say what lies within what. That holds for plain returns, where each < begins a tag: returns with comments,
CDATA, document types, processing instructions or carriage returns, with namespaces declared below their root, with both kinds
of quotes (or half a pair) before the first > of a tag, or with groups within groups or blocks within blocks, are odd, and
left to the caller.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from xml.parsers import expat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ROOT_TAG = re.compile(r"""<([^\s/>"'=<]+)((?:\s+[^\s="'<>]+\s*=\s*(?:"[^"<]*"|'[^'<]*'))*)\s*/?""")
ATTRIBUTE = re.compile(r"""([^\s="'<>]+)\s*=\s*(?:"([^"]*)"|'([^']*)')""")
REFERENCE = re.compile(r"&(?:#x([0-9a-fA-F]+)|#([0-9]+)|([a-z]+));")
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}
#: Root tags whose prefix is remembered.
REMEMBERED = 10_000


def root_prefix(tag: str) -> str | None:
    """What begins the names in the root's namespace, where the root alone declares namespaces; None if it can't be told."""
    read = ROOT_TAG.fullmatch(tag)
    if read is None:
        return None
    spaces = [(name, double + single) for name, double, single in ATTRIBUTE.findall(read[2]) if name.startswith("xmlns")]
    uris = [uri for _, uri in spaces]
    if len(set(uris)) < len(uris) or any(name == "xmlns:xml" for name, _ in spaces) or any(re.search(r"[&\s]", uri) for uri in uris):
        return None
    outer, colon, _ = read[1].partition(":")
    return outer + colon if colon else ""


def well_formed(value: str) -> bool:
    try:
        expat.ParserCreate("utf-8", "}").Parse(value, True)
    except expat.ExpatError:
        return False
    return True


def unescaped(values: pa.Array) -> pa.Array:
    """Texts with their references replaced, and without white space around them."""
    escaped = pc.match_substring(values, "&")
    if pc.any(escaped).as_py():
        if pc.any(pc.match_substring(values, "&#")).as_py():
            one = lambda m: chr(int(m[1], 16)) if m[1] else chr(int(m[2])) if m[2] else ENTITIES[m[3]]
            values = pa.array([REFERENCE.sub(one, v) if "&" in v else v for v in values.to_pylist()], pa.string())
        else:
            for name, of in ENTITIES.items():  # the ampersand's own comes last
                values = pc.replace_substring(values, f"&{name};", of)
    return pc.utf8_trim_whitespace(values)


def _within(starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each place the scope that it lies in, or -1; scopes don't overlap, and a scope's own tag is not in it."""
    scope = np.searchsorted(starts, at) - 1
    return np.where((scope >= 0) & (at < np.append(ends, -1)[scope]), scope, -1)


class Kind:
    """The names of one kind of scope: which tags have a text of theirs."""

    def __init__(self, names: Sequence[str]) -> None:
        self.names = list(dict.fromkeys(names))
        self.keys = pa.array(self.names, pa.string())
        self.single = {n: i for i, n in enumerate(self.names) if "/" not in n}
        pairs = [(*n.partition("/")[::2], i) for i, n in enumerate(self.names) if "/" in n]
        self.outer = {o: k for k, o in enumerate(dict.fromkeys(o for o, _, _ in pairs))}
        self.inner = {x: k for k, x in enumerate(dict.fromkeys(x for _, x, _ in pairs))}
        self.pairs = np.full((len(self.outer) + 1, len(self.inner) + 1), -1)  # the last ones: no such tag
        for o, x, i in pairs:
            self.pairs[self.outer[o], self.inner[x]] = i


class Tags:
    """Tags and texts of plain, well-formed returns with one prefix. Tokens are numbered over all of them."""

    def __init__(self, values: pa.Array, prefix: str) -> None:
        tokens = pc.split_pattern(values, "<")
        at = tokens.offsets.to_numpy()
        flat = tokens.flatten()
        begun = np.ones(len(flat), bool)
        begun[at[:-1] - at[0]] = False  # what comes before a return's first tag
        self.row = np.repeat(np.arange(len(values)), np.diff(at) - 1)
        self.pieces = pc.split_pattern(flat.filter(pa.array(begun)), ">", max_splits=1).flatten()
        n = len(self.row)
        tags = self.pieces.take(pa.array(np.arange(0, 2 * n, 2))).dictionary_encode()
        self.code = tags.indices.to_numpy()
        known = tags.dictionary.to_pylist()
        read = [self.tag(t, prefix) for t in known]
        self.begins = np.array([t[0] not in "?/" for t in known], bool)[self.code]
        self.names = [name for name, _, _ in read]
        delta = np.array([d for _, d, _ in read], np.int8)[self.code]
        self.odd = np.unique(self.row[np.array([o for _, _, o in read], bool)[self.code]])
        if len(self.odd):
            return
        depth = np.cumsum(delta, dtype=np.int32)
        self.level = (depth + (delta <= 0)).astype(np.int32)
        self.open = delta > 0
        both = np.flatnonzero(delta != 0)
        both = both[np.argsort(self.level[both], kind="stable")]  # at each level an element's begin and its end take turns
        self.end = np.arange(n)
        self.end[both[0::2]] = both[1::2]

    @staticmethod
    def tag(text: str, prefix: str) -> tuple[str | None, int, bool]:
        """(name, if an element of the namespace begins; how the depth changes; whether the tag is odd)."""
        if text[0] in "?/":
            return None, -(text[0] == "/"), False
        alone = text[-1] == "/"
        double, single = text.count('"'), text.count("'")
        name = text[: len(text) - alone].split(None, 1)[0]
        own = name.startswith(prefix) and (prefix != "" or ":" not in name)
        return name[len(prefix) :] if own else None, 0 if alone else 1, bool(double % 2 or single % 2 or (double and single))

    def of_codes(self, numbers: dict[str, int], none: int = -1) -> np.ndarray:
        return np.array([none if n is None else numbers.get(n, none) for n in self.names], np.int64)

    def named(self, numbers: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """The elements below a root that have one of the names, in order, and the names' numbers."""
        which = self.of_codes(numbers)
        at = np.flatnonzero((which >= 0)[self.code] & (self.level > 1))
        return at, which[self.code[at]]

    def parents(self, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), np.int64)
        for level in np.unique(self.level[at]):
            mine = self.level[at] == level
            above = np.flatnonzero(self.open & (self.level == level - 1))
            out[mine] = above[np.searchsorted(above, at[mine]) - 1]
        return out

    def texts(self, kind: Kind, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scope, name, element) of the first element of each name in each scope; of names parent/child, the first child of
        the first such parent that has one. In the order of scopes."""
        at, name = self.named(kind.single)
        first = at
        if kind.inner:
            below, inner = self.named(kind.inner)
            parents = self.parents(below)
            both = kind.pairs[self.of_codes(kind.outer, len(kind.outer))[self.code[parents]], inner]
            hit = both >= 0
            at, name, first = np.concatenate((at, below[hit])), np.concatenate((name, both[hit])), np.concatenate((first, parents[hit]))
        scope = _within(starts, ends, at)
        inside = np.flatnonzero(scope >= 0)
        key = scope[inside] * len(kind.names) + name[inside]
        order = inside[np.lexsort((at[inside], first[inside], key))]
        key = scope[order] * len(kind.names) + name[order]
        order = order[np.concatenate(([True], key[1:] != key[:-1]))[: len(order)]]
        return scope[order], name[order], at[order]

    def maps(self, kind: Kind, scopes: np.ndarray, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Array:
        """A map for each of scopes (numbers, each once, or -1 for null), of what texts() found."""
        scope, name, at = found
        count = np.append(np.bincount(scope, minlength=scopes.max(initial=-1) + 1), 0)
        begin = np.cumsum(count) - count
        sizes = count[scopes]
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        order = np.arange(offsets[-1]) + np.repeat(begin[scopes] - offsets[:-1], sizes)
        at = at[order]
        values = self.pieces.take(pa.array(2 * at + 1, mask=~self.open[at])).fill_null("")  # no text in <a/>
        offsets = pa.array(offsets.astype(np.int32), mask=np.append(scopes < 0, False))
        return pa.MapArray.from_arrays(offsets, kind.keys.take(pa.array(name[order])), unescaped(values))


class Scan:
    """root, filer and groups of returns. names: of each kind of scope; groups: tags of groups; blocks: of their blocks."""

    def __init__(self, names: dict[str, Sequence[str]], groups: Sequence[str], blocks: Sequence[str]) -> None:
        self.kinds = {k: Kind(n) for k, n in names.items()}
        self.groups, self.blocks = list(groups), list(blocks)
        self.roots: dict[str, str | None] = {}

    def prefix(self, value: str) -> str | None:
        """The root's prefix; None if the return isn't plain."""
        declared = value.startswith("<?")
        root = value.find("<", 1 if declared else 0)
        end = value.find(">", root)
        if root < 0 or end < 0 or (declared and value.find("?>") > root):
            return None
        if "<!" in value or "\r" in value or value.find("<?", 1) >= 0 or value.find("xmlns", end) >= 0:
            return None
        tag = value[root:end]
        if tag not in self.roots:
            if len(self.roots) >= REMEMBERED:
                self.roots.clear()
            self.roots[tag] = root_prefix(tag)
        return self.roots[tag]

    def __call__(self, values: pa.Array) -> tuple[list[tuple[np.ndarray, pa.Array, pa.Array, pa.Array]], np.ndarray, np.ndarray]:
        """(rows, root, filer, groups) of plain returns, by their prefix; rows that aren't well-formed; odd rows."""
        bad, odd, plain = [], [], {}
        for i, value in enumerate(values.to_pylist()):
            prefix = self.prefix(value or "")
            if prefix is None:
                odd.append(i)
            elif well_formed(value):
                plain.setdefault(prefix, []).append(i)
            else:
                bad.append(i)
        found = []
        for prefix, some in plain.items():
            rows = np.array(some)
            while len(rows):
                read = self.read(values.take(pa.array(rows)), prefix)
                if not isinstance(read, np.ndarray):
                    found.append((rows, *read))
                    break
                odd += rows[read].tolist()
                rows = np.delete(rows, read)
        return found, np.array(bad, np.int64), np.array(sorted(odd), np.int64)

    def read(self, values: pa.Array, prefix: str) -> tuple[pa.Array, pa.Array, pa.Array] | np.ndarray:
        """(root, filer, groups) of plain returns, or which of them are odd after all."""
        tags = Tags(values, prefix)
        if len(tags.odd):
            return tags.odd
        n = len(values)
        roots = np.flatnonzero((tags.level == 1) & tags.begins)
        root = tags.maps(self.kinds["root"], np.arange(n), tags.texts(self.kinds["root"], roots, tags.end[roots]))
        at, _ = tags.named({"Filer": 0})
        rows, first = np.unique(tags.row[at], return_index=True)
        of = np.full(n, -1)
        of[rows] = np.arange(len(rows))
        filer = tags.maps(self.kinds["filer"], of, tags.texts(self.kinds["filer"], at[first], tags.end[at[first]]))
        at, tag = tags.named({t: i for i, t in enumerate(self.groups)})
        ends = tags.end[at]
        blocks, name = tags.named({b: i for i, b in enumerate(self.blocks)})
        group = _within(at, ends, blocks)
        _, first = np.unique(np.where(group >= 0, group * len(self.blocks) + name, -1), return_index=True)
        first = np.sort(first[group[first] >= 0])
        blocks, name, group = blocks[first], name[first], group[first]
        odd = np.concatenate([tags.row[x[1:][x[1:] < tags.end[x[:-1]]]] for x in (at, blocks)])
        if len(odd):
            return np.unique(odd)
        order = np.lexsort((at, tag, tags.row[at]))  # a return's groups by their tags, then as they come
        texts = tags.maps(self.kinds["group"], order, tags.texts(self.kinds["group"], at, ends))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        of_group = np.argsort(rank[group], kind="stable")
        inner = tags.maps(self.kinds["block"], of_group, tags.texts(self.kinds["block"], blocks, tags.end[blocks]))
        inside = np.concatenate(([0], np.cumsum(np.bincount(rank[group], minlength=len(order)))))
        within = pa.MapArray.from_arrays(pa.array(inside.astype(np.int32)), pa.array(self.blocks, pa.string()).take(pa.array(name[of_group])), inner)
        grouped = pa.StructArray.from_arrays([pa.array(self.groups, pa.string()).take(pa.array(tag[order])), texts, within], ["tag", "texts", "blocks"])
        held = np.concatenate(([0], np.cumsum(np.bincount(tags.row[at], minlength=n))))
        return root, filer, pa.ListArray.from_arrays(pa.array(held.astype(np.int32)), grouped)
