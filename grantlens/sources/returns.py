"""XML returns of several schema generations, flattened to grants.

Files are read whole, and each is parsed once, whatever its namespace prefix or nesting: a return becomes scopes (the
return itself, its filer, and every grant group with its address blocks), and a scope is a map from the element names, and
parent/child names, that rules ask for to the text of the first such element anywhere within it. Every rule is a look-up in
those maps.
Texts stay strings (never inferred: identifiers keep their zeros). Element names come from functions.fixed, in order of
preference. Two rules differ on purpose: names fall through empty elements; other fields take the first element that
exists, even an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text
from .scan import Scan

#: A scope's texts; a group's tag, texts, and those of its blocks by tag.
MAP = "map<string, string>"
SCOPES = f"path string, bad boolean, root {MAP}, filer {MAP}, groups array<struct<tag: string, texts: {MAP}, blocks: map<string, {MAP}>>>"
KEPT = ["path", "bad", "root", "filer", "groups"]
#: The names that rules look up in each kind of scope; texts of others stay out of the maps.
NAMES = {
    "root": ["ReturnTs", fixed.FOUNDATION_FORM, *fixed.TAX_YEAR, *fixed.PERIOD_END, *fixed.FILER_FLAGS],
    "filer": ["EIN", *fixed.FILER_NAMES],
    "group": [*fixed.RECIPIENT_NAMES, *fixed.PERSON_NAMES, *fixed.RECIPIENT_EINS, *fixed.AMOUNTS, *fixed.PURPOSES],
    "block": [*fixed.LINE1, *fixed.LINE2, *fixed.CITY, *fixed.DOMESTIC_STATE, *fixed.DOMESTIC_ZIP, *fixed.FOREIGN_STATE, *fixed.FOREIGN_ZIP, *fixed.FOREIGN_COUNTRY],
}
BLOCKS = [*fixed.DOMESTIC_BLOCKS, *fixed.FOREIGN_BLOCKS]
#: Returns, and bytes of them, whose scopes a Python worker holds at a time; a return of more is held alone.
HELD, HELD_BYTES = 512, 4 << 20


def _looked_up(space: str, names: Sequence[str], marked: Sequence[str]) -> dict[str, tuple]:
    """By tag, in a namespace: (the name, if it is one of names; names parent/child by the child's tag; whether it is marked)."""
    found: dict[str, list] = {}
    at = lambda name: found.setdefault(space + name, [None, {}, None])
    for name in names:
        outer, _, inner = name.partition("/")
        if inner:
            at(outer)[1][space + inner] = name
        else:
            at(outer)[0] = name
    for name in marked:
        at(name)[2] = name
    return {tag: tuple(x) for tag, x in found.items()}


class Scopes:
    """Reads a return's scopes, each in one pass. Only elements in the root's namespace count, as names without it."""

    def __init__(self, names: dict[str, Sequence[str]], groups: bool) -> None:
        self.names, self.tags, self.known = names, fixed.GROUPS if groups else [], {}

    def rules(self, space: str) -> list[dict[str, tuple]]:
        if space not in self.known:
            if len(self.known) >= 64:  # returns may name as many namespaces as they like
                self.known.clear()
            marked = {"root": ["Filer", *self.tags], "filer": [], "group": BLOCKS, "block": []}
            self.known[space] = [_looked_up(space, self.names[kind], marked[kind]) for kind in marked]
        return self.known[space]

    def texts(self, scope: ElementTree.Element, rules: dict[str, tuple]) -> tuple[dict[str, str], dict[str, list[ElementTree.Element]]]:
        """The first text of each name, and of each name below each, anywhere within scope (an element without text has an
        empty one), and the marked elements below it, in the document's order."""
        found: dict[str, str] = {}
        marked: dict[str, list[ElementTree.Element]] = {}
        get = rules.get
        for element in scope.iter():
            rule = get(element.tag)
            if rule is None:
                continue
            name, inner, mark = rule
            if element is not scope:
                if name is not None and name not in found:
                    found[name] = (element.text or "").strip()
                if mark is not None:
                    marked.setdefault(mark, []).append(element)
            if inner:
                for child in element:
                    both = inner.get(child.tag)
                    if both is not None and both not in found:
                        found[both] = (child.text or "").strip()
        return found, marked

    def __call__(self, value: str) -> tuple[dict, dict | None, list[tuple[str, dict, dict[str, dict]]]]:
        """Texts of the return and of its filer, and (tag, texts, texts of blocks) of each group."""
        root = ElementTree.fromstring(value)
        in_root, in_filer, in_group, in_block = self.rules(root.tag[: root.tag.find("}") + 1] if root.tag.startswith("{") else "")
        own, marked = self.texts(root, in_root)
        filer = self.texts(marked["Filer"][0], in_filer)[0] if "Filer" in marked else None
        groups = []
        for tag in self.tags:
            for group in marked.get(tag, ()):
                texts, blocks = self.texts(group, in_group)
                groups.append((tag, texts, {name: self.texts(some[0], in_block)[0] for name, some in blocks.items()}))
        return own, filer, groups


class _Maps:
    """A column of maps, entry by entry."""

    def __init__(self) -> None:
        self.at, self.keys, self.values = [], [], []

    def add(self, entries: dict | None) -> None:
        self.at.append(None if entries is None else len(self.keys))
        if entries:
            self.keys += entries
            self.values += entries.values()

    def array(self, values: pa.Array | None = None) -> pa.Array:
        at = pa.array([*self.at, len(self.keys)], pa.int32())
        return pa.MapArray.from_arrays(at, pa.array(self.keys, pa.string()), pa.array(self.values, pa.string()) if values is None else values)


def _scopes(read: Scopes, batch: pa.RecordBatch) -> pa.RecordBatch:
    """SCOPES, return by return: what holds for any XML."""
    bad, tags, starts = [], [], []
    roots, filers, texts, blocks, inner = _Maps(), _Maps(), _Maps(), _Maps(), _Maps()
    for value in batch.column("value").to_pylist():
        try:
            root, filer, groups = read(value or "")
        except ElementTree.ParseError:
            root, filer, groups = None, None, []
        bad.append(root is None)
        roots.add(root)
        filers.add(filer)
        starts.append(len(tags))
        for tag, own, within in groups:
            tags.append(tag)
            texts.add(own)
            blocks.add(within)
            for some in within.values():
                inner.add(some)
    grouped = pa.StructArray.from_arrays([pa.array(tags, pa.string()), texts.array(), blocks.array(inner.array())], ["tag", "texts", "blocks"])
    grouped = pa.ListArray.from_arrays(pa.array([*starts, len(tags)], pa.int32()), grouped)
    return pa.RecordBatch.from_arrays([batch.column("path"), pa.array(bad), roots.array(), filers.array(), grouped], KEPT)


def _read(scan: Scan, read: Scopes, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """SCOPES of a batch: plain returns together, odd ones each by itself."""
    plain, bad, odd = scan(batch.column("value"))
    paths = batch.column("path")
    for rows, root, filer, groups in plain:
        yield pa.RecordBatch.from_arrays([paths.take(pa.array(rows)), pa.array(np.zeros(len(rows), bool)), root, filer, groups], KEPT)
    if len(bad):
        texts = pa.map_(pa.string(), pa.string())
        group = pa.struct([("tag", pa.string()), ("texts", texts), ("blocks", pa.map_(pa.string(), texts))])
        none = pa.ListArray.from_arrays(pa.array(np.zeros(len(bad) + 1, np.int32)), pa.array([], group))
        yield pa.RecordBatch.from_arrays([paths.take(pa.array(bad)), pa.array(np.ones(len(bad), bool)), pa.nulls(len(bad), texts), pa.nulls(len(bad), texts), none], KEPT)
    if len(odd):
        yield _scopes(read, batch.take(pa.array(odd)))


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of HELD returns and HELD_BYTES at most."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("value")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        most = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + HELD_BYTES, "right"))
        hi = min(max(most, lo + 1), lo + HELD, batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi


def parsed(returns: DataFrame, names: dict[str, Sequence[str]] | None = None, groups: bool = True) -> DataFrame:
    """SCOPES of returns (path, value); bad: not well-formed, with no scopes. names: what to look for in each kind of scope,
    else NAMES; groups: or leave them empty, where only the header counts."""
    names = NAMES | (names or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, scan = Scopes(names, groups), Scan(names, fixed.GROUPS if groups else [], BLOCKS)
        for batch in batches:
            for some in _portions(batch):
                yield from _read(scan, read, some)

    return returns.select("path", "value").mapInArrow(run, SCOPES)


def existing(texts: Column, names: Sequence[str]) -> Column:
    """The text of the first element that exists, empty if it has none; null if none exists."""
    return F.coalesce(*[F.try_element_at(texts, F.lit(n)) for n in names])


def filled(texts: Column, paths: Sequence[str]) -> Column:
    """The first text that isn't empty."""
    return F.coalesce(*[F.nullif(F.try_element_at(texts, F.lit(p)), F.lit("")) for p in paths])


def flagged(root: Column, tags: Sequence[str] = fixed.FILER_FLAGS) -> Column:
    """Whether the first element of any of the tags holds X."""
    hit = F.lit(False)
    for t in tags:
        hit = hit | F.coalesce(F.upper(F.try_element_at(root, F.lit(t))) == "X", F.lit(False))
    return hit


def _first_block(blocks: Column, names: Sequence[str]) -> Column:
    return F.coalesce(*[F.try_element_at(blocks, F.lit(n)) for n in names])


def _address(home: Column, block: Column) -> dict[str, Column]:
    """The parts of an address in a block; home: whether it is a domestic one."""
    value = lambda names: F.coalesce(existing(block, names), F.lit(""))
    either = lambda domestic, foreign: F.when(home, domestic).when(block.isNotNull(), foreign).otherwise("")
    return {
        "line1": value(fixed.LINE1), "line2": value(fixed.LINE2), "city": value(fixed.CITY),
        "state": either(value(fixed.DOMESTIC_STATE), value(fixed.FOREIGN_STATE)), "zip": either(value(fixed.DOMESTIC_ZIP), value(fixed.FOREIGN_ZIP)),
        "country": either(F.lit("US"), value(fixed.FOREIGN_COUNTRY)), "type": either(F.lit("US"), F.lit("Foreign")),
    }


def address(blocks: Column) -> Column:
    """line1, line2, city, state, zip, country, type: a domestic block wins over a foreign one; neither: empty."""
    home = _first_block(blocks, fixed.DOMESTIC_BLOCKS)
    parts = _address(home.isNotNull(), F.coalesce(home, _first_block(blocks, fixed.FOREIGN_BLOCKS)))
    return F.struct(*[c.alias(n) for n, c in parts.items()])


def read_returns(spark: SparkSession, path: str) -> DataFrame:
    """path, value of every .xml file under path."""
    df = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.xml")
    return df.select(F.col("_metadata.file_path").alias("path"), "value")


def listed(returns: DataFrame, manifest: DataFrame) -> DataFrame:
    """The returns (path, value) that a manifest lists, with its form_type; listed ones that are gone drop out."""
    of = manifest.groupBy(F.col("xml_path").alias("listed_path")).agg(F.min("form_type").alias("form_type"))
    return returns.join(of, F.col("path") == F.col("listed_path")).drop("listed_path")


def filings(returns: DataFrame, groups: bool = True, names: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One row a return that has a filer: its file, header fields, flag, status, whether it holds the form of foundations,
    and its groups (groups: or none of them, where only the header counts; names: as in parsed()). status: ok or malformed."""
    root, filer = F.col("root"), F.col("filer")
    file = F.element_at(F.split("path", "/"), -1)
    year = F.coalesce(F.nullif(existing(root, fixed.TAX_YEAR), F.lit("")), F.substring(F.nullif(existing(root, fixed.PERIOD_END), F.lit("")), 1, 4), F.lit(""))
    return parsed(returns, names, groups).filter(F.col("bad") | filer.isNotNull()).select(
        file.alias("xml_file"),
        F.when(F.col("bad"), "malformed").otherwise("ok").alias("status"),
        F.coalesce(filled(filer, fixed.FILER_NAMES), F.lit("")).alias("filer_name"),
        F.coalesce(existing(filer, ["EIN"]), F.lit("")).alias("filer_ein"),
        year.alias("return_year"),
        text.timestamp_or_first(existing(root, ["ReturnTs"])).alias("return_ts"),
        F.regexp_extract(file, r"^(\d*)", 1).alias("submission_id"),
        flagged(root).alias("filer_support_org"),
        F.coalesce(F.map_contains_key(root, fixed.FOUNDATION_FORM), F.lit(False)).alias("foundation_form"),
        "groups",
    )


def grantee(group: Column) -> Column:
    """The name of a group's recipient: an organisation's before a person's."""
    texts = group["texts"]
    return F.coalesce(filled(texts, fixed.RECIPIENT_NAMES), F.nullif(existing(texts, fixed.PERSON_NAMES), F.lit("")), F.lit(""))


def amount(group: Column) -> Column:
    return F.coalesce(existing(group["texts"], fixed.AMOUNTS), F.lit(""))


def grants(files: DataFrame, keep_flagged: bool = True) -> DataFrame:
    """One row a grant group, in the order of tags and then of the document (pos). keep_flagged: or drop such filers' returns."""
    df = files.filter("status = 'ok'")
    if not keep_flagged:
        df = df.filter("NOT filer_support_org")
    df = df.select("xml_file", "filer_name", "filer_ein", "return_year", "filer_support_org", F.posexplode("groups").alias("pos", "g"))
    # the block is a column of its own, so it is looked up once a grant and not once a look-up in it
    df = df.withColumn("home", _first_block(F.col("g.blocks"), fixed.DOMESTIC_BLOCKS))
    df = df.withColumn("block", F.coalesce("home", _first_block(F.col("g.blocks"), fixed.FOREIGN_BLOCKS)))
    g, empty, parts = F.col("g"), lambda c: F.coalesce(c, F.lit("")), _address(F.col("home").isNotNull(), F.col("block"))
    return df.select(
        "xml_file", "filer_name", "filer_ein", "return_year", "filer_support_org", "pos",
        grantee(g).alias("grantee"),
        empty(existing(g["texts"], fixed.RECIPIENT_EINS)).alias("recipient_ein"),
        *[parts[n].alias(f"grantee_{c}") for n, c in (("line1", "addr1"), ("line2", "addr2"), ("city", "city"), ("state", "state"), ("zip", "zip"), ("country", "country"), ("type", "addr_type"))],
        amount(g).alias("grant_amount"),
        empty(existing(g["texts"], fixed.PURPOSES)).alias("grant_purpose"),
    )


def to_recipients(rows: DataFrame) -> DataFrame:
    """Grants to recipients that pass the three-tier keyword filter."""
    return rows.filter(text.keyword_filter(F.col("grantee")))
