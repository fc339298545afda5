"""Splittable scan of giant JSON objects in any legal layout (see ``split_scan``).

Pieces end at commas, so an object on a single line is read by as many tasks as its size asks for. The
automaton follows strings, escapes, and the containers that lie open.

A run of entries whose values are all strings or null is decoded where it is found (the engine's reader interns every
key, which takes many times as long). Any other run is handed out as text and parsed by the engine,
so numbers and nested values read as they do from a whole file.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.sources.split_scan import Effect, scan

QUOTE, BACKSLASH, COMMA, COLON = b'"\\,:'
_IS_MARK = np.zeros(256, dtype=bool)
_IS_MARK[list(b"{}[],:")] = True
_STEP = np.zeros(256, dtype=np.int64)
_STEP[list(b"{[")] = 1
_STEP[list(b"}]")] = -1

# container kinds: an array, an object, and the object under the wanted key
ARRAY, OBJECT, WANTED = "aow"
#: What lies open at the entries that are handed out: the wanted object within a top-level object.
SCOPE = OBJECT + WANTED


class Tokens:
    """The structure of a text that begins inside a string or not: marks outside strings, and quotes."""

    def __init__(self, text: bytes, inside: bool, key: str):
        self.text, self.key = text, key
        data = np.frombuffer(text, dtype=np.uint8)
        quotes = np.flatnonzero(data == QUOTE)
        if BACKSLASH in text and len(quotes):  # a quote behind an odd number of backslashes is part of a string
            at = np.arange(len(data))
            other = np.r_[-1, np.maximum.accumulate(np.where(data == BACKSLASH, -1, at))]
            quotes = quotes[(quotes - 1 - other[quotes]) % 2 == 0]
        marks = np.flatnonzero(_IS_MARK[data])
        before = np.searchsorted(quotes, marks)
        outside = (before + inside) % 2 == 0
        self.marks, self.before, self.quotes = marks[outside], before[outside], quotes
        self.chars = data[self.marks]
        self.depth = np.cumsum(_STEP[self.chars])
        self.ends_inside = bool((len(quotes) + inside) % 2)

    def kind(self, no: int) -> str:
        """The kind of the container that mark ``no`` opens. A key that begins in an earlier chunk holds a comma,
        for chunks are cut at commas alone; so it is looked at only where it is whole."""
        if self.chars[no] == ord("["):
            return ARRAY
        if no and self.chars[no - 1] == COLON and (quotes := int(self.before[no - 1])) > 1:
            raw = self.text[self.quotes[quotes - 2]: self.quotes[quotes - 1] + 1]
            try:
                return WANTED if json.loads(raw) == self.key else OBJECT
            except ValueError:
                return OBJECT
        return OBJECT

    def effect(self) -> tuple[bool, int, str]:
        """Ends inside a string, containers closed that were open before, kinds of those opened and left open."""
        if not len(self.depth):
            return self.ends_inside, 0, ""
        closed = max(0, -int(self.depth.min()))
        lowest_from = np.minimum.accumulate(self.depth[::-1])[::-1]
        left = np.flatnonzero((_STEP[self.chars] == 1) & (lowest_from >= self.depth))
        return self.ends_inside, closed, "".join(self.kind(i) for i in left.tolist())


def runs(text: bytes, inside: bool, stack: str, key: str) -> Iterator[tuple[int, bytes]]:
    """Entries of the wanted objects in a text that begins in the given state: ``(part, text)``. Part 0: whole
    entries with the commas between them; 1: the start of an entry that goes on in the next chunk; 2: the
    next part of one; 3: its end."""
    t = Tokens(text, inside, key)
    depth = t.depth + len(stack)
    separators = t.marks[(t.chars == COMMA) & (depth == 2)]
    step = _STEP[t.chars]
    turns = np.flatnonzero(((step == 1) & (depth <= 2)) | ((step == -1) & (depth <= 1))).tolist()

    def cut(start: int, end: int, goes_on: bool, closed: bool) -> Iterator[tuple[int, bytes]]:
        inner = separators[np.searchsorted(separators, start): np.searchsorted(separators, end)]
        if goes_on:
            if not len(inner):
                yield (3 if closed else 2), text[start:end]
                return
            yield 3, text[start: inner[0]]
            start = int(inner[0]) + 1
        if not closed:
            last = int(inner[-1]) + 1 if len(inner) else start
            whole, rest = text[start: max(start, last - 1)], text[last:end]
            if rest.strip():
                yield 1, rest
        else:
            whole = text[start:end]
        if whole.strip():
            yield 0, whole

    begin, goes_on = 0, inside or len(stack) > 2
    path = stack[:2]
    for no in turns:
        at = int(t.marks[no])
        if step[no] == 1:
            path = path[: int(depth[no]) - 1] + t.kind(no)
            begin, goes_on = at + 1, False
        else:
            if path == SCOPE and depth[no] == 1:
                yield from cut(begin, at, goes_on, True)
            path = path[: int(depth[no])]
    if path == SCOPE:
        yield from cut(begin, len(text), goes_on, False)


def decoded(run: bytes) -> list[tuple[str, str | None]] | None:
    """The entries of a run if they are legal and all values are strings or null."""
    try:
        pairs = json.loads(b"{" + run + b"}", object_pairs_hook=list)
        if all(v is None or type(v) is str for _, v in pairs):
            "".join(x for pair in pairs for x in pair if x).encode()  # no half surrogates
            return pairs
    except ValueError:
        pass
    return None


class ObjectEntries:
    """The automaton of ``split_scan`` for the entries of the object under ``key``."""

    separator = ","

    def __init__(self, key: str):
        self.key = key

    def effect(self, text: bytes) -> Effect:
        return Tokens(text, False, self.key).effect(), Tokens(text, True, self.key).effect()

    def runs(self, text: bytes, inside: bool, stack: str) -> Iterator[tuple[int, bytes]]:
        return runs(text, inside, stack, self.key)

    def overhangs(self, inside: bool, stack: str) -> bool:
        return stack[:2] == SCOPE and (inside or len(stack) > 2)


def _entries(first: bool, found: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    """``key, value`` of decoded entries, ``run`` of the others."""
    for text in found:
        pairs = decoded(text)
        if pairs != []:
            keys, values = zip(*pairs) if pairs else ((None,), (None,))
            raw = [text.decode() if pairs is None else None] * len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(values, pa.string()),
                                              pa.array(raw, pa.string())], names=["key", "value", "run"])


def object_entries(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The entries of every top-level object's object under ``key``: ``key, value`` of each, or ``run``, JSON text of one or
    more entries without the braces around it, for the engine to parse. ``path`` is read with all its
    sub-folders."""
    whole, overhanging = scan(spark, path, ObjectEntries(key), _entries, "key string, value string, run string",
                              recursiveFileLookup="true")
    none = F.lit(None).cast("string")
    return whole.unionByName(overhanging.select(none.alias("key"), none.alias("value"), "run"))
