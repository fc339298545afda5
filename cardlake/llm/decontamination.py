"""Benchmark decontamination: an FM-index per training shard, searched backwards for test phrases.

A phrase is a window of ten consecutive words of a benchmark item; an item with fewer words is one
phrase. Every task cuts its rows into shards of about half a million words (a longer text into
overlapping pieces), numbers the words of a shard, and builds the shard's FM-index once for all its
phrases: backward search through wavelet-matrix ranks gives the rows of each phrase, sampled suffix
positions give the places, and overlapping places of a document merge into removal spans. Equal
texts of a shard are indexed once. Words are numbered by their bytes, so a match is a match and
needs no check.

The documents are mapped over, never shuffled. Phrases reach the tasks in blocks of bounded
bytes; where there are several blocks, each is one more pass, over a written table that
holds what the passes before it found, so the driver and a task hold one block at a time.

Defined results: a null or empty text has no words and no hits; an item without words is no item, a null
``item_id`` is the name ''. Items that share an id count as one. Rows that repeat a document, an id
or an item are treated alike, null ids included. A text of any length is searched whole: pieces
overlap by one word less than a phrase. All columns of the documents are carried in ``doc``, whatever
their names. An empty table on either side gives no hits.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.fm_index import FMIndex
from cardlake.llm.tables import python_tasks, written
from cardlake.llm.words import utf8

WIDTH = 10
SHARD_WORDS = 1 << 19
#: Phrases (words and item ids) that a task and the driver hold at a time.
BLOCK_BYTES = 16 << 20

# Words are runs of digits, letters and all bytes from 0x80 on; A-Z are lower-cased.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                  for b in range(256))
_WORD_REGEX = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SPAN = pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_SPAN_DDL = "array<struct<first_word:long,end_word:long,start:long,end:long>>"


def phrases(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``phrase`` (words joined by one blank) and ``item``, distinct."""
    words = F.regexp_extract_all(F.translate(F.col(text_col), _UPPER, _LOWER), F.lit(_WORD_REGEX), F.lit(0))
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words.alias("words"))
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - (width - 1), F.lit(1))),
                          lambda at: F.array_join(F.slice("words", at, width), " "))
    return items.where(F.size("words") > 0).select(F.explode(windows).alias("phrase"), "item").distinct()


class Block:
    """A bounded set of phrases as rows of word numbers."""

    def __init__(self, rows: list[tuple[bytes, list[str]]], width: int):
        number: defaultdict[bytes, int] = defaultdict(count(1).__next__)
        self.matrix = np.zeros((len(rows), width), dtype=np.int64)
        for i, (phrase, _) in enumerate(rows):
            words = phrase.split(b" ")
            self.matrix[i, width - len(words):] = [number[w] for w in words]
        self.lengths = (self.matrix > 0).sum(axis=1)
        self.words = list(number)
        self.items = [items for _, items in rows]
        self.width = width

    def places(self, texts: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, first word, phrase) arrays of all occurrences; builds the index of the texts."""
        number: defaultdict[bytes, int] = defaultdict(count(1).__next__)
        pieces, owner, begin = [], [], []
        for no, words in enumerate(texts):
            ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
            for at in range(0, max(1, len(ids) - self.width + 1), SHARD_WORDS):
                pieces.append(ids[at: at + SHARD_WORDS + self.width - 1])
                owner.append(no)
                begin.append(at)
        if not number:
            return
        known = np.array([0, *(number.get(w, -1) for w in self.words)], dtype=np.int64)
        index = FMIndex(pieces, len(number))
        found, low, high = index.search(known[self.matrix])
        owner, begin = np.array(owner), np.array(begin)
        for which, piece, offset in index.locate(low, high):
            yield owner[piece], begin[piece] + offset, found[which]


def _word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code point offsets of the words' starts and ends."""
    flags = np.frombuffer(raw.translate(_TO_WORDS), dtype=np.uint8) != 32
    edge = np.diff(np.r_[False, flags, False].astype(np.int8))
    points = np.cumsum(np.r_[0, (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80])
    return points[np.flatnonzero(edge == 1)], points[np.flatnonzero(edge == -1)]


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words [first, end) as disjoint runs that do not touch."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def _judge(raws: list[bytes], before: list[tuple[list, list]], block: Block) -> list[tuple[int, list, list]]:
    """Words, spans and items of each text of a shard, with those found ``before``."""
    number: dict[bytes, int] = {}
    texts: list[list[bytes]] = []
    which = []
    for raw in raws:
        no = number.setdefault(raw, len(number))
        if no == len(texts):
            texts.append(raw.translate(_TO_WORDS).split())
        which.append(no)
    covered: dict[int, np.ndarray] = {}
    items: dict[int, set[str]] = {}
    for text, first, phrase in block.places(texts):
        by_text = np.argsort(text, kind="stable")
        cuts = np.flatnonzero(np.diff(text[by_text])) + 1
        for mine in np.split(by_text, cuts):
            no = int(text[mine[0]])
            step = covered.setdefault(no, np.zeros(len(texts[no]) + 1, dtype=np.int64))
            np.add.at(step, first[mine], 1)
            np.add.at(step, first[mine] + block.lengths[phrase[mine]], -1)
            items.setdefault(no, set()).update(i for p in np.unique(phrase[mine]).tolist() for i in block.items[p])
    out = []
    for raw, no, (spans, named) in zip(raws, which, before):
        if no in covered:
            hit = np.diff(np.r_[0, np.cumsum(covered[no][:-1]) > 0, 0].astype(np.int8))
            runs = list(zip(np.flatnonzero(hit == 1).tolist(), np.flatnonzero(hit == -1).tolist()))
            runs = _merged(runs + [(s["first_word"], s["end_word"]) for s in spans])
            starts, ends = _word_bounds(raw)
            spans = [{"first_word": a, "end_word": b, "start": int(starts[a]), "end": int(ends[b - 1])} for a, b in runs]
            named = sorted(items[no].union(named))
        out.append((len(texts[no]), spans, named))
    return out


def _search(docs: DataFrame, block: Block) -> DataFrame:
    """One pass: ``doc, text, n_words, spans, items`` in, the same out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        raws: list[bytes] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            before = [pair for b in held for pair in zip(b.column(3).to_pylist(), b.column(4).to_pylist())]
            judged = iter(_judge(raws, before, block))
            for b in held:
                rows = [next(judged) for _ in range(b.num_rows)]
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(1), pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.list_(_SPAN)), pa.array([r[2] for r in rows], pa.list_(pa.string())),
                ], names=["doc", "text", "n_words", "spans", "items"])

        for batch in batches:
            texts = [utf8(t) for t in batch.column(1).to_pylist()]
            held.append(batch)
            raws += texts
            size += sum(map(len, texts))
            if size >= SHARD_WORDS * 6:  # bytes, as words of six to seven bytes are usual
                yield from flush()
                held, raws, size = [], [], 0
        if held:
            yield from flush()

    return docs.mapInArrow(run, docs.schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc`` (all columns of the row), ``n_words``, ``spans`` (disjoint, in order: word numbers [first_word,
    end_word) and code points [start, end) of what to remove) and ``items`` (distinct, sorted) for every row."""
    python_tasks(docs.sparkSession)
    found = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{text_col}`").alias("text"),
        F.lit(0).cast("long").alias("n_words"), F.array().cast(_SPAN_DDL).alias("spans"),
        F.array().cast("array<string>").alias("items"))
    table = written(phrases(benchmark, item_col, item_text_col, width), "phrases")
    size = table.agg(F.sum(F.octet_length("phrase") + F.octet_length("item") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    for no in range(blocks):
        rows = table.where(F.pmod(F.xxhash64("phrase", "item"), F.lit(blocks)) == no).groupBy("phrase").agg(
            F.collect_list("item").alias("items")).collect()
        found = _search(found, Block([(utf8(r.phrase), r["items"]) for r in rows], width))
        if no < blocks - 1:
            found = written(found, "leaks")
    return found.select("doc", "n_words", "spans", "items")


def _without(text: str | None, spans: list[dict]) -> str | None:
    if not spans:
        return text
    edges = [0, *(e for s in spans for e in (s["start"], s["end"])), len(text)]
    return "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns, without the words that benchmark phrases cover. What stands between
    two spans stays as it is; a text without hits is unchanged."""
    found = find_leaks(docs, benchmark, text_col, **options)
    named = found.select("doc", F.col(f"doc.`{text_col}`").alias("text"), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [_without(t, s) for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), b.column(2)],
                                             names=["doc", "text", "spans"])

    cleaned = named.mapInArrow(run, named.schema)
    return cleaned.select(*[(F.col("text") if c == text_col else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def leak_digests(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: words, words hit, items found and the digest of their ids."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["first_word"])
    return find_leaks(docs, benchmark).select(
        F.col(f"doc.`{id_col}`").cast("long").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
