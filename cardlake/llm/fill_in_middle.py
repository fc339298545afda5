"""Fill-in-the-middle rearrangement, its cuts found through memoized content-defined chunks.

A unit is a word with the blanks before it, or the blanks that end a text. A rolling hash over the last
16 bytes cuts every text into chunks, so passages that documents share fall into the same chunks
wherever they stand. A chunk is summed up once: the word ends inside it, its code points, and whether
it begins and ends within a word. Summaries are remembered by the chunk's bytes, which a lookup compares,
so equal hashes alone share nothing. A document's units are the sum of its chunks' counts, put
right where a word runs over a chunk's edge; the cut after k units lies in the chunk in which the
running count reaches k, and only that chunk is read again.

Prefix, middle and suffix are then put out as ``<P>prefix<S>suffix<M>middle`` (psm), as
``<S>suffix<P>prefix<M>middle`` (spm) or as they stand (plain). The choice and the cuts depend on the
seed and the document's id alone.

Defined results: a null text is an empty one; a null id is hashed as ''. Empty texts, and texts that hold one of the
marks, stay plain, so an output is always rebuilt exactly. Rows are treated one by one, so ties and
repeated rows need no rule; equal ids get equal draws. Work memory is a small multiple of the text, plus the
remembered chunks, which have a bound; what is forgotten is only counted again. Other columns are carried in
``doc``, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardlake.llm.tables import python_tasks
from cardlake.llm.words import BLANKS, utf8

SEED = 42
PLAIN_PERCENT = 50  # draws from here on stay plain
SPM_PERCENT = 80
# The marks around the parts.
PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK = "<P>", "<S>", "<M>"
MARKS = (PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK)

#: A chunk ends where so many low bits of the rolling hash are zero: after 512 bytes on average.
CUT_BITS = 9
LONGEST_CHUNK = 4096
HASHED_BYTES = 16
STRETCH = 1 << 18
#: Bytes of chunks that a worker remembers.
REMEMBERED_BYTES = 48 << 20

_GEAR = np.frombuffer(hashlib.shake_256(b"content-defined chunks").digest(1024), dtype="<u4")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def chunk_ends(raw: bytes) -> list[int]:
    """End offsets of the chunks; a chunk never ends within a character."""
    ends: list[int] = []
    data = np.frombuffer(raw, dtype=np.uint8)
    for start in range(0, len(raw), STRETCH):
        lead = max(0, start - HASHED_BYTES + 1)
        h = _GEAR[data[lead: start + STRETCH]]
        width = 1
        while width < HASHED_BYTES:  # sums over twice as many bytes each time
            h[width:] += h[:-width] << np.uint32(width)
            width *= 2
        cut = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + lead + 1
        cut = cut[(cut > start) & (cut < len(raw))]
        ends += cut[(data[cut] & 0xC0) != 0x80].tolist()
    out, last = [], 0
    for end in [*ends, len(raw)]:
        while end - last > LONGEST_CHUNK:
            last += LONGEST_CHUNK
            while last < end and raw[last] & 0xC0 == 0x80:
                last += 1
            if last < end:
                out.append(last)
        if end > last:
            out.append(end)
            last = end
    return out


class ChunkMemory:
    """Summaries of chunks by their bytes; the older half goes when the bound is reached."""

    def __init__(self, most: int = REMEMBERED_BYTES):
        self.known: dict[bytes, tuple[int, int, bool, bool]] = {}
        self.most, self.held, self.counted = most, 0, 0

    def summary(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        """Word ends before the chunk's last byte, code points, begins within a word, ends within one."""
        found = self.known.get(chunk)
        if found is None:
            ends_in_word = chunk[-1] not in BLANKS
            found = (len(chunk.split()) - ends_in_word, len(chunk.decode("utf-8", "surrogatepass")),
                     chunk[0] not in BLANKS, ends_in_word)
            self.counted += 1
            if self.held + len(chunk) > self.most:
                for old in list(self.known)[: len(self.known) // 2 + 1]:
                    self.held -= len(old)
                    del self.known[old]
            self.known[chunk] = found
            self.held += len(chunk)
        return found


class Units:
    """The units of one text, by chunk."""

    def __init__(self, raw: bytes, memory: ChunkMemory):
        self.raw = raw
        ends = chunk_ends(raw)
        self.edges = [0, *ends]
        parts = [memory.summary(raw[a:b]) for a, b in zip(self.edges, ends)]
        inner = np.array([p[0] for p in parts], dtype=np.int64)
        begins = np.array([*(p[2] for p in parts[1:]), False][: len(parts)], dtype=bool)
        ends_in = np.array([p[3] for p in parts], dtype=bool)
        self.reached = np.cumsum(inner + (ends_in & ~begins))  # word ends up to the chunk's end
        self.inner = inner
        self.points = np.cumsum([0, *(p[1] for p in parts)])
        self.words = int(self.reached[-1]) if parts else 0
        self.count = self.words + (bool(parts) and not parts[-1][3])

    def cut(self, k: int) -> tuple[int, int]:
        """Byte and code point offset behind ``k`` units."""
        if k == 0:
            return 0, 0
        if k > self.words:
            return len(self.raw), int(self.points[-1])
        at = int(np.searchsorted(self.reached, k))
        before = int(self.reached[at - 1]) if at else 0
        start, end = self.edges[at], self.edges[at + 1]
        if k - before > self.inner[at]:
            return end, int(self.points[at + 1])
        chunk = self.raw[start:end]
        # a chunk that goes on with a word begins with that word's end
        for no, m in enumerate(_WORD.finditer(chunk), 1):
            if no == k - before:
                return start + m.end(), int(self.points[at]) + len(chunk[: m.end()].decode("utf-8", "surrogatepass"))
        raise AssertionError("counts of a chunk do not fit its bytes")


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i: i + 4], "big") for i in range(0, 16, 4)]


def rearrange(text: str | None, doc_id: int | None, memory: ChunkMemory, seed: int = SEED) -> tuple:
    """Units, form, code points of prefix and middle (None if plain), output."""
    raw = utf8(text)
    units = Units(raw, memory)
    n = units.count
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not raw or any(m in text for m in MARKS) or h3 % 100 >= PLAIN_PERCENT:
        return n, "plain", None, None, text or ""
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_points), (b, b_points) = units.cut(low), units.cut(high)
    prefix, middle, suffix = (part.decode("utf-8", "surrogatepass") for part in (raw[:a], raw[a:b], raw[b:]))
    form = "spm" if h4 % 100 < SPM_PERCENT else "psm"
    first = f"{SUFFIX_MARK}{suffix}{PREFIX_MARK}{prefix}" if form == "spm" else f"{PREFIX_MARK}{prefix}{SUFFIX_MARK}{suffix}"
    return n, form, a_points, b_points - a_points, f"{first}{MIDDLE_MARK}{middle}"


_DDL = "n long, form string, prefix_chars long, middle_chars long, output string"
_TYPES = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
          ("output", pa.string())]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``doc`` (all columns of the row), ``n, form, prefix_chars, middle_chars, output`` for every row. A map over
    rows: no shuffle."""
    python_tasks(docs.sparkSession)
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = ChunkMemory()
        for b in batches:
            rows = [rearrange(t, i, memory, seed) for i, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            columns = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_TYPES)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc", *(name for name, _ in _TYPES)])

    return named.mapInArrow(run, StructType([named.schema["doc"], *StructType.fromDDL(_DDL).fields]))


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of."""
    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        behind = F.split_part(output, F.lit(second), F.lit(2))
        return (F.substring(F.split_part(output, F.lit(second), F.lit(1)), len(first) + 1, 2**31 - 1),
                F.split_part(behind, F.lit(MIDDLE_MARK), F.lit(1)), F.split_part(behind, F.lit(MIDDLE_MARK), F.lit(2)))

    prefix, suffix, middle = parts(PREFIX_MARK, SUFFIX_MARK)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX_MARK, PREFIX_MARK)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(prefix, middle, suffix))


def middle_digests(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: units, form, code points of prefix and middle, digests of the output and of the text rebuilt from it."""
    return fill_in_middle(docs, id_col).select(
        F.col(f"doc.`{id_col}`").cast("long").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))
