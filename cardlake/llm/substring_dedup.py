"""Exact substring de-duplication of 13-word windows behind a count-min prefilter.

A word goes if it lies in a window whose word sequence also starts in a document with a
smaller ``doc_id``. Documents are dealt to chunks by a hash; the text is shuffled
once and its shuffle is read by the three passes over chunks:

1. Every chunk sketches its windows: sorted cell values, dealt to buckets by window
   hash. A bucket merges the chunks' sketches into one count-min sketch (two rows of
   counters that stop at 2: a chunk counts once per cell). The
   estimate never undercounts the chunks that hold a window, so "estimated in one chunk
   only" is certain. The answer to a chunk is one bit per sketched value.
2. Every chunk computes 128-bit digests of the windows estimated repeated, and of
   those alone; buckets group them exactly and answer with one bit per digest: does a
   document with a smaller id exist outside what the chunk knows?
3. Every chunk removes the covered words of its documents.

What moves besides the text is 3-4 bytes for each distinct window of a chunk and 24 for each
estimated repeated; a window that a third of all documents share is one entry per chunk.
The numbers of chunks and buckets follow ``spark.sql.shuffle.partitions``, so sizing the
shuffle for the data also bounds what one group holds.

Defined results: a null text has no words; a document with fewer than 13 words keeps them
all. A document whose id is null keeps all its words and removes none elsewhere (it has no
place in the order). Rows that repeat a ``doc_id`` are separate documents of equal id: neither
is smaller. Other columns of the input are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.tables import parallelism, python_tasks
from cardlake.llm.words import STRETCH, distinct, pack_sorted, quick_word_hashes, stretches, unpack_sorted, window_hashes

WINDOW = 13
#: Parts that move are chunks times buckets, so their product stays at the square of the partitions.
CHUNKS_PER_PARTITION = 2
PARTITIONS_PER_BUCKET = 2
_SECOND_ROW = np.uint32(0x9E3779B1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_DIGEST = np.dtype([("a", "<u8"), ("b", "<u8")])

_MASK_DDL = "kind int, chunk long, bucket long, mask binary"
_MASK = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("bucket", pa.int64()), ("mask", pa.binary())])
_PART_DDL = "chunk long, bucket long, part binary"
_PART = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("part", pa.binary())])


class Chunk:
    """The documents of one chunk, their words joined by one blank, and the hashes of their windows: those of all
    documents in one array, document ``n`` from ``edges[n]`` to ``edges[n + 1]``."""

    def __init__(self, docs: pa.Table, width: int, buckets: int):
        self.ids = docs.column("doc_id").to_pylist()
        self.raw, self.n_words = [], []
        for text in docs.column("text").cast(pa.large_binary()).to_pylist():
            words = (text or b"").split()
            self.raw.append(b" ".join(words))
            self.n_words.append(len(words))
        self.width, self.buckets = width, buckets
        taken = [n for n, doc_id in enumerate(self.ids) if doc_id is not None and self.n_words[n] >= width]
        windows = np.zeros(len(self.ids), dtype=np.int64)
        hashes = [np.zeros(0, dtype=np.uint64)]
        for a, b in stretches([self.raw[n] for n in taken], STRETCH):
            words = np.array([self.n_words[n] for n in taken[a:b]])
            raw = b" ".join([self.raw[n] for n in taken[a:b]])
            starts, ends = _joined_spans(raw)
            of = np.repeat(np.arange(len(words)), words)
            h = window_hashes(quick_word_hashes(raw, starts, ends), width)
            hashes.append(h[of[: len(h)] == of[width - 1:]])  # no window lies in two documents
            windows[taken[a:b]] = words - width + 1
        self.hashes = np.concatenate(hashes)
        self.edges = np.concatenate([[0], np.cumsum(windows)])

    def cells(self, h: np.ndarray) -> np.ndarray:
        """Bucket in the high 32 bits, value within the bucket in the low 32."""
        return (h % np.uint64(self.buckets)) << np.uint64(32) | h >> np.uint64(32)

    def by_bucket(self, cells: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Sorted distinct cells, split by bucket."""
        bucket = (cells >> np.uint64(32)).astype(np.int64)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        return [(int(bucket[a]), cells[a:b]) for a, b in zip(edges, [*edges[1:], len(cells)])]

    def sketch_cells(self) -> np.ndarray:
        return distinct(self.cells(self.hashes))

    def repeated(self, masks: dict[int, bytes]) -> "Repeated":
        """The windows estimated repeated, by their exact digests."""
        own = self.cells(self.hashes)
        hit = [np.zeros(0, dtype=np.uint64)]
        for bucket, part in self.by_bucket(distinct(own)):
            bits = np.unpackbits(np.frombuffer(masks[bucket], dtype=np.uint8), count=len(part)).astype(bool)
            hit.append(part[bits])
        far = _member(np.concatenate(hit), own)  # sorted: buckets come in order
        at = np.flatnonzero(far | self._in_two_documents())
        cuts = np.searchsorted(at, self.edges)
        found, blake2b = Repeated(), hashlib.blake2b
        for n in np.flatnonzero(np.diff(cuts)).tolist():
            here = at[cuts[n]: cuts[n + 1]]
            places = here - self.edges[n]
            raw = self.raw[n]
            starts, ends = _joined_spans(raw)
            digests = [blake2b(raw[a:b], digest_size=16).digest()
                       for a, b in zip(starts[places].tolist(), ends[places + (self.width - 1)].tolist())]
            found.add(n, places, digests, far[here], self.ids[n])
        return found

    def _in_two_documents(self) -> np.ndarray:
        """Whether a window's hash comes in two documents of this chunk."""
        out = np.zeros(len(self.hashes), dtype=bool)
        ordered = np.sort(self.hashes)
        at = np.flatnonzero(_member(distinct(ordered[1:][ordered[1:] == ordered[:-1]]), self.hashes))
        if not len(at):
            return out
        h, doc = self.hashes[at], np.searchsorted(self.edges, at, side="right")
        order = np.argsort(h, kind="stable")
        h, doc = h[order], doc[order]  # documents rise within a hash
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        last = np.r_[first[1:], len(h)] - 1
        out[at[order]] = np.repeat(doc[first] != doc[last], last - first + 1)
        return out


class Repeated:
    """Positions and digests of a chunk's candidate windows."""

    def __init__(self) -> None:
        self.of_doc: dict[int, tuple[np.ndarray, list[bytes]]] = {}
        self.first: dict[bytes, int] = {}  # smallest doc_id of the chunk with the window
        self.far: set[bytes] = set()  # estimated to occur in other chunks too

    def add(self, n: int, at: np.ndarray, digests: list[bytes], far: np.ndarray, doc_id: int) -> None:
        self.of_doc[n] = (at, digests)
        first = self.first
        for d, f in zip(digests, far.tolist()):
            known = first.get(d)
            if known is None or doc_id < known:
                first[d] = doc_id
            if f:
                self.far.add(d)

    def by_bucket(self, buckets: int) -> dict[int, list[bytes]]:
        """Digests to ask about, sorted, by bucket."""
        digests = sorted(self.far)
        at = np.frombuffer(b"".join(digests), dtype=_DIGEST)["a"] % np.uint64(buckets)
        out: dict[int, list[bytes]] = {}
        for bucket, d in zip(at.tolist(), digests):
            out.setdefault(bucket, []).append(d)
        return out


def _joined_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte offsets of words that are joined by one blank (at least one word)."""
    blanks = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 32)
    return np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(raw)]])


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of ``x`` are among the values; a table of one byte for several values first sorts out most of the others."""
    out = np.zeros(len(x), dtype=bool)
    if not len(sorted_values):
        return out
    shift = np.uint64(64 - min(24, max(10, (8 * len(sorted_values)).bit_length())))
    seen = np.zeros(1 << (64 - int(shift)), dtype=bool)
    seen[(sorted_values * _SPREAD) >> shift] = True
    maybe = np.flatnonzero(seen[(x * _SPREAD) >> shift])
    values = x[maybe]
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    out[maybe] = sorted_values[at] == values
    return out


def _masks(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {b: m for k, b, m in zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "mask"))) if k == kind}


def merge_sketches(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Count-min over the chunks' values: for each chunk, which of its values may occur in
    another chunk as well."""
    total = sum(map(len, parts))
    bits = min(32, max(10, (4 * total - 1).bit_length())) if total else 10
    rows = [np.zeros(1 << bits, dtype=np.uint8) for _ in range(2)]

    def cells(v: np.ndarray) -> list[np.ndarray]:
        shift = np.uint32(32 - bits)
        return [v >> shift, (v * _SECOND_ROW) >> shift]

    for v in parts:
        for row, c in zip(rows, cells(v)):
            row[c] = np.minimum(row[c] + 1, 2)
    out = []
    for v in parts:
        a, b = (row[c] for row, c in zip(rows, cells(v)))
        out.append(np.minimum(a, b) >= 2)
    return out


def group_digests(chunks: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Exact grouping: for each chunk's (digests, smallest ids), whether some chunk knows a
    smaller id for the digest."""
    digests = np.concatenate([d for d, _ in chunks])
    ids = np.concatenate([i for _, i in chunks])
    order = np.lexsort((ids, digests["b"], digests["a"]))
    d = digests[order]
    new = np.r_[True, d[1:] != d[:-1]] if len(d) else np.zeros(0, dtype=bool)
    smallest = ids[order][new][np.cumsum(new) - 1]
    less = np.zeros(len(ids), dtype=bool)
    less[order] = smallest < ids[order]
    return np.split(less, np.cumsum([len(i) for _, i in chunks])[:-1])


def _part_rows(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([], [], []), _PART.types)],
                                schema=_PART)


def substring_dedup(docs: DataFrame, width: int = WINDOW, output: str = "text", id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed`` and ``kept_text`` (kept words joined by one blank), or
    with ``output="sha256"`` its digest ``kept_sha256``; one row per input row."""
    spark = docs.sparkSession
    python_tasks(spark)
    partitions = parallelism(spark)
    chunks, buckets = CHUNKS_PER_PARTITION * partitions, max(1, partitions // PARTITIONS_PER_BUCKET)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = named.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))).repartition(
        partitions, "chunk")

    def sketch(table: pa.Table) -> pa.Table:
        c = Chunk(table, width, buckets)
        chunk = table.column("chunk")[0].as_py()
        return _part_rows([(chunk, b, pack_sorted(cells)) for b, cells in c.by_bucket(c.sketch_cells())])

    def estimate(table: pa.Table) -> pa.Table:
        parts = [unpack_sorted(p) for p in table.column("part").to_pylist()]
        masks = [np.packbits(hit).tobytes() for hit in merge_sketches(parts)]
        n = len(masks)
        return pa.Table.from_arrays([pa.array([1] * n, pa.int32()), table.column("chunk"), table.column("bucket"),
                                     pa.array(masks, pa.binary())], schema=_MASK)

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _part_rows([])
        found = Chunk(left, width, buckets).repeated(_masks(right, 1))
        chunk = left.column("chunk")[0].as_py()
        return _part_rows([
            (chunk, b, b"".join(ds) + np.array([found.first[d] for d in ds], dtype="<i8").tobytes())
            for b, ds in found.by_bucket(buckets).items()])

    def group(table: pa.Table) -> pa.Table:
        known = []
        for p in table.column("part").to_pylist():
            n = len(p) // 24
            known.append((np.frombuffer(p, dtype=_DIGEST, count=n), np.frombuffer(p, dtype="<i8", offset=16 * n)))
        masks = [np.packbits(x).tobytes() for x in group_digests(known)]
        return pa.Table.from_arrays([pa.array([2] * len(masks), pa.int32()), table.column("chunk"),
                                     table.column("bucket"), pa.array(masks, pa.binary())], schema=_MASK)

    result = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept_sha256" if output == "sha256" else "kept_text", pa.string())])

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return result.empty_table()
        c = Chunk(left, width, buckets)
        found = c.repeated(_masks(right, 1))
        smaller: set[bytes] = set()
        answers = _masks(right, 2)
        for b, ds in found.by_bucket(buckets).items():
            bits = np.unpackbits(np.frombuffer(answers[b], dtype=np.uint8), count=len(ds))
            smaller.update(d for d, bit in zip(ds, bits.tolist()) if bit)
        rows = []
        for n, (doc_id, raw) in enumerate(zip(c.ids, c.raw)):
            text, n_words, removed = raw, c.n_words[n], 0
            if n in found.of_doc:
                at, digests = found.of_doc[n]
                go = np.array([d in smaller or found.first[d] < doc_id for d in digests], dtype=bool)
                step = np.zeros(n_words + 1, dtype=np.int64)
                step[at[go]] += 1
                step[at[go] + width] -= 1
                gone = np.cumsum(step[:-1]) > 0
                removed = int(gone.sum())
                if removed:
                    text = b" ".join(compress(raw.split(b" "), (~gone).tolist()))
            rows.append((doc_id, n_words, removed, hashlib.sha256(text).hexdigest() if output == "sha256"
                         else text.decode("utf-8", "surrogatepass")))
        return pa.Table.from_arrays([pa.array(col, t) for col, t in zip(zip(*rows), result.types)], schema=result)

    def to_ddl(schema: pa.Schema) -> str:
        return ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema)

    sketched = dealt.groupBy("chunk").applyInArrow(sketch, _PART_DDL)
    estimated = sketched.groupBy("bucket").applyInArrow(estimate, _MASK_DDL)
    asked = dealt.groupBy("chunk").cogroup(estimated.groupBy("chunk")).applyInArrow(ask, _PART_DDL)
    grouped = asked.groupBy("bucket").applyInArrow(group, _MASK_DDL)
    answers = estimated.unionByName(grouped)
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(remove, to_ddl(result))
