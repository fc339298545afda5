"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersections.

1. Every document becomes the sorted set of its 5-word shingle hashes. Words are numbered by a seeded
   64-bit hash of their bytes that mixes every step (a polynomial modulo 2**64 gives some pairs of words one
   number), and a shingle's hash is a polynomial of five such numbers. Documents of equal
   sets (copies) are one class from here on, named by a digest of the set.
2. Two sets that reach the threshold share a shingle among the first ``n - ceil(t n) + 1``
   of each, in any fixed order of all shingles. The order here is by hash, with the
   shingles found in the most classes last, so that passages shared by many documents rarely
   lead to a meeting. Classes that share such a shingle form a tile; equal tiles count once.
   The classes of a long list are numbered by set size on Spark and cut into blocks, which
   only meet blocks in reach.
3. In a tile, bitmap signatures (2 to 4 bits per shingle, ``hash mod width``) are compared:
   every differing bit is a shingle that only one set has, so bit counts bound the
   overlap from above. Pairs that fail the bound are no links. Passing pairs only tie
   their classes into candidate groups: one edge per class, never all pairs.
4. Candidate groups are cut into size-banded tiles again, this time with the full
   sorted arrays, each class pair meeting in exactly one tile: size, bitmap bound, exact
   intersection. A tile returns per class the weight of its links and one tie to its
   linked classes; connected components of those ties are the result.

No pair list leaves a tile. A tile of step 2 holds two blocks at most, and the task that reads the
shingles' lists holds no more of one list than that; the tiles of step 4 hold two blocks dealt by
hash, so about that many, and as many more blocks are made as bound the shingles of a block
(``BLOCK_SHINGLES``; a longer text is a block of its own at most). The rows of a tile table still grow with the square of a long list over
the block size, on Spark's disk. Two things are
broadcast: the list of most frequent shingles, at most ``COMMON_SHINGLES`` numbers, which
steers cost, never results; and the results of the classes with very many copies, of which
there are fewer than ``HOT_PARTS`` for each shuffle partition.

Defined results: a text without words or a null text has an empty set and is linked with
nothing (its component is itself); fewer than five words are one shingle. A row with a null
``doc_id`` gets a null component and links with nothing. Rows that repeat a ``doc_id`` with
different texts are separate documents. Other columns of the input are not read. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from cardlake.llm.components import components
from cardlake.llm.tables import parallelism, python_tasks, written
from cardlake.llm.words import distinct, mix, utf8, window_hashes

WORDS = 5
PERCENT = 80
BLOCK = 512
BLOCK_SHINGLES = 2_000_000
WORD_SEED = 0x5851F42D4C957F2D
COMMON_SHINGLES = 1 << 17
HOT_PARTS = 4
COMMON_FROM = 64  # classes that make a shingle common
_LOCALLY_COMMON = 4
_FLUSH = 1_000_000
_SPREAD = 4096
_CHUNK_ROWS = 100_000

_SETS = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
                   ("bitmap", pa.binary()), ("text_key", pa.int64())])
_SETS_DDL = "kind int, doc_id long, n long, digest binary, bitmap binary, text_key long"


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word windows; a shorter text is one window."""
    words = utf8(text, lower_az=True).split()  # runs outside the ASCII blanks
    if not words:
        return np.zeros(0, dtype=np.uint64)
    numbers = np.fromiter([xxh3_64_intdigest(w, WORD_SEED) for w in words], dtype=np.uint64, count=len(words))
    if len(words) < size:
        return mix(window_hashes(numbers, len(words)) + np.uint64(len(words)))
    return distinct(window_hashes(numbers, size))


def digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def bitmap_width(n: int) -> int:
    """Bits of the signature of a set of ``n``: a power of two from 2n on, 64 at least."""
    return max(64, 1 << (2 * n - 1).bit_length())


def bitmap(hashes: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros(width, dtype=np.uint8)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


def _fold(maps: np.ndarray, width: int) -> np.ndarray:
    """Signatures (one per row) folded to a smaller width: ``hash mod width`` of the same sets."""
    while maps.shape[1] * 64 > width:
        half = maps.shape[1] // 2
        maps = maps[:, :half] | maps[:, half:]
    return maps


def passing(n: np.ndarray, maps: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For sets in ascending order of size: (i, all j > i whose size and bit counts leave
    the threshold in reach)."""
    width = np.array([len(m) * 64 for m in maps])
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        # partners are at most 100 / percent times larger, so at most a few widths up
        reach = np.flatnonzero((width >= w) & (n * percent <= 100 * n[own[-1]]))
        table = np.vstack([_fold(maps[j][None, :], int(w)) for j in reach])
        for i in own:
            row = int(np.searchsorted(reach, i))
            stop = int(np.searchsorted(n[reach], 100 * n[i] // percent, side="right"))
            if stop <= row + 1:
                continue
            differ = np.bitwise_count(table[row + 1: stop] ^ table[row]).sum(axis=1, dtype=np.int64)
            js = reach[row + 1: stop]
            js = js[differ * (100 + percent) <= (n[i] + n[js]) * (100 - percent)]
            if len(js):
                yield int(i), js


def _find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _ties(keys: list[bytes], pairs: Iterator[tuple[int, np.ndarray]]) -> list[tuple[bytes, bytes]]:
    """One tie per key of each group connected by ``pairs``, to the group's smallest key."""
    parent = list(range(len(keys)))
    for i, js in pairs:
        root = _find(parent, i)
        for j in js.tolist():
            other = _find(parent, j)
            if other != root:
                parent[other] = root
    low: dict[int, bytes] = {}
    for i, k in enumerate(keys):
        r = _find(parent, i)
        low[r] = min(low.get(r, k), k)
    return [(k, low[_find(parent, i)]) for i, k in enumerate(keys) if low[_find(parent, i)] != k]


def linked(arrays: list[np.ndarray], n: np.ndarray, maps: list[np.ndarray], side: np.ndarray,
           percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Pairs of a tile that reach the threshold, by exact intersection. ``side`` 0 and 1 are the
    tile's two blocks, whose members only meet across; all -1 is a block met with itself."""
    codes = np.unique(np.concatenate(arrays), return_inverse=True)[1]
    parts = np.split(codes, np.cumsum(n)[:-1])
    mark = np.zeros(int(codes.max()) + 1 if len(codes) else 1, dtype=np.int64)
    for i, js in passing(n, maps, percent):
        js = js[(side[js] != side[i]) | (side[js] < 0)]
        if not len(js):
            continue
        mark[parts[i]] = 1
        starts = np.concatenate([[0], np.cumsum(n[js])[:-1]])
        common = np.add.reduceat(mark[np.concatenate([parts[j] for j in js])], starts)
        mark[parts[i]] = 0
        js = js[common * 100 >= percent * (n[i] + n[js] - common)]
        if len(js):
            yield i, js


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)


def set_rows(docs: DataFrame, size: int) -> DataFrame:
    """Kind 0: a document's set size, digest and signature. Kind 1: a shingle (in ``doc_id``) that
    several classes of one stretch of documents hold, and how many (in ``n``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        n_held = 0

        def common() -> list[tuple]:
            x = np.sort(np.concatenate(list(held.values()))) if held else np.zeros(0, dtype=np.uint64)
            edge = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, dtype=np.int64)
            count = np.diff(np.r_[edge, len(x)])
            hit = count >= _LOCALLY_COMMON
            return [(1, s, c, None, None, None) for s, c in zip(x[edge][hit].view(np.int64).tolist(), count[hit].tolist())]

        for b in batches:
            rows: list[tuple] = []
            for doc_id, text, text_key in zip(*(b.column(c).to_pylist() for c in range(3))):
                h = shingles(text, size)
                if not len(h):
                    rows.append((0, doc_id, 0, None, None, text_key))
                    continue
                key = digest(h)
                rows.append((0, doc_id, len(h), key, bitmap(h, bitmap_width(len(h))).tobytes(),
                             text_key))
                if key not in held:
                    held[key] = h
                    n_held += len(h)
            if n_held > _FLUSH:
                rows += common()
                held, n_held = {}, 0
            yield from _table(rows, _SETS).to_batches()
        yield from _table(common(), _SETS).to_batches()

    return docs.mapInArrow(run, _SETS_DDL)


def prefix(h: np.ndarray, percent: int, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles of a set by which it may meet others: the first ones in the common order."""
    n = len(h)
    keep = n - -(-percent * n // 100) + 1
    if len(common):
        at = np.searchsorted(common, h)
        at[at == len(common)] = 0
        hot = common[at] == h
        if hot.any():
            rest = h[~hot]
            return np.concatenate([rest, h[hot][np.argsort(rank[at[hot]])]])[:keep]
    return h[:keep]


def postings(docs: DataFrame, size: int, percent: int, common: list[int], n_long: int) -> DataFrame:
    """``shingle, sid, n, spread`` for the prefix of each class; ``sid`` is the digest's first half. The
    first ``n_long`` shingles of ``common`` have long lists: their ``spread`` is dealt by ``sid`` from 1 on,
    so that no task gets a whole list; it is 0 elsewhere."""
    # most frequent first in ``common``; the order puts them last, the most frequent at the very end
    values = np.array(common, dtype=np.int64).view(np.uint64)
    order = np.argsort(values)
    known = docs.sparkSession.sparkContext.broadcast((values[order], (len(values) - order).astype(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rank = known.value
        listed = hot[rank > len(hot) - n_long]
        for b in batches:
            seen: set[bytes] = set()
            s, d, n, spread = [], [], [], []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = shingles(text, size)
                if doc_id is None or not len(h):
                    continue
                key = digest(h)
                if key in seen:
                    continue
                seen.add(key)
                p = prefix(h, percent, hot, rank)
                s.append(p.view(np.int64))
                d.append(np.full(len(p), int.from_bytes(key[:8], "big", signed=True), dtype=np.int64))
                n.append(np.full(len(p), len(h), dtype=np.int64))
                far = np.isin(p, listed) if len(listed) else np.zeros(len(p), dtype=bool)
                spread.append(np.where(far, 1 + d[-1] % _SPREAD, 0))
            if s:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (s, d, n, spread)], names=["shingle", "sid", "n", "spread"])

    return docs.mapInArrow(run, "shingle long, sid long, n long, spread long")


def meetings(n: np.ndarray, percent: int, block: int) -> list[np.ndarray]:
    """Positions that meet, in tiles of at most two blocks, so that any two sets in reach of each other
    share a tile. ``n`` holds the set sizes of one shingle's classes, ascending."""
    if len(n) <= 2 * block:
        return [np.arange(len(n))] if len(n) > 1 else []
    cuts = [np.arange(x, min(x + block, len(n))) for x in range(0, len(n), block)]
    out, met = [], np.zeros(len(cuts), dtype=bool)
    for i, low in enumerate(cuts):
        for j in range(i + 1, len(cuts)):
            if percent * n[cuts[j][0]] > 100 * n[low[-1]]:
                break  # sizes ascend: the later blocks are out of reach too
            out.append(np.concatenate([low, cuts[j]]))
            met[i] = met[j] = True
    # a block without a partner in reach still meets itself
    return out + [c for c, known in zip(cuts, met) if not known and len(c) > 1]


_LISTS = pa.schema([("tile", pa.int64()), ("shingle", pa.int64()), ("sid", pa.int64()), ("n", pa.int64())])


def read_lists(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """From postings sorted by ``shingle, spread, sid``: ``tile, sid`` of the lists of 2 to ``most`` classes,
    and with a null tile the distinct rows of longer lists and of those with a ``spread``. Holds
    one chunk of rows and, of the list that goes on behind it, ``most`` rows at most."""
    left: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * 4
    streaming = None  # the long list whose rows go through as they come, and its last class
    tiles_seen: set[int] = set()

    def take(rows: list[np.ndarray], over: bool) -> pa.RecordBatch:
        nonlocal left, streaming
        s, sid, n, spread = rows
        fresh = np.r_[True, (s[1:] != s[:-1]) | (sid[1:] != sid[:-1])][: len(s)]
        s, sid, n, spread = (x[fresh] for x in (s, sid, n, spread))
        if streaming is not None and len(s) and (s[0], sid[0]) == streaming:
            s, sid, n, spread = (x[1:] for x in (s, sid, n, spread))
        start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]][: len(s)])
        stop = np.r_[start[1:], len(s)][: len(start)]
        count = stop - start
        long = (count > most) | (spread[start] > 0)
        if streaming is not None and len(s):
            long[0] |= s[0] == streaming[0]
        end = len(s)
        if len(s) and not over and not long[-1]:
            end = int(start[-1])  # the last list may go on
            start, stop, count, long = (x[:-1] for x in (start, stop, count, long))
        if end:
            streaming = (s[end - 1], sid[end - 1]) if long[-1] else None
        left = [x[end:] for x in (s, sid, n, spread)]
        names, members = [], []
        for a, b in zip(start[~long & (count > 1)].tolist(), stop[~long & (count > 1)].tolist()):
            key = int.from_bytes(hashlib.blake2b(sid[a:b].tobytes(), digest_size=8).digest(), "little", signed=True)
            if key not in tiles_seen:
                tiles_seen.add(key)
                names.append(key)
                members.append(sid[a:b])
        if len(tiles_seen) > _CHUNK_ROWS:
            tiles_seen.clear()  # what comes twice is dropped later
        raw = np.repeat(long, count)
        s, sid, n = s[:end][raw], sid[:end][raw], n[:end][raw]
        met = np.concatenate([np.zeros(0, dtype=np.int64), *members])
        none = pa.nulls(len(met), pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(np.repeat(np.array(names, dtype=np.int64), [len(m) for m in members])),
                              pa.nulls(len(s), pa.int64())]),
            pa.concat_arrays([none, pa.array(s)]), pa.array(np.concatenate([met, sid])),
            pa.concat_arrays([none, pa.array(n)])], schema=_LISTS)

    waiting: list[list[np.ndarray]] = []
    held = 0
    for b in batches:
        waiting.append([b.column(k).to_numpy() for k in ("shingle", "sid", "n", "spread")])
        held += b.num_rows
        if held >= _CHUNK_ROWS:
            yield take([np.concatenate(x) for x in zip(left, *waiting)], False)
            waiting, held = [], 0
    yield take([np.concatenate(x) for x in zip(left, *waiting)], True)


def long_tiles(rows: DataFrame, percent: int, block: int) -> DataFrame:
    """``tile, sid`` for the long lists (``shingle, sid, n``, distinct), by the rule of ``meetings``: the
    classes of a list are numbered by set size and cut into blocks, and the blocks in reach of each
    other are tiles. Only tables of blocks are kept per list, and no task needs a whole list."""
    spark = rows.sparkSession
    order = ("shingle", "n", "sid")
    # ids ascend within a range and from one range to the next
    dealt = written(rows.repartitionByRange(parallelism(spark), *order).sortWithinPartitions(*order).withColumn(
        "at", F.monotonically_increasing_id()).withColumn("stretch", F.shiftright("at", 33)), "long-lists")
    before = Window.partitionBy("shingle").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shingle", "stretch").agg(F.min("at").alias("first"), F.count("*").alias("c")).withColumn(
        "offset", F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).drop("first", "c")
    placed = written(dealt.join(starts, ["shingle", "stretch"]).select(
        "shingle", "sid", "n", F.floor((F.col("at") + F.col("offset")) / F.lit(block)).cast("long").alias("block")),
        "long-blocks")
    # ``members`` names a block by its classes, so that equal blocks of several lists count once
    blocks = written(placed.groupBy("shingle", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("top"), F.count("*").alias("c"),
        F.bit_xor(F.xxhash64("sid")).alias("x"), F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("y")).withColumn(
        "members", F.xxhash64("x", "y", "c")).drop("x", "y"), "long-block-list")
    # the last block in reach of a block: sizes ascend, so it is a count of the lows up to its top
    lows = blocks.select("shingle", "block", (F.col("low") * percent).alias("size"), F.lit(0).alias("is_top"))
    tops = blocks.select("shingle", "block", (F.col("top") * 100).alias("size"), F.lit(1).alias("is_top"))
    upto = Window.partitionBy("shingle").orderBy("size", "is_top", "block").rowsBetween(Window.unboundedPreceding, 0)
    reach = lows.unionByName(tops).withColumn("last", F.sum(1 - F.col("is_top")).over(upto) - 1).where(
        "is_top = 1").select("shingle", "block", "last")
    met_before = F.coalesce(F.lag("last").over(Window.partitionBy("shingle").orderBy("block")), F.lit(-1))
    reach = reach.withColumn("alone", (F.col("last") == F.col("block")) & (met_before < F.col("block")))
    # a block without a partner in reach still meets itself
    others = F.when(F.col("last") > F.col("block"), F.sequence(F.col("block") + 1, F.col("last"))).when(
        F.col("alone"), F.array("block"))
    pairs = reach.select("shingle", "block", F.explode(others).alias("other"))
    a = blocks.select("shingle", "block", F.col("members").alias("a"), F.col("c").alias("n_a"))
    b = blocks.select("shingle", F.col("block").alias("other"), F.col("members").alias("b"))
    named = pairs.join(a, ["shingle", "block"]).join(b, ["shingle", "other"]).where("a <> b OR n_a > 1").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sides = named.select(F.xxhash64("a", "b").alias("tile"), F.explode(F.array_distinct(F.array("a", "b"))).alias("members"))
    once = blocks.groupBy("members").agg(F.min(F.struct("shingle", "block")).alias("k")).select("members", "k.*")
    return sides.join(placed.join(once, ["shingle", "block"]).select("members", "sid"), "members").select("tile", "sid")


def tiles(posted: DataFrame, percent: int, buckets: int, block: int) -> DataFrame:
    """``tile, sid``: the classes that meet by a shingle, in tiles of at most two blocks."""
    most = 2 * block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from read_lists(batches, most)

    dealt = posted.repartition(buckets, "shingle", "spread").sortWithinPartitions("shingle", "spread", "sid")
    lists = written(dealt.mapInArrow(run, "tile long, shingle long, sid long, n long"), "shingle-lists")
    short = lists.where("tile IS NOT NULL").select("tile", "sid").distinct()
    rows = lists.where("tile IS NULL").select("shingle", "sid", "n")
    return short if rows.isEmpty() else short.unionByName(long_tiles(rows, percent, block))


_TIE = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def candidate_ties(met: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``a, b``: ties between classes whose signatures leave the threshold in reach."""

    def run(table: pa.Table) -> pa.Table:
        n = table.column("n").to_numpy()
        order = np.argsort(n, kind="stable")
        keys = table.column("digest").to_pylist()
        raw = table.column("bitmap").to_pylist()
        keys = [keys[i] for i in order]
        maps = [np.frombuffer(raw[i], dtype="<u8") for i in order]
        return _table(_ties(keys, passing(n[order], maps, percent)), _TIE)

    sig = met.join(classes.select("sid", "digest", "n", "bitmap"), "sid")
    return sig.select("tile", "digest", "n", "bitmap").groupBy("tile").applyInArrow(run, "a binary, b binary")


_LINK = pa.schema([("digest", pa.binary()), ("tie", pa.binary()), ("links", pa.int64())])


def class_texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``digest, text``: the text of one document of each class, found by id and text key, so that an id
    repeated over many texts brings no others."""
    wanted = members.select(F.col("rep").alias("doc_id"), F.col("rep_key").alias("text_key"), "digest")
    return docs.join(wanted, ["doc_id", "text_key"]).select("digest", "text")


def verified(docs: DataFrame, groups: DataFrame, classes: DataFrame, size: int, percent: int,
             block: int) -> DataFrame:
    """``digest, tie, links`` of the classes with links, from the tiles of candidate groups."""
    ratio = math.log(100 / percent)
    members = groups.join(classes, groups.node == classes.digest).select(
        "component", "digest", "rep", "rep_key", "copies", "n", F.floor(F.log(F.col("n")) / F.lit(ratio)).cast("int").alias("band"))
    # blocks per band of a group; bands are at most a few hundred, whatever the group's size
    blocks = members.groupBy("component", "band").agg(
        F.ceil(F.greatest(F.count("*") / F.lit(block), F.sum("n") / F.lit(BLOCK_SHINGLES))).cast("int").alias("k")).groupBy("component").agg(
        F.map_from_entries(F.collect_list(F.struct("band", "k"))).alias("blocks"))
    part = F.pmod(F.xxhash64("digest"), F.col("blocks")[F.col("band")].cast("long"))
    placed = members.join(blocks, "component").withColumn("part", part)

    def tile_with(step: int):
        """The tiles of a class with the blocks of a neighbouring band (all of them in its own)."""
        k = F.coalesce(F.element_at("blocks", F.col("band") + F.lit(step)), F.lit(0)).cast("long")
        other = F.when(k > 0, F.sequence(F.lit(0).cast("long"), k - 1)).otherwise(F.array().cast("array<long>"))

        def name(j):
            low = F.struct((F.col("band") + F.lit(min(step, 0))).alias("band"),
                           (F.least("part", j) if step == 0 else F.col("part") if step > 0 else j).alias("i"),
                           (F.greatest("part", j) if step == 0 else j if step > 0 else F.col("part")).alias("j"),
                           F.lit(abs(step)).alias("step"),
                           # 0 and 1: the two blocks of the tile; -1: a block met with itself
                           (F.when(F.col("part") == j, -1).when(F.col("part") < j, 0).otherwise(1) if step == 0
                            else F.lit(0 if step > 0 else 1)).cast("int").alias("side"))
            return low

        return F.transform(other, name)

    in_tiles = placed.select("component", "digest", "rep", "copies", F.explode(
        F.concat(tile_with(-1), tile_with(0), tile_with(1))).alias("t")).select(
        "digest", "rep", "copies", F.xxhash64("component", "t.band", "t.i", "t.j", "t.step").alias("tile"),
        F.col("t.side").alias("side"))
    # a tile of one class alone compares nothing
    texts = class_texts(docs, members)

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sets = [], []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = shingles(text, size)
                if len(h) and digest(h) == key:  # two texts may share a text key
                    keys.append(key)
                    sets.append(h.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())],
                                             names=["digest", "hashes"])

    arrays = texts.mapInArrow(to_sets, "digest binary, hashes binary").dropDuplicates(["digest"])

    def run(table: pa.Table) -> pa.Table:
        keys, raw, copies, side = (table.column(c).to_pylist() for c in ("digest", "hashes", "copies", "side"))
        sets = [np.frombuffer(x, dtype=np.uint64) for x in raw]
        n = np.array([len(x) for x in sets])
        order = np.argsort(n, kind="stable")
        n = n[order]
        sets, keys = [sets[i] for i in order], [keys[i] for i in order]
        weight, side = np.array(copies)[order], np.array(side)[order]
        maps = [bitmap(x, bitmap_width(len(x))) for x in sets]
        links = np.zeros(len(keys), dtype=np.int64)
        pairs = []
        for i, js in linked(sets, n, maps, side, percent):
            links[i] += weight[js].sum()
            links[js] += weight[i]
            pairs.append((i, js))
        tie = dict(_ties(keys, iter(pairs)))
        return _table([(k, tie.get(k, k), int(x)) for k, x in zip(keys, links) if x], _LINK)

    return in_tiles.join(arrays, "digest").select("tile", "digest", "hashes", "copies", "side").groupBy(
        "tile").applyInArrow(run, "digest binary, tie binary, links long")


def with_class(placed: DataFrame, known: DataFrame) -> DataFrame:
    """Every document with the columns of its class. Classes that hold more than one in ``HOT_PARTS``
    of a partition's share of the documents are broadcast (there are fewer than partitions times
    ``HOT_PARTS``), so the shuffled join meets no digest of many documents."""
    most = HOT_PARTS * parallelism(placed.sparkSession)
    is_hot = F.col("copies") * F.lit(most) > F.lit(placed.count())
    hot, cold = known.where(is_hot), known.where(~is_hot)
    same = F.col("digest") == F.col("key")
    rest = placed.join(F.broadcast(hot.select("key")), same, "left_anti")
    return placed.join(F.broadcast(hot), same).unionByName(rest.join(cold, same))


def jaccard_join(docs: DataFrame, size: int = WORDS, percent: int = PERCENT, block: int = BLOCK,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links, n_copies, group_key, text_key`` for every input row.
    ``n_links`` counts linked documents, copies included; ``n_copies`` the documents with the same set,
    itself included; ``group_key`` names the group also where ids repeat (null: linked with nothing for
    want of words or of an id); ``text_key`` is a hash of the text."""
    spark = docs.sparkSession
    python_tasks(spark)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = named.withColumn("text_key", F.xxhash64("text"))
    rows = written(set_rows(keyed, size), "shingle-sets")
    known_common = rows.where("kind = 1").groupBy("doc_id").agg(F.sum("n").alias("n")).where(
        F.col("n") >= COMMON_FROM).orderBy(F.desc("n"), "doc_id").limit(COMMON_SHINGLES).collect()
    common = [r[0] for r in known_common]
    n_long = sum(r[1] > 2 * block for r in known_common)
    sets = rows.where("kind = 0").drop("kind")
    classes = sets.where("doc_id IS NOT NULL AND n > 0").groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.count("*").alias("copies"), F.min("n").alias("n"),
        F.min("bitmap").alias("bitmap")).withColumns(
        {"rep": F.col("first.doc_id"), "rep_key": F.col("first.text_key")}).drop("first")
    half = F.substring("digest", 1, 8)
    classes = written(classes.withColumn("sid", F.conv(F.hex(half), 16, -10).cast("long")), "shingle-classes")

    met = tiles(postings(named, size, percent, common, n_long), percent, 4 * parallelism(spark), block)
    groups = components(candidate_ties(met, classes, percent))
    links = written(verified(keyed, groups, classes, size, percent, block), "shingle-links")
    per_class = links.groupBy("digest").agg(F.sum("links").alias("links"))
    joined = components(links.select(F.col("digest").alias("a"), F.col("tie").alias("b")))
    named_groups = joined.join(classes.select("digest", "rep"), joined.node == F.col("digest")).select(
        "component", "digest", "rep")
    smallest = named_groups.groupBy("component").agg(F.min("rep").alias("low"))
    linked_classes = named_groups.join(smallest, "component").select("digest", "low", "component")

    known = classes.select("digest", "rep", "copies").join(linked_classes, "digest", "left").join(
        per_class, "digest", "left").select(
        F.col("digest").alias("key"), F.coalesce("low", "rep").alias("component_id"), "copies",
        F.coalesce("component", "digest").alias("group_key"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    has_class = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    out = with_class(sets.select("doc_id", "n", "digest", "text_key").where(has_class), written(known, "class-results")).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links", F.col("copies").alias("n_copies"),
        "group_key", "text_key")
    alone = sets.where(~has_class).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"),
        F.lit(None).cast("binary").alias("group_key"), "text_key")
    return out.unionByName(alone)


def keep_one_per_group(docs: DataFrame, size: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, with one document of each group of linked ones: the
    smallest id (of equal ids and different texts, one text). Rows without words or id all stay."""
    found = jaccard_join(docs, size, percent, id_col=id_col, text_col=text_col)
    found = written(found.select("doc_id", "component_id", "group_key", "text_key"), "groups")
    first = found.where("group_key IS NOT NULL AND doc_id = component_id").groupBy("group_key").agg(
        F.min(F.struct("doc_id", "text_key")).alias("k"), F.count("*").alias("n")).select("k.*", "n")
    stay = found.where("group_key IS NULL").select("doc_id", "text_key").distinct().withColumn(
        "n", F.lit(1).cast("long")).unionByName(first)
    stay = stay.select(F.col("doc_id").alias("_stay_id"), F.col("text_key").alias("_stay_key"), F.col("n").alias("_n"))
    rows = docs.select(F.struct("*").alias("_doc"), F.col(id_col).cast("long").alias("_id"),
                       F.xxhash64(F.col(text_col)).alias("_key"))
    kept = rows.join(stay, F.col("_id").eqNullSafe(F.col("_stay_id")) & (F.col("_key") == F.col("_stay_key")))
    # a row that occurs several times stays once; only such rows are ranked
    once = kept.where("_n = 1")
    again = kept.where("_n > 1").withColumn(
        "_row", F.row_number().over(Window.partitionBy("_id", "_key").orderBy(F.lit(0)))).where("_row = 1")
    return once.select("_doc.*").unionByName(again.select("_doc.*"))
