"""Spelling variants: vocabulary words one edit apart, each linked to its much more frequent form.

Words are counted over whole texts. Every word's neighbourhood is generated as hashes: a polynomial hash of
the word gives the hash of each deletion and replacement in constant time, so no edited string is built, however
long the word (insertions are deletions seen from the longer word, and a replacement is generated from the
smaller of its two letters). The hashes are probed against Bloom filters of the vocabulary, sharded by
word length and blocked by 64 bits. Only the positives are shuffled: they meet the vocabulary in an exact
join by hash, and the edit is then carried out on the word and compared, which removes false positives
and equal hashes alike.

The filters are built by a grouped bitwise-or and broadcast in rounds of bounded bytes; a vocabulary of any
size takes as many rounds as it needs. A word's links to the root are followed by pointer doubling;
counts at least double on the way, so a chain has fewer than 64 words.

Defined results: a null text has no words, a null id is hashed as ''. Repeated rows count each time they occur. Ties in n go to
the smaller word in code-point order. Very long words take part like all others. Rows may have any
other columns; they are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.tables import python_tasks, written
from cardlake.llm.words import mix

# The letters of words, and which occurrences lose a letter.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
NOISE_STEP = 97
MIN_LENGTH = 5
MIN_COUNT = 3
FORM_FACTOR = 2

#: Counts that a task holds before it hands them on, and the texts they come from.
HELD_WORDS, HELD_BYTES = 1 << 18, 64 << 20
#: Words from this length on share a filter.
LONGEST_SHARD = 64
WORDS_PER_BLOCK = 4
BITS_SET = 5
#: Filter bytes that are broadcast at a time.
ROUND_BYTES = 16 << 20
#: Letters of words whose edits are generated together.
EDITED_LETTERS = 1 << 15

_LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_LENGTH = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str | None) -> list[bytes]:
    """The runs, A-Z lower-cased, as UTF-8."""
    runs = RUN.findall(text or "")
    return "\n".join(runs).encode().translate(_LOWER_AZ).split(b"\n") if runs else []


def without_letter(word: bytes, h: int) -> bytes:
    letters = word.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def count_words(total: Counter, doc_id: int | None, text: str | None) -> None:
    words = words_of(text)
    total.update(words)
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    noisy = [(w, h) for w in set(words) if not (h := zlib.crc32(w, seed)) % NOISE_STEP]
    if noisy:
        times = Counter(words)
        for word, h in noisy:
            total[word] -= times[word]
            total[without_letter(word, h)] += times[word]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of the vocabulary. Tasks count before the shuffle, so a frequent word is one row per task."""
    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        size = 0

        def flush() -> pa.RecordBatch:
            rows = [(w.decode(), n) for w, n in total.items() if n and len(w) >= MIN_LENGTH]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                               pa.array([r[1] for r in rows], pa.int64())], names=["word", "n"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                count_words(total, doc_id, text)
                size += len(text or "")
                if len(total) > HELD_WORDS or size > HELD_BYTES:
                    yield flush()
                    size = 0
        yield flush()

    counts = named.mapInArrow(run, "word string, n long").where(F.length("word") >= MIN_LENGTH)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


class Letters:
    """The letters of several words one after another, with the running hash of each word."""

    def __init__(self, words: list[str]):
        self.code = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.word = np.repeat(np.arange(len(words)), self.length)
        self.at = np.arange(len(self.code)) - self.start[self.word]
        powers = np.full(int(self.length.max(initial=0)) + 1, _BASE, dtype=np.uint64)
        powers[0] = 1
        self.power = np.multiply.accumulate(powers)[self.at]
        upto = np.cumsum(self.code * self.power)
        before = np.r_[np.uint64(0), upto[:-1]]
        base = before[self.start] if len(words) else before[:0]
        self.total = (upto[self.start + self.length - 1] if len(words) else upto) - base
        self.before, self.upto = before - base[self.word], upto - base[self.word]

    def hashes(self) -> np.ndarray:
        return mix(self.total + self.length.astype(np.uint64) * _LENGTH)

    def edits(self) -> Iterator[tuple[np.ndarray, np.ndarray, str]]:
        """(letter edited, hash of the result, new letter) arrays: '' for deletions."""
        last = self.at == self.length[self.word] - 1
        other = np.r_[self.code[1:] != self.code[:-1], True][: len(self.code)]
        gone = np.flatnonzero((last | other) & (self.length[self.word] > MIN_LENGTH))  # one deletion of each run of a letter
        total = self.total[self.word]
        shorter = self.before[gone] + (total[gone] - self.upto[gone]) * _BASE_INVERSE
        yield gone, mix(shorter + (self.length[self.word[gone]] - 1).astype(np.uint64) * _LENGTH), ""
        length = self.length[self.word].astype(np.uint64) * _LENGTH
        for letter in LETTERS:
            new = np.flatnonzero(self.code < letter)
            changed = total[new] + (np.uint64(letter) - self.code[new]) * self.power[new]
            yield new, mix(changed + length[new]), chr(letter)


def _hashed(counts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = Letters(b.column(0).to_pylist()).hashes()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(h.view(np.int64))], names=["word", "n", "hash"])

    return counts.mapInArrow(run, "word string, n long, hash long")


class Filters:
    """Where the blocks of each length's filter lie, and the blocks of one round."""

    def __init__(self, counts: dict[int, int]):
        self.blocks = np.zeros(LONGEST_SHARD + 1, dtype=np.uint64)
        for shard, n in counts.items():
            self.blocks[shard] = math.ceil(n / WORDS_PER_BLOCK)
        self.offset = np.r_[0, np.cumsum(self.blocks)[:-1]].astype(np.int64)
        self.total = int(self.blocks.sum())
        self.low, self.bits = 0, np.zeros(0, dtype=np.uint64)

    def rows(self, vocabulary: DataFrame) -> DataFrame:
        """``block, mask`` of all filters, by the same rule as ``holds``."""
        shard = F.least(F.length("word"), F.lit(LONGEST_SHARD)) + 1
        blocks, offset = (F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in column]), shard)
                          for column in (self.blocks, self.offset))
        block = offset + F.shiftright(F.shiftrightunsigned("hash", 32) * blocks, 32)
        mask = F.lit(0).cast("long")
        for i in range(BITS_SET):
            bit = F.shiftrightunsigned("hash", 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
        return vocabulary.select(block.alias("block"), mask.alias("mask")).groupBy("block").agg(
            F.bit_or("mask").alias("mask"))

    def load(self, rows: pa.Table, low: int, high: int) -> None:
        self.low, self.bits = low, np.zeros(high - low, dtype=np.uint64)
        block = rows.column("block").to_numpy()
        self.bits[block - low] = rows.column("mask").to_numpy().view(np.uint64)

    def holds(self, hashes: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Which hashes a word of that length may have; hashes of other rounds' blocks are left out."""
        shard = np.minimum(length, LONGEST_SHARD)
        blocks = self.blocks[shard]
        at = self.offset[shard] + ((hashes >> np.uint64(32)) * blocks >> np.uint64(32)).astype(np.int64) - self.low
        mine = np.flatnonzero((blocks > 0) & (at >= 0) & (at < len(self.bits)))
        h = hashes[mine]
        mask = np.zeros(len(h), dtype=np.uint64)
        for i in range(BITS_SET):
            mask |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
        return mine[self.bits[at[mine]] & mask == mask]


_POSITIVES = [("hash", pa.int64()), ("twin", pa.int32()), ("candidate", pa.int64()), ("at", pa.int32()), ("letter", pa.string())]


def _positives(vocabulary: DataFrame, filters: Filters) -> DataFrame:
    """The edits that the loaded filters may hold: ``hash, twin`` of the word, ``candidate`` hash, place, new letter."""
    def probe(words: list[str], ids: np.ndarray, twins: np.ndarray) -> Iterator[pa.RecordBatch]:
        letters = Letters(words)
        for edited, hashes, letter in letters.edits():
            length = letters.length[letters.word[edited]] - (letter == "")
            hit = filters.holds(hashes, length)
            if len(hit):
                edited = edited[hit]
                word = letters.word[edited]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[word]), pa.array(twins[word]), pa.array(hashes[hit].view(np.int64)),
                    pa.array(letters.at[edited].astype(np.int32)), pa.array([letter] * len(hit), pa.string()),
                ], names=[name for name, _ in _POSITIVES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        letters = 0
        for b in batches:
            held.append(b)
            letters += sum(map(len, b.column(0).to_pylist()))
            if letters >= EDITED_LETTERS:
                rows = pa.Table.from_batches(held)
                yield from probe(rows.column(0).to_pylist(), rows.column(1).to_numpy(), rows.column(2).to_numpy())
                held, letters = [], 0
        if held:
            rows = pa.Table.from_batches(held)
            yield from probe(rows.column(0).to_pylist(), rows.column(1).to_numpy(), rows.column(2).to_numpy())

    return vocabulary.select("word", "hash", "twin").mapInArrow(
        run, "hash long, twin int, candidate long, at int, letter string")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``word, near, near_n`` for every ordered pair of words one edit apart."""
    shards = vocabulary.groupBy(F.least(F.length("word"), F.lit(LONGEST_SHARD)).alias("shard")).count().collect()
    filters = Filters({r["shard"]: r["count"] for r in shards})
    filter_rows = written(filters.rows(vocabulary), "bloom")
    per_round = ROUND_BYTES // 8
    pairs = None
    for low in range(0, max(1, filters.total), per_round):
        high = min(low + per_round, filters.total)
        filters.load(filter_rows.where(F.col("block").between(low, high - 1)).toArrow(), low, high)
        found = written(_positives(vocabulary, filters), "positives")
        pairs = found if pairs is None else pairs.unionByName(found)
    other = vocabulary.select(F.col("hash").alias("candidate"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    edited = F.call_function("overlay", F.col("word"), F.col("letter"), F.col("at") + 1, F.lit(1))
    exact = written(pairs.join(other, "candidate").join(vocabulary, ["hash", "twin"]).where(edited == F.col("other")).select(
        "word", "n", "other", "other_n"), "near")
    return exact.select("word", F.col("other").alias("near"), F.col("other_n").alias("near_n")).unionByName(
        exact.select(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for every word with a form: each round doubles the distance of the pointers."""
    pointers = forms.select("word", F.col("form").alias("root"))
    while True:
        step = pointers.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(pointers.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        pointers = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return pointers


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary."""
    python_tasks(docs.sparkSession)
    twins = Window.partitionBy("hash").orderBy("word")
    vocabulary = written(_hashed(word_counts(docs, id_col, text_col)).withColumn(
        "twin", F.row_number().over(twins)), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    linked = near_words(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    has_form = -F.col("best.n") >= FORM_FACTOR * F.col("n")
    judged = written(vocabulary.select("word", "n").join(linked, "word", "left").select(
        "word", F.when(has_form, F.col("best.word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has_form, -F.col("best.n")).alias("form_n")), "forms")
    return judged.join(_roots(judged.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
