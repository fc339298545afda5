"""An FM-index over word numbers: suffix order, wavelet matrix, sampled positions.

The indexed sequence is a list of pieces, each closed by its own end mark, so no comparison or
match runs from one piece into the next. The end marks sort first, in the order of the pieces.
Word numbers start at 1. Arrays are a small multiple of the sequence; nothing is kept per phrase.
"""

from __future__ import annotations

import numpy as np

#: Every so many words of a piece the position is stored; others are found by walking back to one.
SAMPLE_STEP = 16
#: Occurrences that are walked to their positions at a time.
LOCATE_AT_ONCE = 1 << 18


def suffix_order(seq: np.ndarray, pieces: int, symbols: int) -> np.ndarray:
    """Suffixes in order, by prefix doubling; each round looks only at suffixes that still tie.

    ``seq`` has word numbers, 0 at the ends of pieces. Every end mark is a symbol of its own, so
    suffixes tie at most as far as the longest passage that repeats within the sequence."""
    n = len(seq)
    is_end = seq == 0
    rank = np.where(is_end, np.cumsum(is_end) - 1, seq.astype(np.int64) + (pieces - 1))
    bits = max(1, int(pieces + symbols).bit_length())
    depth = max(1, min(62 // bits, n))
    key = rank + 1
    for j in range(1, depth):
        key = key << bits
        key[:n - j] += rank[j:] + 1
    order = np.argsort(key)
    key = key[order]
    slots, starts = np.arange(n), np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    rank = np.empty(n, dtype=np.int64)
    while True:
        size = np.diff(np.r_[starts, len(slots)])
        first = np.repeat(slots[starts], size)
        rank[order[slots]] = first
        tied = np.repeat(size > 1, size)
        if not tied.any():
            return order
        slots, first = slots[tied], first[tied]
        at = order[slots]
        key = first * n + rank[at + depth]
        by_key = np.argsort(key)
        order[slots] = at[by_key]
        key = key[by_key]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        depth *= 2


class BitRank:
    """A bit vector with counts of ones before a position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype="<u8")
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class FMIndex:
    def __init__(self, pieces: list[np.ndarray], symbols: int):
        """``pieces``: word numbers from 1 to ``symbols``."""
        lengths = np.array([len(p) + 1 for p in pieces], dtype=np.int64)
        self.ends = np.cumsum(lengths) - 1
        self.n = int(lengths.sum())
        seq = np.zeros(self.n, dtype=np.int64)
        offset = np.arange(self.n) - np.repeat(self.ends + 1 - lengths, lengths)
        seq[offset < np.repeat(lengths - 1, lengths)] = np.concatenate(pieces)
        order = suffix_order(seq, len(pieces), symbols)
        sampled = offset[order] % SAMPLE_STEP == 0
        self.sampled, self.positions = BitRank(sampled), order[sampled]
        counts = np.bincount(seq, minlength=symbols + 1)
        self.smaller = np.cumsum(counts) - counts
        self.symbols = symbols
        self._wavelet(seq[order - 1], counts)

    def _wavelet(self, last: np.ndarray, counts: np.ndarray) -> None:
        """One bit vector per bit of the word numbers, the highest first; rows with a 0 move before those with a 1."""
        self.levels = max(1, self.symbols.bit_length())
        self.bits, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            one = (last >> level) & 1 == 1
            self.bits.append(BitRank(one))
            zeros = last[~one]
            self.zeros.append(len(zeros))
            last = np.concatenate([zeros, last[one]])
        mirrored = np.zeros(len(counts), dtype=np.int64)
        for level in range(self.levels):
            mirrored |= ((np.arange(len(counts)) >> level) & 1) << (self.levels - 1 - level)
        by_row = np.argsort(mirrored)
        self.first = np.empty(len(counts), dtype=np.int64)
        self.first[by_row] = np.cumsum(counts[by_row]) - counts[by_row]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` precedes one of the first ``at`` suffixes."""
        for level, (bits, zeros) in enumerate(zip(self.bits, self.zeros)):
            one = (symbol >> (self.levels - 1 - level)) & 1 == 1
            ones = bits.ones(at)
            at = np.where(one, zeros + ones, at - ones)
        return at - self.first[symbol]

    def back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one word earlier."""
        symbol = np.zeros(len(row), dtype=np.int64)
        at = row
        for bits, zeros in zip(self.bits, self.zeros):
            one, ones = bits.get(at), bits.ones(at)
            symbol = symbol << 1 | one
            at = np.where(one, zeros + ones, at - ones)
        return self.smaller[symbol] + at - self.first[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search. ``phrases``: a row of word numbers each, right-aligned, filled with 0 on the left,
        -1 for words that the index lacks. Returns the phrases found and the first and last + 1 row of each."""
        found = np.flatnonzero((phrases[:, -1] > 0) & (phrases >= 0).all(axis=1))
        low, high = np.zeros(len(found), dtype=np.int64), np.full(len(found), self.n, dtype=np.int64)
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[found, column]
            going = np.flatnonzero(symbol > 0)
            if not len(going):
                break
            s = symbol[going]
            low[going] = self.smaller[s] + self.rank(s, low[going])
            high[going] = self.smaller[s] + self.rank(s, high[going])
            alive = low < high
            found, low, high = found[alive], low[alive], high[alive]
        return found, low, high

    def locate(self, low: np.ndarray, high: np.ndarray):
        """Yields (index of the range, piece, word offset in the piece) arrays for all rows of the ranges."""
        total = np.cumsum(high - low)
        for start in range(0, int(total[-1]) if len(total) else 0, LOCATE_AT_ONCE):
            no = np.arange(start, min(start + LOCATE_AT_ONCE, int(total[-1])))
            which = np.searchsorted(total, no, side="right")
            row = high[which] - (total[which] - no)
            position = np.zeros(len(no), dtype=np.int64)
            todo = np.arange(len(no))
            steps = 0
            while len(todo):
                hit = self.sampled.get(row[todo])
                done = todo[hit]
                position[done] = self.positions[self.sampled.ones(row[done])] + steps
                todo = todo[~hit]
                row[todo] = self.back(row[todo])
                steps += 1
            piece = np.searchsorted(self.ends, position)
            begin = np.where(piece > 0, self.ends[piece - 1] + 1, 0)
            yield which, piece, position - begin
