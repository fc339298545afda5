"""Words of whole texts as numpy arrays: offsets, 64-bit hashes, n-word window hashes.

A text is handled as its UTF-8 bytes. Words are runs of bytes outside the ASCII
blanks (space, \\t \\n \\v \\f \\r); other Unicode blanks belong to words. The work
memory is a small multiple of the text, so a very long text needs no special
case; an empty or null text has no words.

Hashes are modulo 2**64. They only route and prefilter; wherever two pieces of
text are declared equal, callers compare digests of the bytes themselves.
"""

from __future__ import annotations

import numpy as np

BLANKS = b" \t\n\x0b\x0c\r"
_IS_BLANK = np.zeros(256, dtype=bool)
_IS_BLANK[list(BLANKS)] = True
_LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_WINDOW_BASE = np.uint64(0xD6E8FEB86659FD93)
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
QUICK_BYTES = 64
STRETCH = 1 << 18  # bytes of text hashed at a time
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE**i`` and its inverse for i below ``n``, kept for the next text."""
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        step = np.full(size, _BASE, dtype=np.uint64)
        back = np.full(size, _BASE_INV, dtype=np.uint64)
        step[0] = back[0] = 1
        _powers, _inverses = np.multiply.accumulate(step), np.multiply.accumulate(back)
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift), so that every bit depends on all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(text: str | None, lower_az: bool = False) -> bytes:
    """The text's bytes; null gives none. ``lower_az`` lower-cases A-Z alone."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.translate(_LOWER_AZ) if lower_az else raw


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte offsets of the words."""
    word = np.zeros(len(raw) + 2, dtype=np.int8)
    word[1:-1] = ~_IS_BLANK[np.frombuffer(raw, dtype=np.uint8)]
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: differences of one running polynomial sum over the
    text, shifted back to the word's own start, mixed with the word's length."""
    out = np.zeros(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):  # one stretch of text after another, so work memory stays bounded
        base = int(starts[first])
        stop = max(first + 1, int(np.searchsorted(ends, base + STRETCH, side="right")))
        s, e = starts[first:stop] - base, ends[first:stop] - base
        n = int(e[-1])
        power, inverse = _power_tables(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((np.frombuffer(raw, dtype=np.uint8, count=n, offset=base).astype(np.uint64) + np.uint64(1))
                  * power[:n], out=total[1:])
        out[first:stop] = (total[e] - total[s]) * inverse[s]
        first = stop
    return mix(out + (ends - starts).astype(np.uint64) * _WINDOW_BASE)


def quick_word_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, eight bytes at a time (other values than ``word_hashes``); words over
    ``QUICK_BYTES`` go by ``word_hashes``."""
    eights = np.ndarray(len(raw), dtype="<u8", buffer=raw + bytes(8), strides=(1,))
    length = ends - starts
    out = mix((eights[starts] & _LOW_BYTES[np.minimum(length, 8)]) + length.astype(np.uint64) * _WINDOW_BASE)
    for done in range(8, QUICK_BYTES, 8):
        at = np.flatnonzero(length > done)
        if not len(at):
            return out
        out[at] = mix((eights[starts[at] + done] & _LOW_BYTES[np.minimum(length[at] - done, 8)]) + out[at] * _BASE)
    at = np.flatnonzero(length > QUICK_BYTES)
    out[at] = word_hashes(raw, starts[at], ends[at])
    return out


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every window of ``n`` consecutive words (none if there are fewer)."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    m = len(words) - n + 1
    h = words[:m].copy()
    for j in range(1, n):
        h *= _WINDOW_BASE
        h += words[j: j + m]
    return mix(h)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned 32-bit values as byte planes of their gaps: the high planes are nearly
    all zero, which the shuffle's compression removes."""
    gaps = np.diff(values.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    return gaps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    gaps = np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    return np.cumsum(gaps, dtype=np.uint32)


def stretches(raws: list[bytes], most: int = 1 << 20) -> list[tuple[int, int]]:
    """Consecutive texts in groups of about ``most`` bytes (a longer text is a group of its own)."""
    out, start, held = [], 0, 0
    for i, r in enumerate(raws):
        if held and held + len(r) > most:
            out.append((start, i))
            start, held = i, 0
        held += len(r)
    return out + [(start, len(raws))] if raws else out
