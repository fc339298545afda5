"""Quality rules by repetition coverage: the share of a text's characters inside
duplicated word n-grams of several lengths and inside duplicated lines.

Words get consecutive numbers within their text, so a number stands for exactly one
word; n-gram hashes of those numbers roll from one length to the next
(``h[n+1] = h[n] * B + next word``). An (n+1)-gram can only repeat where its n-gram
does, so each longer length looks only at the positions the shorter one left. The
base counts are exact: 3-word windows compare word numbers, not hashes.

Defined results: a null text is an empty one (all counts 0, ``base_failed``, not kept);
rows are judged one by one, so null ids, ties and repeated rows need no rule. Work
memory is a small multiple of the text. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.tables import python_tasks
from cardlake.llm.words import mix, utf8

BASE_WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Most characters inside duplicated n-grams that a kept text may have, by n.
MAX_NGRAM_SHARE = {5: 0.40, 6: 0.38, 7: 0.36, 8: 0.34, 9: 0.32, 10: 0.30}
MAX_LINE_SHARE = 0.30
MAX_SYMBOLS_PER_WORD = 0.1
SYMBOLS = b"#*$%&|<>"

_B = np.uint64(0xD6E8FEB86659FD93)
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries occur at least twice."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    hit = np.zeros(len(keys), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    return hit


def _covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in an n-word window that starts at one of ``starts``."""
    step = np.zeros(words + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + n, -1)
    return np.cumsum(step[:-1]) > 0


def coverage(text: str | None, shares: dict[int, float] = MAX_NGRAM_SHARE) -> dict:
    raw = utf8(text)
    words = raw.split()
    n_words = len(words)
    code_points = np.fromiter((len(w) for w in words), dtype=np.int64, count=n_words) if raw.isascii() else (
        np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in words), dtype=np.int64, count=n_words))
    chars = int(code_points.sum())
    n_symbols = int(_IS_SYMBOL[np.frombuffer(raw, dtype=np.uint8)].sum())

    seen: set[bytes] = set()
    n_dup_lines = dup_line_chars = line_chars = 0
    for line in raw.split(b"\n"):
        if line.strip():
            line_chars += len(line)
            if line in seen:
                n_dup_lines += 1
                dup_line_chars += len(line)
            seen.add(line)

    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.uint64, count=n_words)
    n_repeat, ngram_share = 0, {n: 0.0 for n in shares}
    if n_words >= BASE_WINDOW:
        m = n_words - BASE_WINDOW + 1
        if len(number) < 1 << 21:
            exact = (ids[:m] << np.uint64(42)) | (ids[1: m + 1] << np.uint64(21)) | ids[2: m + 2]
        else:  # more distinct words than 21 bits hold: number the pairs first
            pair = ids[:-1] * np.uint64(len(number)) + ids[1:]
            exact = np.unique(pair, return_inverse=True)[1][:m].astype(np.uint64)
            exact = exact * np.uint64(len(number)) + ids[2: m + 2]
        at = np.flatnonzero(_repeated(exact))
        n_repeat = int(_covered(at, BASE_WINDOW, n_words).sum())
        value = mix(ids + np.uint64(1))
        # roll on from length 3; only positions whose shorter n-gram repeats can repeat
        h = value[at]
        for j in range(1, BASE_WINDOW):
            h = h * _B + value[at + j]
        n = BASE_WINDOW
        while len(at) and n < max(shares):
            fits = at + n < n_words
            at, h = at[fits], h[fits]
            h = h * _B + value[at + n]
            n += 1
            if len(at):
                hit = _repeated(h)
                at, h = at[hit], h[hit]
            if n in shares and len(at):
                ngram_share[n] = float(code_points[_covered(at, n, n_words)].sum() / chars)

    line_share = dup_line_chars / line_chars if line_chars else 0.0
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    kept = (not base_failed and line_share <= MAX_LINE_SHARE
            and all(ngram_share[n] <= most for n, most in shares.items())
            and n_symbols <= MAX_SYMBOLS_PER_WORD * n_words)
    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat, "base_failed": base_failed, "kept": kept,
        "dup_line_share": line_share, "dup_ngram_shares": [ngram_share[n] for n in sorted(shares)],
    }


_RESULT = pa.schema([
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
    ("kept", pa.bool_()), ("dup_line_share", pa.float64()), ("dup_ngram_shares", pa.list_(pa.float64())),
])
_DDL = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, dup_line_share double, dup_ngram_shares array<double>")


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and the rules' columns. A map over rows: no shuffle."""
    python_tasks(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = pa.RecordBatch.from_pylist([coverage(t.as_py()) for t in b.column(1)], schema=_RESULT)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *rows.columns], names=["doc_id", *_RESULT.names])

    return named.mapInArrow(run, f"doc_id long, {_DDL}")
