"""Quality classifier from weak labels: heuristic labellers, an expectation-maximisation
model of their accuracies, and a hashed linear scorer trained on its posteriors.

1. Labellers vote on every document: junk (0), clean (1) or no opinion (2). Votes are counted by
   pattern; with L labellers there are at most 3^L patterns, whatever the data's size.
2. EM on the pattern counts (a two-class model in which every labeller has its own table of
   vote probabilities per class) gives each pattern's probability of clean.
3. Every task sums, per hashed byte trigram, the clean and junk weight of its documents; the
   sums are added up by bucket. The scorer's weights are smoothed log-odds: one weight per
   bucket, ``2^BUCKET_BITS`` in all, the only thing broadcast.
4. A document's score is the mean weight of its trigrams and a few of ordinary clean text. The threshold is where the weak
   labels err least, found on a histogram of scores over all documents; the logistic function of the
   distance to it is the reported score.

All statistics cover all documents. No hand-made label is read: those measure the result.

Defined results: a document without words (null, empty or blank text) has no evidence: score 0, not
kept. A text under three bytes has no trigram and is judged by its posterior. Rows are judged one by
one; null ids, ties and repeated rows are passed through. Other columns of the input are not read by
name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.tables import python_tasks, written
from cardlake.llm.words import BLANKS, distinct, stretches, utf8, window_hashes, word_hashes, word_spans

JUNK, CLEAN, NONE = 0, 1, 2
BUCKET_BITS = 16
EM_ROUNDS = 100
SCORE_BINS = 2000
SCORE_RANGE = 8.0
STEEPNESS = 8.0
MIN_WORDS_TO_VOTE = 8

#: Trigrams' worth of ordinary clean text that every score starts from: a short text needs more than
#: one odd trigram to be rejected.
PRIOR_TRIGRAMS = 60

_LOWER, _UPPER, _STOP, _OTHER, _NEUTRAL = 0, 1, 2, 3, 4
_KINDS = np.full(256, _OTHER, dtype=np.uint8)
_KINDS[97:123] = _LOWER
_KINDS[128:] = _LOWER  # bytes of non-ASCII characters: letters of either case, counted as ordinary
_KINDS[65:91] = _UPPER
_KINDS[[ord(c) for c in ".,;:"]] = _STOP
# numbers, addresses and quotations say nothing about quality
_KINDS[[ord(c) for c in "0123456789+-()=@/'\"?"]] = _NEUTRAL
_SAYS_NOTHING = _KINDS == _NEUTRAL


def _vote(value: float, clean_up_to: float, junk_from: float) -> int:
    return CLEAN if value <= clean_up_to else JUNK if value >= junk_from else NONE


LABELLERS = ("odd characters", "odd word ends", "few plain words", "repeated windows", "few distinct words",
             "no sentences")


def votes(raw: bytes) -> list[int]:
    """One vote per labeller. The labellers overlap on purpose: several of them see each defect.
    Texts of a few words get no opinion."""
    starts, ends = word_spans(raw)
    n = len(starts)
    if n < MIN_WORDS_TO_VOTE:
        return [NONE] * len(LABELLERS)
    kinds = _KINDS[np.frombuffer(raw, dtype=np.uint8)]
    size = ends - starts
    odd = np.concatenate([[0], np.cumsum(kinds == _OTHER)])
    upper = np.concatenate([[0], np.cumsum(kinds == _UPPER)])
    n_odd, n_upper = odd[ends] - odd[starts], upper[ends] - upper[starts]
    last = kinds[ends - 1]
    plain = (n_odd == 0) & (n_upper <= 1)  # lower case but for a capital
    h = word_hashes(raw, starts, ends)
    windows = window_hashes(h, 3)
    return [
        _vote(float(n_odd.sum() / size.sum()), 0.03, 0.08),
        _vote(float((last == _OTHER).mean()), 0.1, 0.3),
        _vote(1 - float(plain.mean()), 0.15, 0.4),
        _vote(1 - len(distinct(windows)) / len(windows), 0.1, 0.4) if n >= 20 else NONE,
        _vote(1 - len(distinct(h)) / n, 0.5 + 0.05 * np.log10(n), 0.75 + 0.05 * np.log10(n)) if n >= 20 else NONE,
        _vote(1 - float((last == _STOP).mean()), 0.98, 0.995) if n >= 40 else NONE,
    ]


def pattern(raw: bytes) -> int:
    """The votes as one number in base 3."""
    out = 0
    for v in votes(raw):
        out = 3 * out + v
    return out


def fit(counts: dict[int, int], labellers: int = len(LABELLERS)) -> dict[int, float]:
    """EM over vote patterns; the probability of clean for each pattern."""
    if not counts:
        return {}
    keys = np.array(sorted(counts))
    n = np.array([counts[k] for k in keys], dtype=float)
    cast = np.stack([(keys // 3 ** (labellers - 1 - j)) % 3 for j in range(labellers)], axis=1)
    one = np.stack([cast == v for v in range(3)], axis=2).astype(float)  # pattern, labeller, vote
    clean = np.select([(cast == JUNK).sum(1) >= 2, (cast == JUNK).any(1)], [0.05, 0.5], 0.95)
    for _ in range(EM_ROUNDS):
        table = []
        for post in (1 - clean, clean):
            seen = np.einsum("p,plv->lv", n * post, one) + 0.1
            table.append(np.log(seen / seen.sum(axis=1, keepdims=True)))
        prior = ((n * clean).sum() + 1) / (n.sum() + 2)
        # an absent opinion is no evidence
        heard = one.copy()
        heard[:, :, NONE] = 0
        odds = np.log(prior / (1 - prior)) + np.einsum("plv,lv->p", heard, table[1] - table[0])
        clean = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return {int(k): float(p) for k, p in zip(keys, clean)}


def _trigrams(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the byte trigrams of all texts, and how many each text has. Trigrams
    that hold a digit or another sign without a say are left out."""
    if not raws:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    joined = np.frombuffer(b"".join(raws), dtype=np.uint8).astype(np.uint32)
    size = np.array([len(r) for r in raws], dtype=np.int64)
    key = joined[:-2] | joined[1:-1] << np.uint32(8) | joined[2:] << np.uint32(16) if len(joined) > 2 else (
        np.zeros(0, dtype=np.uint32))
    bucket = (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
    # drop the trigrams that reach over the end of their text
    inside = np.ones(len(bucket), dtype=bool)
    end = np.cumsum(size)
    for back in (1, 2):
        at = end[size >= back] - back
        inside[at[at < len(bucket)]] = False
    silent = _SAYS_NOTHING[joined[: len(bucket)]] | _SAYS_NOTHING[joined[1: len(bucket) + 1]] | (
        _SAYS_NOTHING[joined[2: len(bucket) + 2]])
    inside &= ~silent
    n = np.add.reduceat(np.append(inside, False), np.minimum(end - size, len(bucket)), dtype=np.int64) * (size > 0)
    return bucket[inside].astype(np.int64), n


def train(docs: DataFrame, posterior: dict[int, float]) -> tuple[np.ndarray, float]:
    """One weight per bucket (log-odds of the bucket under clean against junk), and the mean weight of
    clean text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BUCKET_BITS))
        for b in batches:
            raws = [utf8(t) for t in b.column(0).to_pylist()]
            clean = np.array([posterior.get(pattern(r), 0.5) for r in raws])
            for a, z in stretches(raws):
                bucket, n = _trigrams(raws[a:z])
                share = np.repeat(clean[a:z], n)
                total[1] += np.bincount(bucket, weights=share, minlength=1 << BUCKET_BITS)
                total[0] += np.bincount(bucket, weights=1 - share, minlength=1 << BUCKET_BITS)
        at = np.flatnonzero(total.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0][at]), pa.array(total[1][at])],
                                         names=["bucket", "junk", "clean"])

    sums = docs.select("text").mapInArrow(run, "bucket long, junk double, clean double").groupBy("bucket").agg(
        F.sum("junk").alias("junk"), F.sum("clean").alias("clean"))
    got = np.ones((2, 1 << BUCKET_BITS))
    for bucket, junk, clean in sums.collect():  # at most 2^BUCKET_BITS rows
        got[0, bucket] += junk
        got[1, bucket] += clean
    got /= got.sum(axis=1, keepdims=True)
    weights = np.round(np.log(got[1] / got[0]), 6)
    return weights, round(float(got[1] @ weights), 6)


class Scorer:
    """Everything a task needs to judge texts: posteriors by vote pattern, weights, prior."""

    def __init__(self, posterior: dict[int, float], weights: np.ndarray, ordinary: float):
        self.posterior, self.weights, self.ordinary = posterior, weights, ordinary

    def odds(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Mean weight of each text's trigrams and the prior's, and the number of its trigrams."""
        mean, count = [np.zeros(0)], [np.zeros(0, dtype=np.int64)]
        for a, z in stretches(raws):
            bucket, n = _trigrams(raws[a:z])
            upto = np.concatenate([[0.0], np.cumsum(self.weights[bucket])])
            end = np.cumsum(n)
            mean.append((upto[end] - upto[end - n] + PRIOR_TRIGRAMS * self.ordinary) / (n + PRIOR_TRIGRAMS))
            count.append(n)
        return np.round(np.concatenate(mean), 6), np.concatenate(count)


def _scored(docs: DataFrame, scorer: Scorer) -> DataFrame:
    known = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = known.value
        for b in batches:
            raws = [utf8(t) for t in b.column(1).to_pylist()]
            seen = [pattern(r) for r in raws]
            odds, n = s.odds(raws)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(r.split()) for r in raws], pa.int64()), pa.array(seen, pa.int64()),
                pa.array([s.posterior.get(p, 0.5) for p in seen], pa.float64()), pa.array(odds), pa.array(n > 0),
            ], names=["doc_id", "n_words", "votes", "posterior", "odds", "has_trigrams"])

    return docs.mapInArrow(
        run, "doc_id long, n_words long, votes long, posterior double, odds double, has_trigrams boolean")


def threshold(scored: DataFrame) -> float:
    """The log-odds at which the weak labels err least (the middle of the best stretch)."""
    width = 2 * SCORE_RANGE / SCORE_BINS
    binned = F.floor((F.greatest(F.lit(-SCORE_RANGE), F.least(F.lit(SCORE_RANGE - 1e-9), F.col("odds")))
                      + SCORE_RANGE) / width).cast("int")
    rows = scored.where("has_trigrams").groupBy(binned.alias("bin")).agg(
        F.sum("posterior").alias("clean"), F.count("*").alias("n")).collect()  # at most SCORE_BINS rows
    clean, junk = np.zeros(SCORE_BINS), np.zeros(SCORE_BINS)
    for r in rows:
        clean[r.bin], junk[r.bin] = r.clean, r.n - r.clean
    # keeping bins from t on errs on the clean below and the junk above
    wrong = np.concatenate([[0.0], np.cumsum(clean)]) + np.concatenate([np.cumsum(junk[::-1])[::-1], [0.0]])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-6)
    return float(best[len(best) // 2] * width - SCORE_RANGE)


def _fitted(named: DataFrame) -> Scorer:
    """The model of ``named`` (``doc_id, text``): EM on vote counts, then the trigram weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen, n = np.unique([pattern(utf8(t)) for t in b.column(0).to_pylist()], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(n, pa.int64())],
                                             names=["votes", "n"])

    counted = named.select("text").mapInArrow(run, "votes long, n long").groupBy("votes").agg(F.sum("n").alias("n"))
    posterior = fit({r.votes: r.n for r in counted.collect()})  # at most 3^labellers rows
    return Scorer(posterior, *train(named, posterior))


def _judged(scored: DataFrame, at: float) -> DataFrame:
    score = F.when(F.col("n_words") == 0, F.lit(0.0)).when(
        F.col("has_trigrams"), 1 / (1 + F.exp(-F.lit(STEEPNESS) * (F.col("odds") - F.lit(at))))).otherwise(
        F.col("posterior"))
    return scored.withColumn("score", F.round(score, 6)).withColumn("kept", F.col("score") >= 0.5).drop(
        "odds", "has_trigrams")


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    python_tasks(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def quality_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, votes, posterior, score, kept`` for every input row."""
    named = _named(docs, id_col, text_col)
    scored = written(_scored(named, _fitted(named)), "quality-scores")
    return _judged(scored, threshold(scored))


def quality_filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns as they are. The verdict is
    taken again where the row is, so no row moves."""
    named = _named(docs, id_col, text_col)
    scorer = _fitted(named)
    at = threshold(written(_scored(named, scorer), "quality-scores"))
    known = docs.sparkSession.sparkContext.broadcast(scorer)
    place = docs.columns.index(text_col)
    edge = at  # the logistic of the distance is 0.5 here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = known.value
        for b in batches:
            raws = [utf8(t) for t in b.column(place).to_pylist()]
            odds, n = s.odds(raws)
            keep = [bool(r.strip(BLANKS)) and (o >= edge if k else s.posterior.get(pattern(r), 0.5) >= 0.5)
                    for r, o, k in zip(raws, odds.tolist(), n.tolist())]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
