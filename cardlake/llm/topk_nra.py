"""Exact top-k by inner product with no-random-access aggregation (NRA).

The queries come in rounds of bounded bytes that are sent to the tasks; in each round the vectors are read where
they lie, block by block, and none is shuffled. Inside a block every component is a list of the block's
vectors sorted by value. For a query the lists are read from their good ends, in
stages. A vector's lower bound takes the worst value of each list where it was not
seen yet, its upper bound that list's present threshold. Reading stops when so few vectors can still
qualify that their final scores cost less than reading on: a vector qualifies if its upper bound reaches the
k-th lower bound of the block and the k-th score that the task found for the query before. A few queries
of a block read from the start; the others begin at the depth that these needed. A task hands on the ``k``
best of its vectors for each query, and these are merged by rank.

Defined results: vectors that are null, empty or hold null or non-finite components take no
part, nor do null ids. Vectors of different lengths do not score with each other. A query
does not meet rows of its own id; a repeated query id gives a list for each of its rows; repeated
candidate rows each count. Ties go to the smaller ``vec_id``. Scores are exact 64-bit integers;
a score outside that range saturates, as does a component that is infinite once it is scaled. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.tables import python_tasks, written

SCALE = 1024.0
STAGES = (0.25, 0.5, 0.75, 0.85, 0.9, 0.95, 1.0)  # parts of the lists read before each look at the bounds
#: Reading stops when at most one in so many vectors of a block can still qualify.
FEW = 16
#: Queries of a block that find out how deep to read.
SCOUTS = 8
#: Bytes of queries that are sent to the tasks at a time.
ROUND_BYTES = 16 << 20
LARGEST = np.finfo(np.float64).max


def _matrix(vectors: list) -> np.ndarray:
    with np.errstate(over="ignore"):
        scaled = np.floor(np.array(vectors, dtype=np.float64) * SCALE)
    return np.clip(scaled, -LARGEST, LARGEST)


def _final(rows: np.ndarray, query: np.ndarray) -> list[int]:
    """Exact integer inner products; beyond 64 bits they saturate."""
    if float(np.abs(rows).max(initial=0)) * float(np.abs(query).max(initial=0)) * len(query) < 2.0 ** 62:
        return (rows.astype(np.int64) @ query.astype(np.int64)).tolist()
    q = [int(x) for x in query]
    exact = [sum(int(a) * b for a, b in zip(r, q)) for r in rows]
    return [max(-(1 << 63), min((1 << 63) - 1, x)) for x in exact]


def nra(rows: np.ndarray, queries: np.ndarray, k: int, own: np.ndarray,
        known: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """For each query, positions of the rows that may be among its ``k`` best (all of them,
    ties included, and few others), and the part of the lists that was read. ``own[q]`` marks rows that
    take no part; a row below ``known[q]`` cannot qualify.

    All queries read their lists in step, so one stage is a few matrix products: for
    a positive query component the list is read from its largest value down, for a
    negative one from its smallest up. Per list, ``seen`` entries count with their own
    value; the others with the list's far end (lower bound) or its threshold (upper)."""
    n = len(rows)
    alive: list[np.ndarray] = [np.flatnonzero(~own[i]) for i in range(len(queries))]
    read = np.zeros(len(queries))
    floor = np.full(len(queries), -np.inf) if known is None else known
    ranked = np.sort(rows, axis=0)
    size = np.abs(rows).max(axis=0, initial=0)

    def read_on(active: np.ndarray, first: int) -> int:
        """Reads from a stage on until every query is done; the earliest stage at which one was."""
        earliest = len(STAGES) - 1
        for stage in range(first, len(STAGES)):
            if not len(active):
                break
            depth = min(n, max(k, int(n * STAGES[stage])))
            edge_down, edge_up = ranked[n - depth], ranked[depth - 1]
            plus, minus = np.maximum(queries[active], 0), np.minimum(queries[active], 0)
            # an entry tied with the threshold may count as seen: its value is the threshold
            seen_down, seen_up = rows >= edge_down, rows <= edge_up
            with np.errstate(over="ignore", invalid="ignore"):
                upper = plus @ np.where(seen_down, rows, edge_down).T + minus @ np.where(seen_up, rows, edge_up).T
                lower = plus @ np.where(seen_down, rows, ranked[0]).T + minus @ np.where(seen_up, rows, ranked[-1]).T
                # sums of integers in floating point: leave room for their rounding
                slack = 1e-9 * (np.abs(queries[active]) @ size + 1.0)
            # as far as scores go; a sum of opposite infinities bounds nothing
            upper = np.clip(np.where(np.isnan(upper), 2.0 ** 63, upper), -(2.0 ** 63), 2.0 ** 63)
            lower = np.clip(np.where(np.isnan(lower), -(2.0 ** 63), lower), -(2.0 ** 63), 2.0 ** 63)
            lower[own[active]] = upper[own[active]] = -np.inf
            kth = np.maximum(np.partition(lower, n - k, axis=1)[:, n - k], floor[active])
            may = upper >= (kth - np.minimum(slack, LARGEST))[:, None]
            may &= ~own[active]
            done = np.zeros(len(active), dtype=bool)
            for j, i in enumerate(active):
                alive[i] = np.flatnonzero(may[j])
                read[i] = STAGES[stage]
                done[j] = len(alive[i]) <= max(k, n // FEW)
            if done.any():
                earliest = min(earliest, stage)
            active = active[~done]
        return earliest

    active = np.array([i for i, x in enumerate(alive) if len(x) > k], dtype=np.int64)
    start = read_on(active[:SCOUTS], 0)
    read_on(active[SCOUTS:], max(0, start - 1))
    return alive, read


class Round:
    """The queries of one round, by the length of their vectors."""

    def __init__(self, rows: list[tuple[int, int, list[float]]], k: int, block_queries: int):
        self.k, self.block_queries = k, block_queries
        self.by_length: dict[int, list[tuple[int, int, list[float]]]] = {}
        for row in rows:
            self.by_length.setdefault(len(row[2]), []).append(row)

    def best(self, blocks: Iterator[tuple[np.ndarray, list]]) -> list[tuple[int, int, int, int, float]]:
        """``query_id, row_no, vec_id, score, read`` of the ``k`` best rows of all blocks for each query."""
        asked = {n: ([r[0] for r in rows], [r[1] for r in rows], _matrix([r[2] for r in rows]))
                 for n, rows in self.by_length.items()}
        found: dict[int, list[tuple[int, int]]] = {}
        depth: dict[int, list[float]] = {}
        for ids, vectors in blocks:
            lengths = np.array([len(v) for v in vectors])
            for dims in np.unique(lengths).tolist():
                if dims not in asked:
                    continue
                mine = np.flatnonzero(lengths == dims)
                m, mine_ids = _matrix([vectors[i] for i in mine]), ids[mine]
                query_ids, numbers, q = asked[dims]
                for at in range(0, len(q), self.block_queries):
                    part = slice(at, at + self.block_queries)
                    own = mine_ids[None, :] == np.array(query_ids[part])[:, None]
                    known = np.array([-found[no][-1][0] if len(found.get(no, ())) == self.k else -np.inf
                                      for no in numbers[part]], dtype=np.float64)
                    alive, read = nra(m, q[part], self.k, own, known)
                    for no, vec, rows, share in zip(numbers[part], q[part], alive, read.tolist()):
                        depth.setdefault(no, []).append(share)
                        if len(rows):
                            new = [(-s, int(i)) for s, i in zip(_final(m[rows], vec), mine_ids[rows])]
                            found[no] = sorted(found.get(no, []) + new)[: self.k]
        return [(qid, no, i, -s, sum(depth[no]) / len(depth[no])) for query_ids, numbers, _ in asked.values()
                for qid, no in zip(query_ids, numbers) for s, i in found.get(no, ())]


_FOUND = [("query_id", pa.int64()), ("row_no", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("read", pa.float64())]


def _blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[tuple[np.ndarray, list]]:
    ids, vectors = [], []
    for b in batches:
        ids += b.column(0).to_pylist()
        vectors += b.column(1).to_pylist()
        while len(ids) >= block_rows:
            yield np.array(ids[:block_rows], dtype=np.int64), vectors[:block_rows]
            ids, vectors = ids[block_rows:], vectors[block_rows:]
    if ids:
        yield np.array(ids, dtype=np.int64), vectors


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = 4096, block_queries: int = 256,
          with_read: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of ``vectors`` for each row of
    ``queries`` (both with an id and an array of numbers). ``with_read``: also ``read``, the part of the lists
    that the query read, on average over the blocks of the task that found the row."""

    python_tasks(vectors.sparkSession)

    def usable(df: DataFrame) -> DataFrame:
        vec = F.col(vector_col).cast("array<double>")
        far = F.lit(float("inf"))
        return df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where(
            F.col("vec_id").isNotNull() & (F.size("vec") > 0)
            & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < far)))

    v = usable(vectors)
    q = written(usable(queries).withColumn("row_no", F.monotonically_increasing_id()), "queries")
    size = q.agg(F.sum(F.size("vec") * 8 + 64)).first()[0] or 0
    rounds = max(1, -(-size // ROUND_BYTES))
    found = None
    for no in range(rounds):
        rows = q.where(F.pmod(F.xxhash64("row_no"), F.lit(rounds)) == no).select("vec_id", "row_no", "vec").collect()
        asked = Round([(r[0], r[1], r[2]) for r in rows], k, block_queries)

        def run(batches: Iterator[pa.RecordBatch], asked: Round = asked) -> Iterator[pa.RecordBatch]:
            best = asked.best(_blocks(batches, block_rows))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in best], kind) for i, (_, kind) in enumerate(_FOUND)],
                                             names=[name for name, _ in _FOUND])

        part = v.mapInArrow(run, "query_id long, row_no long, vec_id long, score long, read double")
        if rounds > 1:  # the driver holds the queries of one round at a time
            part = written(part, "round")
        found = part if found is None else found.unionByName(part)
    ranked = Window.partitionBy("query_id", "row_no").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score", *(["read"] if with_read else []))
