"""Scans of giant files whose records may run over lines, by splits: a parallel prefix over an automaton.

A file is read in pieces that end at a separator byte, so a split may begin anywhere in a record. What a
stretch of text means depends on the state in which it begins, so each text is summed up by its effect:
for both ways it can begin (outside and inside a quoted string), whether it ends inside one, how many containers
that were open before it closes, and which it opens and leaves open.

1. Each task gathers the pieces of its splits into chunks. A chunk carries the effect of the split's text up to it.
   Chunks are written once to the scratch folder, so all readers see the same splits.
2. The effects of the splits, one row each, are composed per file: the state at the start of every split.
3. Every chunk starts from its true state and hands out the records that lie within it. Only chunks that a
   record overhangs are unpacked once more, and the parts of such records are put together.

The text is never shuffled: the states are sent to the chunks, and only the parts of cut records move.

An automaton gives ``separator`` (the byte at which pieces end), ``effect(text)``, ``runs(text, inside, stack)`` and
``overhangs(inside, stack)``; it is sent to the tasks as a value.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlake.session import ensure_checkpoint_dir, scratch_path, ship_package

#: A chunk is handed on when it holds so many bytes.
CHUNK_BYTES = 1 << 18

#: What a text does, by how it begins: outside a string, inside one.
Effect = tuple[tuple[bool, int, str], tuple[bool, int, str]]
NOTHING: Effect = ((False, 0, ""), (True, 0, ""))


class Automaton(Protocol):
    separator: str

    def effect(self, text: bytes) -> Effect: ...

    def runs(self, text: bytes, inside: bool, stack: str) -> Iterator[tuple[int, bytes]]:
        """``(part, text)``. Part 0: whole records; 1: the start of a record that goes on in the next chunk; 2: the next
        part of one; 3: its end."""

    def overhangs(self, inside: bool, stack: str) -> bool:
        """Whether a text that ends in this state, behind a separator, ends within a record."""


def composed(first: Effect, then: Effect) -> Effect:
    def one(inside: bool, closed: int, opened: str) -> tuple[bool, int, str]:
        ends, closes, opens = then[inside]
        kept = opened[: max(0, len(opened) - closes)]
        return ends, closed + max(0, closes - len(opened)), kept + opens

    return one(*first[0]), one(*first[1])


def applied(effect: Effect, inside: bool, stack: str) -> tuple[bool, str]:
    ends, closes, opens = effect[inside]
    return ends, stack[: max(0, len(stack) - closes)] + opens


_CHUNK_DDL = "file long, check int, block long, seq long, last boolean, before string, after string, text string"
_CHUNK = pa.schema([("file", pa.int64()), ("check", pa.int32()), ("block", pa.int64()), ("seq", pa.int64()),
                    ("last", pa.bool_()), ("before", pa.string()), ("after", pa.string()), ("text", pa.string())])


def _joined(texts: list[pa.Array], separator: str) -> bytes:
    """Pieces as they stand in the file: the separator behind each."""
    whole = pa.concat_arrays(texts)
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(whole)], whole), separator)
    return joined[0].as_buffer().to_pybytes() + separator.encode()


def _chunks(pieces: DataFrame, automaton: Automaton) -> DataFrame:
    """Pieces in file order to chunks. ``before`` and ``after``: the effect of the split's text up to the chunk's start
    and end; ``last``: the split's last chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seq, before, held, size = None, 0, NOTHING, [], 0

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal seq, before, held, size
            text = _joined(held, automaton.separator)
            after = composed(before, automaton.effect(text))
            row = [*split, seq, last, json.dumps(before), json.dumps(after), text]
            seq, before, held, size = seq + 1, after, [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _CHUNK)], schema=_CHUNK)

        for b in batches:
            where = [b.column(i).to_numpy() for i in range(3)]
            new = np.zeros(max(0, b.num_rows - 1), dtype=bool)
            for column in where:
                new |= column[1:] != column[:-1]
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
            for start, end in zip(edges, edges[1:]):
                if end == start:
                    continue
                here = tuple(int(column[start]) for column in where)
                if here != split:
                    if split is not None:
                        yield flush(True)
                    split, seq, before = here, 0, NOTHING
                part = b.column(3).slice(start, end - start)
                length = pc.sum(pc.binary_length(part)).as_py()
                if size and size + length > CHUNK_BYTES:
                    yield flush(False)
                held.append(part)
                size += length
        if split is not None:
            yield flush(True)

    return pieces.mapInArrow(run, _CHUNK_DDL)


def _starts(chunks: DataFrame) -> DataFrame:
    """The state at the start of every split: one row a split, composed in the order of the file."""
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("block").to_pylist(), table.column("after").to_pylist()))
        inside, stack, starts = False, "", []
        for _, after in rows:
            starts.append((inside, stack))
            inside, stack = applied(json.loads(after), inside, stack)
        return pa.table({
            "file": table.column("file"), "check": table.column("check"),
            "block": pa.array([r[0] for r in rows], pa.int64()), "inside": pa.array([s[0] for s in starts], pa.bool_()),
            "stack": pa.array([s[1] for s in starts], pa.string()),
        })

    return chunks.where("last").select("file", "check", "block", "after").groupBy("file", "check").applyInArrow(
        run, "file long, check int, block long, inside boolean, stack string")


#: Makes rows of the whole records of a chunk: (is the file's first chunk, runs of part 0) -> batches.
Emit = Callable[[bool, Iterator[bytes]], Iterator[pa.RecordBatch]]


def _whole(placed: DataFrame, automaton: Automaton, emit: Emit, ddl: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                inside, stack = applied(json.loads(row["before"]), row["inside"], row["stack"])
                found = automaton.runs(row["text"].encode(), inside, stack)
                yield from emit(row["block"] == row["seq"] == 0, (text for part, text in found if not part))

    return placed.select("block", "seq", "before", "inside", "stack", "text").mapInArrow(run, ddl)


def _parts(placed: DataFrame, automaton: Automaton) -> DataFrame:
    """The parts of records that chunks' edges cut. Texts of chunks that no record overhangs are not unpacked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            texts = b.column(b.schema.get_field_index("text"))
            for i, row in enumerate(b.select([n for n in b.schema.names if n != "text"]).to_pylist()):
                start, end = (applied(json.loads(row[side]), row["inside"], row["stack"]) for side in ("before", "after"))
                if not (automaton.overhangs(*start) or automaton.overhangs(*end)):
                    continue
                found = list(automaton.runs(texts[i].as_py().encode(), *start))
                lead = row["block"] == row["seq"] == 0 and bool(found) and found[0][0] == 1
                out += [(row["file"], row["check"], row["block"], row["seq"], part, text.decode(), lead)
                        for part, text in found if part]
            columns = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([
                pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
                pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int32()), pa.array(columns[5], pa.string()),
                pa.array(columns[6], pa.bool_())], names=["file", "check", "block", "seq", "part", "text", "lead"])

    return placed.select("file", "check", "block", "seq", "before", "after", "inside", "stack", "text").mapInArrow(
        run, "file long, check int, block long, seq long, part int, text string, lead boolean")


def scan(spark: SparkSession, path: str | list[str], automaton: Automaton, emit: Emit, ddl: str,
         **options: str) -> tuple[DataFrame, DataFrame]:
    """What ``emit`` makes of the records that lie within a chunk, and the others: ``run`` (their text), ``first`` (a
    file begins with it). The chunks are written when this is called, to a scratch folder
    under the session's checkpoint folder. ``options`` are those of the text reader."""
    ensure_checkpoint_dir(spark, None)
    ship_package(spark)
    file = F.col("_metadata.file_path")
    pieces = spark.read.options(**options).option("lineSep", automaton.separator).text(path).select(
        F.xxhash64(file).alias("file"), F.hash(file).alias("check"), F.col("_metadata.file_block_start").alias("block"), "value")
    folder = scratch_path(spark, "split-chunks")
    _chunks(pieces, automaton).write.option("compression", "zstd").parquet(folder)
    chunks = spark.read.schema(_CHUNK_DDL).parquet(folder)
    # one small row a split is sent to the chunks; a join by shuffle would move all texts, once for each use of them
    placed = chunks.join(F.broadcast(_starts(chunks)), ["file", "check", "block"])
    parts = _parts(placed, automaton)
    # a record begins with its part 1; the parts behind it, up to the next part 1, are its rest
    in_order = Window.partitionBy("file", "check").orderBy("block", "seq", (F.col("part") == 1))
    cut = parts.withColumn("record", F.sum(F.when(F.col("part") == 1, 1).otherwise(0)).over(in_order))
    piece = F.struct("block", "seq", "text", "lead")
    joined = cut.groupBy("file", "check", "record").agg(F.sort_array(F.collect_list(piece)).alias("parts"))
    return _whole(placed, automaton, emit, ddl), joined.select(
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("run"),
        F.element_at("parts", 1)["lead"].alias("first"))
