"""Splittable scan of delimited files whose quoted fields may hold line breaks (see ``split_scan``).

Pieces end at line feeds; the automaton knows whether a line begins within a quoted field. Quotes count at the
start of a field only, as in the engine's reader; within a quoted field the escape character takes what follows
into the field (two quotes are one where the quote itself is the escape character). Files whose only line ends are carriage returns are not split into lines.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cardlake.sources.split_scan import Effect, scan


class QuotedRecords:
    """The automaton of ``split_scan`` for records of comma-separated fields."""

    separator = "\n"

    def __init__(self, escape: str = "\\"):
        e = re.escape(escape)
        escaped = '[^"]++|""' if escape == '"' else rf'[^"{e}]++|{e}[\s\S]'
        in_quotes = rf'(?:{escaped})*+"[^,\n]*+'
        field = rf'(?:"{in_quotes}|(?:[^",\n][^,\n]*+)?+)'
        fields = rf"(?:,{field})*+\n"
        self.record = re.compile(f"{field}{fields}".encode())
        self.records = re.compile(f"(?:{field}{fields})*+".encode())
        self.rest = re.compile(f"{in_quotes}{fields}".encode())

    def whole(self, text: str) -> bool:
        """Whether a text without its line end is a whole record."""
        return self.record.fullmatch(text.encode("utf-8", "surrogatepass") + b"\n") is not None

    def effect(self, text: bytes) -> Effect:
        def ends_inside(start: int) -> bool:
            return self.records.match(text, start).end() < len(text)

        rest = self.rest.match(text)
        return (ends_inside(0), 0, ""), (ends_inside(rest.end()) if rest else True, 0, "")

    def runs(self, text: bytes, inside: bool, stack: str) -> Iterator[tuple[int, bytes]]:
        at = 0
        if inside:
            rest = self.rest.match(text)
            if not rest:
                yield 2, text
                return
            at = rest.end()
            yield 3, text[:at]
        while at < len(text):
            record = self.record.match(text, at)
            if not record:
                yield 1, text[at:]
                return
            at = record.end()
            yield 0, record.group()

    def overhangs(self, inside: bool, stack: str) -> bool:
        return inside


def _line(record: bytes) -> str:
    return record[: -2 if record.endswith(b"\r\n") else -1].decode()


def _lines(first: bool, found: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    records = [_line(r) for r in found]
    yield pa.RecordBatch.from_arrays([pa.array(records[1 if first else 0:], pa.string())], names=["record"])


def csv_records(spark: SparkSession, paths: str | list[str], escape: str = "\\", **options: str) -> DataFrame:
    """``record``: the text of every record but the first of each file, without its line end."""
    whole, overhanging = scan(spark, paths, QuotedRecords(escape), _lines, "record string", **options)
    text = overhanging.where("NOT first").selectExpr(r"regexp_replace(run, '\\r?\\n$', '') AS record")
    return whole.unionByName(text)


def header_names(header: str, escape: str = "\\") -> list[str]:
    """Column names of a header record, named as the engine's reader does: a nameless column by its place, a
    repeated name (letter case apart) with its place behind it."""
    quoting = {"doublequote": True} if escape == '"' else {"doublequote": False, "escapechar": escape}
    names = next(csv.reader([header], **quoting))
    folded = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if folded.count(n.lower()) > 1 else n for i, n in enumerate(names)]
