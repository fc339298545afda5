"""Rejects: values present as raw text that did not survive typing, counted and listed.

``reject_counts`` is a report over a raw frame. ``observed`` counts in passing, in the job that types the frame, so raw
is not read again for it; a map task that runs twice because its executor was lost may count its rows
twice, so where such a count matters to the row, take ``reject_counts`` or ``reject_rows``, which are plain
queries.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _is_bad(name: str, typed: Column) -> Column:
    raw = F.col(f"`{name}`")
    return raw.isNotNull() & (F.trim(raw.cast("string")) != "") & typed.isNull()


def reject_counts(raw: DataFrame, typed: Mapping[str, Column], table: str) -> DataFrame:
    """One row per column: rows whose raw text is non-empty but whose typed
    value is NULL. A single pass, one global aggregate (partial per task)."""
    aggs = []
    for name, expr in typed.items():
        aggs.append(F.sum(F.when(_is_bad(name, expr), 1).otherwise(0)).cast("long").alias(name))
    wide = raw.agg(*aggs)
    names = list(typed)
    return wide.unpivot([], names, "column_name", "rejected_rows").select(
        F.lit(table).alias("table_name"), "column_name", "rejected_rows"
    )


def observed(raw: DataFrame, typed: Mapping[str, Column], table: str) -> tuple[DataFrame, Observation]:
    """The raw frame, counting rejects as it passes; the counts are there once an action on what is made of
    the frame has ended."""
    seen = Observation(f"rejects_{table}")
    counts = [F.count(F.when(_is_bad(name, expr), 1)).alias(name) for name, expr in typed.items()]
    return raw.observe(seen, *counts), seen


def observed_counts(spark: SparkSession, seen: Observation, table: str) -> DataFrame:
    """The rows of ``reject_counts`` from an observation (one row a column)."""
    rows = [(table, name, int(n)) for name, n in seen.get.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, rejected_rows long")


def reject_rows(raw: DataFrame, typed: Mapping[str, Column], table: str, key: str) -> DataFrame:
    """``table_name, column_name, row_key, raw_text`` for every rejected value. One pass that reads the typed
    columns and the key only."""
    found = F.array_compact(F.array(*[
        F.when(_is_bad(name, expr), F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").cast("string").alias("raw_text")))
        for name, expr in typed.items()]))
    return raw.select(F.col(f"`{key}`").cast("string").alias("row_key"), F.explode(found).alias("bad")).select(
        F.lit(table).alias("table_name"), "bad.column_name", "row_key", "bad.raw_text")
