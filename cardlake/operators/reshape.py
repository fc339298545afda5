"""Nested reshaping: wide single-row objects to (key, value) rows, JSON maps to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StringType, StructField, StructType

# Fixed value: shape of the fraud label object, {"target": {"<id>": "<label>"}}.
FRAUD_OBJECT_SCHEMA = StructType([StructField("target", MapType(StringType(), StringType()), True)])


def wide_to_pairs(df: DataFrame, key_name: str, value_name: str, keep_nulls: bool = True) -> DataFrame:
    """Each column of a wide row becomes one (column name, value) row.

    ``keep_nulls=True`` is the map form (a NULL value keeps its row),
    ``keep_nulls=False`` the JSON round-trip form (NULL-valued keys vanish).
    Native ``unpivot``: no map materialised, no Python.
    """
    cols = df.columns
    casted = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    pairs = casted.unpivot([], cols, key_name, value_name)
    return pairs if keep_nulls else pairs.filter(F.col(value_name).isNotNull())


def parse_json(c: str | Column, schema: DataType | str) -> Column:
    return F.from_json(F.col(c) if isinstance(c, str) else c, schema)


def explode_map(df: DataFrame, map_col: str | Column, key_name: str, value_name: str) -> DataFrame:
    """One row per map entry; a NULL or empty map yields no row."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    return df.select(F.explode(m).alias(key_name, value_name))
