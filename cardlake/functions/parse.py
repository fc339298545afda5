"""Tolerant parsing of the raw text shapes (money, month/year, YES/NO, timestamps).

All parsing is ANSI-safe: a value that does not parse becomes NULL instead of
failing the job, and the reject report (``operators.quality``) counts such rows.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw formats of the source files.
MONEY_STRIP_PATTERN = "[$,]"
MONTH_YEAR_PATTERN = "MM/yyyy"
SOURCE_TIME_LENGTH = 16  # MM-dd-yyyy HH:mm
YES_TEXT = "YES"
NO_TEXT = "NO"
MONTH_NAME_PATTERN = "MMMM"
LARGEST_DOUBLE = sys.float_info.max


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """``$1,234.56`` -> 1234.56 (double); empty, non-numeric or non-finite text -> NULL."""
    value = F.regexp_replace(_col(c).cast("string"), MONEY_STRIP_PATTERN, "").try_cast("double")
    return F.when(value.between(-LARGEST_DOUBLE, LARGEST_DOUBLE), value)


def to_long(c: str | Column) -> Column:
    return _col(c).try_cast("long")


def to_int(c: str | Column) -> Column:
    return _col(c).try_cast("int")


def month_year_date(c: str | Column) -> Column:
    """``12/2022`` -> 2022-12-01; an impossible month such as ``13/2020`` -> NULL."""
    return F.try_to_date(_col(c).cast("string"), MONTH_YEAR_PATTERN)


def yes_no(c: str | Column) -> Column:
    """Trimmed, case-folded YES -> true, NO -> false, anything else -> NULL."""
    norm = F.upper(F.trim(_col(c)))
    return F.when(norm == YES_TEXT, F.lit(True)).when(norm == NO_TEXT, F.lit(False))


def parse_timestamp(c: str | Column) -> Column:
    """Text or timestamp -> TIMESTAMP_NTZ; NULL if it is neither the source's layout nor ISO.

    The source's ``MM-dd-yyyy HH:mm`` is first laid out as ISO; ISO text and timestamp columns
    (as a reader with type inference gives) already are. Separators are looked at by their places, without
    a regular expression; one zone-free, ANSI-safe cast reads both and rejects what is no digit."""
    text = _col(c).cast("string")

    def has(place: int, *marks: str) -> Column:
        return F.substring(text, place, 1).isin(*marks)

    source = (F.length(text) == SOURCE_TIME_LENGTH) & has(3, "-") & has(6, "-") & has(11, " ") & has(14, ":")
    iso = has(5, "-") & has(8, "-") & has(11, " ", "T") & has(14, ":")
    laid_out = F.concat(F.substring(text, 7, 4), F.lit("-"), F.substring(text, 1, 5), F.substring(text, 11, 6), F.lit(":00"))
    return F.when(source, laid_out).when(iso, text).try_cast("timestamp_ntz")


def calendar_parts(ts: str | Column, prefix: str = "transaction_") -> dict[str, Column]:
    """Date, year, month number and full English month name of a timestamp."""
    t = _col(ts)
    return {
        f"{prefix}date": F.to_date(t),
        f"{prefix}year": F.year(t),
        f"{prefix}month": F.month(t),
        f"{prefix}month_name": F.date_format(t, MONTH_NAME_PATTERN),
    }


def trimmed(c: str | Column) -> Column:
    return F.trim(_col(c).cast("string"))
