"""Declared schemas of the raw files (no inference pass over the data)."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


RAW_USERS = _s(
    ("id", LongType()), ("current_age", IntegerType()), ("retirement_age", IntegerType()),
    ("birth_year", IntegerType()), ("birth_month", IntegerType()), ("gender", StringType()),
    ("address", StringType()), ("latitude", DoubleType()), ("longitude", DoubleType()),
    ("per_capita_income", StringType()), ("yearly_income", StringType()), ("total_debt", StringType()),
    ("credit_score", IntegerType()), ("num_credit_cards", IntegerType()),
)

RAW_CARDS = _s(
    ("id", LongType()), ("client_id", LongType()), ("credit_limit", StringType()),
    ("num_cards_issued", IntegerType()), ("acct_open_date", StringType()), ("expires", StringType()),
    ("has_chip", StringType()), ("card_on_dark_web", StringType()),
)

RAW_TRANSACTIONS = _s(
    ("id", LongType()), ("date", StringType()), ("client_id", LongType()), ("card_id", LongType()),
    ("amount", StringType()), ("use_chip", StringType()), ("merchant_id", LongType()),
    ("merchant_city", StringType()), ("merchant_state", StringType()), ("zip", StringType()),
    ("mcc", IntegerType()),
)

RAW_CSV_SCHEMAS = {"users": RAW_USERS, "cards": RAW_CARDS, "transactions": RAW_TRANSACTIONS}
