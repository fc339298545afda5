"""Silver layer: typed, de-duplicated tables (one row per key).

Each cleaner takes the bronze/raw frame and returns the silver frame; the
typed-column mappings are exposed so the reject report checks exactly the
parsing the cleaner applies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions import parse as P
from cardlake.functions import rules as R
from cardlake.operators.dedup import dedup_by_key


def _apply(df: DataFrame, typed: dict[str, Column]) -> DataFrame:
    """Replace columns in place (order kept), like a chain of withColumn."""
    return df.withColumns(typed)


def users_typed() -> dict[str, Column]:
    return {
        "id": P.to_long("id"),
        "current_age": P.to_int("current_age"),
        "retirement_age": P.to_int("retirement_age"),
        "birth_year": P.to_int("birth_year"),
        "birth_month": P.to_int("birth_month"),
        "latitude": F.col("latitude").try_cast("double"),
        "longitude": F.col("longitude").try_cast("double"),
        "per_capita_income": P.money("per_capita_income"),
        "yearly_income": P.money("yearly_income"),
        "total_debt": P.money("total_debt"),
        "credit_score": P.to_int("credit_score"),
        "num_credit_cards": P.to_int("num_credit_cards"),
    }


def clean_users(raw: DataFrame) -> DataFrame:
    return dedup_by_key(_apply(raw, users_typed()), "id")


def cards_typed() -> dict[str, Column]:
    return {
        "id": P.to_long("id"),
        "client_id": P.to_long("client_id"),
        "credit_limit": P.money("credit_limit"),
        "num_cards_issued": P.to_int("num_cards_issued"),
        "acct_open_date": P.month_year_date("acct_open_date"),
        "expires": P.month_year_date("expires"),
        "has_chip": P.yes_no("has_chip"),
        "card_on_dark_web": P.yes_no("card_on_dark_web"),
    }


def clean_cards(raw: DataFrame) -> DataFrame:
    return dedup_by_key(_apply(raw, cards_typed()), "id")


def transactions_typed() -> dict[str, Column]:
    return {
        "id": P.to_long("id"),
        "client_id": P.to_long("client_id"),
        "card_id": P.to_long("card_id"),
        "merchant_id": P.to_long("merchant_id"),
        "mcc": P.to_int("mcc"),
        "amount": P.money("amount"),
        "zip": F.col("zip").cast("string"),
    }


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Typed transactions, one row per id, with calendar parts, type and
    absolute amount.

    The derived columns are functions of columns that precede them in the
    kept-row order (amount, timestamp), so the smallest row is decided by the
    base columns alone: de-duplicate on those first, then derive on the kept
    rows only. Same result as de-duplicating the wide row, with a narrower
    shuffle and no derivation work for dropped copies."""
    typed = _apply(raw, transactions_typed()).withColumn("transaction_timestamp", P.parse_timestamp("date"))
    kept = dedup_by_key(typed.drop("date"), "id")
    return kept.withColumns(P.calendar_parts("transaction_timestamp")).withColumns(
        {
            "transaction_type": R.transaction_type("amount"),
            "transaction_amount": R.absolute_amount("amount"),
        }
    )


def mcc_typed() -> dict[str, Column]:
    return {"mcc": P.to_int("mcc"), "category": P.trimmed("category")}


def clean_mcc_codes(raw: DataFrame) -> DataFrame:
    t = raw.select(*[e.alias(n) for n, e in mcc_typed().items()])
    t = t.filter(F.col("mcc").isNotNull() & F.col("category").isNotNull())
    return dedup_by_key(t, "mcc")


def fraud_typed() -> dict[str, Column]:
    return {"transaction_id": P.to_long("transaction_id"), "fraud_label": F.col("fraud_label").cast("string")}


def clean_fraud_labels(raw: DataFrame) -> DataFrame:
    """is_fraud is a function of fraud_label (which precedes it in the kept-row
    order), so it is derived after de-duplication."""
    t = raw.select(*[e.alias(n) for n, e in fraud_typed().items()])
    return dedup_by_key(t, "transaction_id").withColumn("is_fraud", R.fraud_flag("fraud_label"))


CLEANERS = {
    "users": clean_users,
    "cards": clean_cards,
    "transactions": clean_transactions,
    "mcc_codes": clean_mcc_codes,
    "fraud_labels": clean_fraud_labels,
}

# The column that names a row in each raw table.
KEYS = {"users": "id", "cards": "id", "transactions": "id", "mcc_codes": "mcc", "fraud_labels": "transaction_id"}

TYPED = {
    "users": users_typed,
    "cards": cards_typed,
    "transactions": lambda: {**transactions_typed(), "date": P.parse_timestamp("date")},
    "mcc_codes": mcc_typed,
    "fraud_labels": fraud_typed,
}

