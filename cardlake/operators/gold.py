"""Gold layer: segmentation, enriched transactions, credit utilization, fraud monitoring.

Canonical gold tables carry the union of the columns both source variants
write; the per-variant column sets are projections (``*_COLUMNS_A/B``).

Plan shape (see ``explain``): silver transactions are hash-partitioned by id
by their de-duplication, silver fraud labels by transaction_id, so the fraud
left join reuses both partitionings (no extra exchange). Users (by id) and the
per-client card totals (by client_id) likewise meet without a re-shuffle. The
merchant-code table is a bounded code list; whether it is broadcast is the planner's choice, by
statistics where the table has them (``plans.tables.analyze``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.functions import rules as R

# Projections of the two source variants and of the serving views.
TRANSACTIONS_COLUMNS_A = [
    "transaction_id", "client_id", "card_id", "transaction_timestamp", "transaction_date",
    "transaction_year", "transaction_month", "transaction_month_name", "amount",
    "transaction_amount", "use_chip", "merchant_city", "merchant_state", "zip", "mcc", "category",
]
TRANSACTIONS_COLUMNS_B = [
    "transaction_id", "customer_id", "card_id", "transaction_year", "transaction_month",
    "transaction_month_name", "transaction_amount", "debited_amount", "credited_amount",
    "merchant_city", "merchant_state", "mcc", "category",
]
FRAUD_COLUMNS_A = [
    "transaction_id", "client_id", "card_id", "transaction_timestamp", "transaction_date", "amount",
    "transaction_amount", "use_chip", "merchant_city", "merchant_state", "mcc", "category",
    "fraud_label", "is_fraud",
]
FRAUD_COLUMNS_B = [
    "transaction_id", "client_id", "card_id", "transaction_date", "transaction_amount",
    "debited_amount", "credited_amount", "merchant_city", "merchant_state", "mcc", "category",
    "fraud_label", "is_fraud",
]
TRANSACTIONS_COLUMNS_SUPERSET = [
    "transaction_id", "client_id", "card_id", "transaction_timestamp", "transaction_date",
    "transaction_year", "transaction_month", "transaction_month_name", "amount", "transaction_amount",
    "debited_amount", "credited_amount", "use_chip", "merchant_city", "merchant_state", "zip", "mcc",
    "category",
]
UTILIZATION_COLUMNS = [
    "customer_id", "current_age", "gender", "yearly_income", "total_debt", "credit_score",
    "total_credit_limit", "total_cards", "credit_utilization", "utilization_band",
]


def gold_users(silver_users: DataFrame, thresholds: R.SegmentThresholds = R.SegmentThresholds()) -> DataFrame:
    with_ratio = silver_users.withColumn(
        "debt_to_income_ratio", R.guarded_ratio("total_debt", "yearly_income")
    )
    return with_ratio.withColumn("customer_segment", R.customer_segment(t=thresholds))


def _mcc_side(silver_mcc: DataFrame) -> DataFrame:
    """The code list, unhinted: the planner decides from its real bytes whether to broadcast it."""
    return silver_mcc.select("mcc", "category")


def _transaction_core(t: DataFrame) -> list:
    return [
        F.col("id").alias("transaction_id"),
        F.col("client_id"),
        F.col("card_id"),
        F.col("transaction_timestamp"),
        F.col("transaction_date"),
        F.col("transaction_year"),
        F.col("transaction_month"),
        F.col("transaction_month_name"),
        F.col("amount"),
        F.col("transaction_amount"),
        R.debited_amount("amount").alias("debited_amount"),
        R.credited_amount("amount").alias("credited_amount"),
        F.col("use_chip"),
        F.col("merchant_city"),
        F.col("merchant_state"),
        F.col("zip"),
        F.col("mcc"),
        F.col("category"),
    ]


def gold_transactions(silver_transactions: DataFrame, silver_mcc: DataFrame) -> DataFrame:
    """Canonical (superset) gold transactions: silver transactions left-joined to
    the merchant-code table, with the debit/credit split."""
    t = silver_transactions.join(_mcc_side(silver_mcc), "mcc", "left")
    return t.select(*_transaction_core(t))


def transactions_variant_a(gold_txn: DataFrame) -> DataFrame:
    return gold_txn.select(*TRANSACTIONS_COLUMNS_A)


def transactions_variant_b(gold_txn: DataFrame) -> DataFrame:
    return gold_txn.withColumnRenamed("client_id", "customer_id").select(*TRANSACTIONS_COLUMNS_B)


def card_totals(silver_cards: DataFrame) -> DataFrame:
    """Per client: total credit limit and number of cards.

    Card ids are unique after the silver de-duplication, so the distinct card
    count equals ``count(id)``; counting directly keeps this a single partial +
    final hash aggregate (no distinct-expansion shuffle)."""
    return silver_cards.groupBy("client_id").agg(
        R.money_sum("credit_limit").alias("total_credit_limit"),
        F.count("id").alias("total_cards"),
    )


def gold_credit_utilization(
    silver_users: DataFrame,
    silver_cards: DataFrame,
    edges: R.BandEdges = R.BandEdges(),
    null_band: str | None = R.BAND_HIGH,
) -> DataFrame:
    totals = card_totals(silver_cards)
    u = silver_users.alias("u").join(totals.alias("c"), F.col("u.id") == F.col("c.client_id"), "left")
    u = u.select(
        F.col("u.id").alias("customer_id"),
        F.col("u.current_age"),
        F.col("u.gender"),
        F.col("u.yearly_income"),
        F.col("u.total_debt"),
        F.col("u.credit_score"),
        F.col("c.total_credit_limit"),
        F.col("c.total_cards"),
    )
    u = u.withColumn("credit_utilization", R.guarded_ratio("total_debt", "total_credit_limit"))
    return u.withColumn("utilization_band", R.utilization_band("credit_utilization", edges, null_band))


def gold_fraud_monitoring(
    silver_transactions: DataFrame, silver_fraud: DataFrame, silver_mcc: DataFrame
) -> DataFrame:
    """Canonical (superset) fraud monitoring: every transaction, its label
    (NULL when unlabelled) and merchant category."""
    f = silver_fraud.select("transaction_id", "fraud_label", "is_fraud")
    t = silver_transactions.join(f, silver_transactions.id == f.transaction_id, "left").drop("transaction_id")
    t = t.join(_mcc_side(silver_mcc), "mcc", "left")
    return t.select(*_transaction_core(t), F.col("fraud_label"), F.col("is_fraud"))


def fraud_variant_a(gold_fraud: DataFrame) -> DataFrame:
    return gold_fraud.select(*FRAUD_COLUMNS_A)


def fraud_variant_b(gold_fraud: DataFrame) -> DataFrame:
    return gold_fraud.select(*FRAUD_COLUMNS_B)

