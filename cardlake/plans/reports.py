"""Report queries of the dashboard, over the gold tables.

``gold`` is a dict with keys users, transactions, credit_utilization,
fraud_monitoring (canonical superset gold tables, persisted or in-memory).
Results are sorted like the visuals; the sort is the last, small step.

Scale notes: every fact-to-dimension report pre-aggregates the fact per
customer before joining (the fact never shuffles row by row to a join);
the two table visuals filter first and touch only per-customer data plus the
selected fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.functions import rules as R
from cardlake.plans import measures as M
from cardlake.plans.joins import fact_measure_by_dim_attribute

HIGH_BAND = R.BAND_HIGH


# --- cards (single-value visuals) -------------------------------------------------

def total_customers(gold: dict[str, DataFrame]) -> DataFrame:
    return gold["users"].agg(M.distinct_customers("id").alias("total_customers"))


def total_transactions(gold: dict[str, DataFrame]) -> DataFrame:
    return gold["transactions"].agg(M.transaction_count("transaction_id").alias("total_transactions"))


def total_fraud_transactions(gold: dict[str, DataFrame]) -> DataFrame:
    return gold["fraud_monitoring"].agg(M.fraud_transactions("is_fraud").alias("fraud_transactions"))


def average_credit_score(gold: dict[str, DataFrame]) -> DataFrame:
    return gold["credit_utilization"].agg(M.average_credit_score("credit_score").alias("average_credit_score"))


# --- charts -----------------------------------------------------------------------

def transactions_by_band(gold: dict[str, DataFrame]) -> DataFrame:
    """Count of transaction customer ids per utilization band (counts rows,
    not customers, like the source chart)."""
    df = fact_measure_by_dim_attribute(
        gold, "credit_utilization", "utilization_band",
        {"n": M.visual_aggregate(M.VISUAL_COUNT_NON_NULL, "client_id")},
        {"transaction_count": F.sum("n").cast("long")},
    )
    return df.orderBy(F.desc("transaction_count"), "utilization_band")


def transactions_by_segment(gold: dict[str, DataFrame]) -> DataFrame:
    df = fact_measure_by_dim_attribute(
        gold, "users", "customer_segment",
        {"n": M.visual_aggregate(M.VISUAL_COUNT_NON_NULL, "client_id")},
        {"transaction_count": F.sum("n").cast("long")},
    )
    return df.orderBy(F.desc("transaction_count"), "customer_segment")


def customers_by_band(gold: dict[str, DataFrame]) -> DataFrame:
    """Companion: distinct transacting customers per band."""
    df = fact_measure_by_dim_attribute(
        gold, "credit_utilization", "utilization_band",
        {"n": F.count("client_id")}, {"distinct_customers": F.count("__k")},
    )
    return df.orderBy(F.desc("distinct_customers"), "utilization_band")


def customers_by_segment(gold: dict[str, DataFrame]) -> DataFrame:
    df = fact_measure_by_dim_attribute(
        gold, "users", "customer_segment",
        {"n": F.count("client_id")}, {"distinct_customers": F.count("__k")},
    )
    return df.orderBy(F.desc("distinct_customers"), "customer_segment")


def scored_customers_by_segment(gold: dict[str, DataFrame]) -> DataFrame:
    """count(credit_utilization.credit_score) by users.customer_segment, the two
    tables matched on customer id (both one row per customer)."""
    u = gold["users"].select("id", "customer_segment")
    c = gold["credit_utilization"].select("customer_id", "credit_score")
    j = u.join(c, u.id == c.customer_id, "left")
    return j.groupBy("customer_segment").agg(
        M.visual_aggregate(M.VISUAL_COUNT_NON_NULL, "credit_score").alias("scored_customers")
    ).orderBy(
        F.desc("scored_customers"), "customer_segment"
    )


def monthly_debit_credit(gold: dict[str, DataFrame]) -> DataFrame:
    t = gold["transactions"]
    return t.groupBy("transaction_month_name").agg(
        M.visual_aggregate(M.VISUAL_SUM, "debited_amount").alias("total_debited"),
        M.visual_aggregate(M.VISUAL_SUM, "credited_amount").alias("total_credited"),
    ).orderBy(F.desc("total_debited"), "transaction_month_name")


def monthly_debit_credit_by_month_number(gold: dict[str, DataFrame]) -> DataFrame:
    """Companion: the same sums in calendar order."""
    t = gold["transactions"]
    return t.groupBy("transaction_month", "transaction_month_name").agg(
        M.visual_aggregate(M.VISUAL_SUM, "debited_amount").alias("total_debited"),
        M.visual_aggregate(M.VISUAL_SUM, "credited_amount").alias("total_credited"),
    ).orderBy("transaction_month")


def spend_by_category(gold: dict[str, DataFrame]) -> DataFrame:
    t = gold["transactions"]
    return t.groupBy("category").agg(M.visual_aggregate(M.VISUAL_SUM, "debited_amount").alias("total_debited")).orderBy(
        F.desc("total_debited"), "category"
    )


def labelled_by_state_category(gold: dict[str, DataFrame]) -> DataFrame:
    """count(is_fraud) per state and category, state not NULL. Counts labelled
    transactions, fraud or not, like the source chart."""
    f = gold["fraud_monitoring"].filter(F.col("merchant_state").isNotNull())
    return f.groupBy("merchant_state", "category").agg(
        M.visual_aggregate(M.VISUAL_COUNT_NON_NULL, "is_fraud").alias("labelled_transactions")
    ).orderBy(F.desc("labelled_transactions"), "merchant_state", "category")


def fraud_rate_by_state_category(gold: dict[str, DataFrame]) -> DataFrame:
    """Companion: fraud count and rate among labelled transactions."""
    f = gold["fraud_monitoring"].filter(F.col("merchant_state").isNotNull())
    return f.groupBy("merchant_state", "category").agg(
        F.sum("is_fraud").cast("long").alias("fraud_transactions"),
        F.count("is_fraud").alias("labelled_transactions"),
        F.avg("is_fraud").alias("fraud_rate"),
    ).orderBy(F.desc("fraud_transactions"), "merchant_state", "category")


# --- tables -----------------------------------------------------------------------

def high_risk_customers(gold: dict[str, DataFrame], bands: tuple[str, ...] = (HIGH_BAND,)) -> DataFrame:
    """Customers in the selected bands with their users-table figures, by id.
    Rows are already distinct: one utilization row per customer id."""
    c = gold["credit_utilization"].filter(F.col("utilization_band").isin(*bands)).select(
        "customer_id", "total_credit_limit", "utilization_band"
    )
    u = gold["users"].select("id", "credit_score", "yearly_income", "total_debt")
    j = c.join(u, c.customer_id == u.id, "inner")
    return j.select(
        "customer_id", "credit_score", "yearly_income", "total_debt", "total_credit_limit", "utilization_band"
    ).orderBy("customer_id")


def fraud_investigation(gold: dict[str, DataFrame], bands: tuple[str, ...] = (HIGH_BAND,)) -> DataFrame:
    """Fraud-flagged transactions of customers in the selected bands.

    Transactions and fraud monitoring are one row per transaction_id each and
    built from the same silver rows, and the canonical fraud table carries the
    transaction columns, so the 1:1 fact-to-fact join is not materialised. The
    band filter is a left-semi join on customer id (no columns needed from it);
    as gold tables are not bucketed, AQE splits a skewed customer on that join. transaction_id is unique, so
    rows are already distinct.
    """
    f = gold["fraud_monitoring"].filter(F.col("is_fraud") == 1)
    hi = gold["credit_utilization"].filter(F.col("utilization_band").isin(*bands)).select("customer_id")
    j = f.join(hi, f.client_id == hi.customer_id, "left_semi")
    return j.select(
        "transaction_id", "transaction_month_name", F.col("client_id").alias("customer_id"), "is_fraud",
        "merchant_city",
    ).orderBy(F.desc("customer_id"), "transaction_id")


REPORTS = {
    "report_total_customers": total_customers,
    "report_total_transactions": total_transactions,
    "report_total_fraud_transactions": total_fraud_transactions,
    "report_average_credit_score": average_credit_score,
    "report_transactions_by_band": transactions_by_band,
    "report_transactions_by_segment": transactions_by_segment,
    "report_scored_customers_by_segment": scored_customers_by_segment,
    "report_monthly_debit_credit": monthly_debit_credit,
    "report_spend_by_category": spend_by_category,
    "report_labelled_by_state_category": labelled_by_state_category,
    "report_high_risk_customers": high_risk_customers,
    "report_fraud_investigation": fraud_investigation,
    "report_companion_customers_by_band": customers_by_band,
    "report_companion_customers_by_segment": customers_by_segment,
    "report_companion_fraud_rate": fraud_rate_by_state_category,
    "report_companion_monthly_by_number": monthly_debit_credit_by_month_number,
}
