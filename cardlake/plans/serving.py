"""Serving projections (the four views) and the preview helper."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.functions import rules as R
from cardlake.operators.gold import FRAUD_COLUMNS_A, UTILIZATION_COLUMNS
from cardlake.plans import tables as T

# Columns of the spending view.
SPENDING_COLUMNS = [
    "transaction_id", "client_id", "card_id", "transaction_timestamp", "transaction_date", "amount",
    "transaction_amount", "use_chip", "merchant_city", "merchant_state", "mcc", "category",
]

# Fixed value: row limit of the ad-hoc serving query.
AD_HOC_RESULT_LIMIT = 5000


def customer_segmentation_view(gold_users: DataFrame, age_edges: tuple[int, ...] = R.DEFAULT_AGE_EDGES) -> DataFrame:
    return gold_users.select(
        F.col("id").alias("customer_id"),
        "current_age", "gender", "yearly_income", "total_debt", "credit_score", "debt_to_income_ratio",
        R.age_band("current_age", age_edges).alias("age_band"),
        "customer_segment",
    )


def spending_transactions_view(gold_transactions: DataFrame) -> DataFrame:
    return gold_transactions.select(*SPENDING_COLUMNS)


def credit_utilization_view(gold_utilization: DataFrame) -> DataFrame:
    """total_cards is served as INT."""
    return gold_utilization.select(
        *[F.col(c).cast("int").alias(c) if c == "total_cards" else F.col(c) for c in UTILIZATION_COLUMNS]
    )


def fraud_monitoring_view(gold_fraud: DataFrame) -> DataFrame:
    return gold_fraud.select(*FRAUD_COLUMNS_A)


VIEWS = {
    "vw_customer_segmentation": ("users", customer_segmentation_view),
    "vw_spending_transactions": ("transactions", spending_transactions_view),
    "vw_credit_utilization": ("credit_utilization", credit_utilization_view),
    "vw_fraud_monitoring": ("fraud_monitoring", fraud_monitoring_view),
}


def serving_frames(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build(gold[src]) for name, (src, build) in VIEWS.items()}


def register_views(spark: SparkSession, gold: dict[str, DataFrame]) -> list[str]:
    """Register the four serving projections as session views (create or replace)."""
    for name, df in serving_frames(gold).items():
        df.createOrReplaceTempView(name)
    return list(VIEWS)


def _age_band_sql(edges: tuple[int, ...] = R.DEFAULT_AGE_EDGES) -> str:
    whens = [f"WHEN current_age < {edges[0]} THEN '<{edges[0]}'"]
    whens += [f"WHEN current_age < {high} THEN '{low}-{high - 1}'" for low, high in zip(edges, edges[1:])]
    return f"CASE {' '.join(whens)} WHEN current_age IS NOT NULL THEN '{edges[-1]}+' END"


def view_selects() -> dict[str, tuple[str, str]]:
    """The projections of ``VIEWS`` as SQL: view -> (gold table, select list)."""
    total_cards = [f"CAST({c} AS INT) AS {c}" if c == "total_cards" else c for c in UTILIZATION_COLUMNS]
    return {
        "vw_customer_segmentation": ("users", (
            "id AS customer_id, current_age, gender, yearly_income, total_debt, credit_score, debt_to_income_ratio, "
            f"{_age_band_sql()} AS age_band, customer_segment")),
        "vw_spending_transactions": ("transactions", ", ".join(SPENDING_COLUMNS)),
        "vw_credit_utilization": ("credit_utilization", ", ".join(total_cards)),
        "vw_fraud_monitoring": ("fraud_monitoring", ", ".join(FRAUD_COLUMNS_A)),
    }


def create_views(spark: SparkSession, gold_names: dict[str, str], schema: str) -> list[str]:
    """The four serving views in the catalog, over the stored gold tables; those that exist stay. They read
    whatever the gold names stand for, so a later run needs no new views."""
    return [T.create_view(spark, f"{schema}.{view}", f"SELECT {columns} FROM {gold_names[table]}")
            for view, (table, columns) in view_selects().items()]


def ad_hoc(spark: SparkSession, view: str, limit: int = AD_HOC_RESULT_LIMIT) -> DataFrame:
    """``SELECT *`` over a serving view with the ad-hoc result limit (the
    limit is the feature here: an interactive preview, not a full read)."""
    return spark.table(view).limit(limit)


def preview(df: DataFrame, n: int = 10, order_by: str | None = None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` a deterministic top-n (a per-task
    top-n then one merge, never a full sort)."""
    return (df.orderBy(order_by) if order_by else df).limit(n)
